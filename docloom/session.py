"""Session construction and table access shared by queries, tests and benchmarks."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings that tests and the benchmark share."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("docloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("DOCLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a scale-factor directory; any path Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, where it isn't installed: functions that run there import it."""
    root = Path(__file__).resolve().parent
    archive = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="docloom-")) / root.name), "zip", root.parent, root.name)
    spark.sparkContext.addPyFile(archive)
