"""Structured Streaming forms of the metric queries over a directory of event files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
COOLDOWN_S = {"critical": 3600, "warning": 6 * 3600}


def events(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


#: period -> window length and where windows start, counted from 1970-01-01, a Thursday: weeks start on Sunday
PERIODS = {"hour": ("1 hour", "0 seconds"), "day": ("1 day", "0 seconds"), "week": ("7 days", "3 days")}
ACCURACY = 10_000  # a median's rank is off by at most a ten-thousandth of the window's rows


def tumbling(stream: DataFrame, size: str = "1 hour", late: str = "2 hours", slide: str | None = None, start: str = "0 seconds", accuracy: int = ACCURACY) -> DataFrame:
    """Count, total, range and median by type and window; rows later than the watermark are dropped (the reference defines no late data).

    The median's state is a mergeable quantile sketch a window: the value returned
    is one of the window's, and its rank is within rows / ``accuracy`` of the
    middle. A window of fewer than ``accuracy`` rows gives an exact (lower) median.
    """
    w = F.window("ts", size, slide or size, start)
    return stream.withWatermark("ts", late).groupBy("event_type", w.alias("w")).agg(
        F.count("*").alias("n"), F.sum("value").alias("total"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.percentile_approx("value", 0.5, accuracy).alias("median"),
    ).select("event_type", F.col("w.start").alias("window_start"), "n", "total", "lo", "hi", "median")


def periods(stream: DataFrame, period: str, late: str = "2 hours", accuracy: int = ACCURACY) -> DataFrame:
    """``tumbling`` by hour, day or week (from Sunday on)."""
    size, start = PERIODS[period]
    return tumbling(stream, size, late, None, start, accuracy)


def sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Count and total of each user's sessions."""
    return stream.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(
        "user_id", F.col("w.start").alias("started"), "n", "total")


def dedup(stream: DataFrame, late: str = "2 hours") -> DataFrame:
    """The first event of each id; state is dropped behind the watermark."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def cooldown(stream: DataFrame) -> DataFrame:
    """Alerts sent, a cooldown apart for each metric and severity: one number of state a group."""
    alerts = stream.where("value > 75").select("event_id", "event_type", "ts", F.when(F.col("value") > 150, "critical").otherwise("warning").alias("severity"))

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        wait, sent = COOLDOWN_S[key[1]] * 1_000_000, []
        for event_id, t in zip(rows["event_id"], rows["ts"].astype("datetime64[us]").astype("int64")):
            if last is None or t >= last + wait:
                sent.append(event_id)
                last = int(t)
        if last is not None:
            state.update((last,))
        yield pd.DataFrame({"event_id": sent, "event_type": key[0], "severity": key[1]})

    return alerts.groupBy("event_type", "severity").applyInPandasWithState(
        run, "event_id long, event_type string, severity string", "last long", "append", GroupStateTimeout.NoTimeout)
