"""A table of versions with an optimistic commit log, and merges with three ways to meet a conflict.

A version is a folder of Parquet and an entry of the log that names it. An entry
is made once: whoever comes second finds it taken, reads what was committed and
merges again. So two writers both apply, readers see whole versions, and a
writer that is lost leaves a folder that no entry names.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.sources.sinks import delete

MODES = ("skip", "merge", "overwrite")


class Merged(NamedTuple):
    """Counts of updates (processed, applied, failed, in conflict), the failed ones (key, error), and the version committed."""

    processed: int
    ok: int
    failed: int
    conflicts: int
    errors: DataFrame
    version: int


class VersionedTable:
    """A keyed table whose rows carry the version that wrote them last, in column ``version_col``."""

    def __init__(self, spark: SparkSession, path: str, key: str, version_col: str = "row_version"):
        self.spark, self.path, self.key, self.version_col = spark, path.rstrip("/"), key, version_col
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _fs(self, path: str):
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self._conf)

    def version(self) -> int:
        """The newest version, 0 for none."""
        at, fs = self._fs(f"{self.path}/log")
        if not fs.exists(at):
            return 0
        return max((int(s.getPath().getName()) for s in fs.listStatus(at) if s.getPath().getName().isdigit()), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default."""
        entry = json.loads(self.spark.read.text(f"{self.path}/log/{version or self.version():020d}", wholetext=True).first()[0])
        return self.spark.read.parquet(f"{self.path}/{entry['folder']}")

    def commit(self, rows: DataFrame, base: int) -> int | None:
        """Write the rows as the version after ``base``; None, and nothing, if another writer has made that one."""
        folder = f"data-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        if self._entry(base + 1, {"folder": folder}):
            return base + 1
        delete(self.spark, f"{self.path}/{folder}")
        return None

    def _entry(self, version: int, content: dict) -> bool:
        """Make an entry of the log from a whole file, by a rename that fails where the entry is."""
        side, fs = self._fs(f"{self.path}/log/.{uuid.uuid4().hex}")
        out = fs.create(side, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        to, _ = self._fs(f"{self.path}/log/{version:020d}")
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(side.toUri() if side.toUri().getScheme() else fs.getUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(side, to, none)
            return True
        except Exception as e:  # noqa: BLE001 - any other failure than a taken name is raised
            fs.delete(side, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise

    def create(self, rows: DataFrame) -> int | None:
        return self.commit(rows.withColumn(self.version_col, F.lit(1).cast("long")), 0)

    def merge(self, updates: DataFrame, fields: list[str], mode: str = "skip", retries: int = 3, expected: str | None = None,
              before_commit: Callable[[], None] | None = None) -> Merged:
        """Apply updates field by field; a null or blank value keeps the stored one.

        ``expected`` names the column of ``updates`` with the row version that the
        writer had seen. Where it isn't the stored one, or another writer changed
        the row in between, that is a conflict: ``skip`` leaves the row and names
        it an error, ``merge`` fills only fields that are null or blank in the
        stored row, ``overwrite`` applies the update all the same. An update without
        a stored row is an error, and so are several updates of one row. An entry of
        the log that another writer made first means to read and merge again, up to
        ``retries`` times. One join a try; what is counted is what was written.
        """
        if mode not in MODES:
            raise ValueError(f"mode {mode!r} is none of {MODES}")
        key, version = self.key, self.version_col
        seen = F.col(expected).cast("long") if expected else F.lit(None).cast("long")
        u = updates.select(F.col(key).alias("__k"), seen.alias("__seen"), F.struct(*fields).alias("__u")).groupBy("__k").agg(
            F.count("*").alias("__times"), F.first("__seen").alias("__seen"), F.first("__u").alias("__u"))
        for attempt in range(retries + 1):
            base = self.version()
            old = self.read(base)
            j = old.withColumn("__here", F.lit(True)).join(u, F.col(key) == F.col("__k"), "full_outer").where("__here OR __k IS NOT NULL OR __times IS NOT NULL")
            conflict = F.coalesce(F.col("__here") & (F.col("__times") == 1) & (F.col("__seen") != F.col(version)), F.lit(False))
            error = F.when(F.col("__times").isNull(), F.lit(None).cast("string")).when(F.col("__here").isNull(), "not found").when(F.col("__times") > 1, "several updates").when(
                conflict & (F.lit(mode) == "skip"), "conflict")
            j = j.select("*", conflict.alias("__conflict"), error.alias("__error"))
            applies = F.col("__times").isNotNull() & F.col("__error").isNull()
            blank = lambda c: c.isNull() | (c.cast("string") == "")

            def value(f: str):
                new, stored = F.col(f"__u.{f}"), F.col(f)
                takes = applies & ~blank(new) & ((~F.col("__conflict") | (F.lit(mode) == "overwrite")) | blank(stored))
                return F.when(takes, new).otherwise(stored)

            cols = [value(c).alias(c) if c in fields else F.when(applies, base + 1).otherwise(F.col(c)).cast("long").alias(c) if c == version else F.col(c) for c in old.columns]
            # rows and verdicts are one table, so they come from one join; errors of unknown keys are rows without a stored one
            out = j.select(*cols, "__here", "__times", "__conflict", "__error", "__k")
            folder = f"{self.path}/side-{uuid.uuid4().hex}"
            out.write.parquet(folder)
            both = self.spark.read.schema(out.schema).parquet(folder)
            if before_commit:
                before_commit()
            made = self.commit(both.where("__here").select(*old.columns), base)
            if made:
                n = both.where("__times IS NOT NULL").agg(F.count("*").alias("n"), F.count("__error").alias("bad"), F.count_if("__conflict").alias("c")).first()
                errors = both.where("__error IS NOT NULL").select(F.col("__k").alias(key), F.col("__error").alias("error"))
                errors.write.parquet(f"{self.path}/errors/{made:020d}")
                delete(self.spark, folder)
                return Merged(n["n"], n["n"] - n["bad"], n["bad"], n["c"], self.spark.read.schema(errors.schema).parquet(f"{self.path}/errors/{made:020d}"), made)
            delete(self.spark, folder)
            time.sleep(0.1 * (attempt + 1))
        raise RuntimeError(f"{retries + 1} other writers were first")
