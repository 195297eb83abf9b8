"""Sinks and small state: inserts, updates, time series, exports, merged outputs, checkpoint files.

Tables are folders of Parquet. A sink writes a new folder or appends; nothing is
changed in place while it is read. Counts come from one aggregate, rows never
reach the driver.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BOM = "﻿"


def insert_new(spark: SparkSession, incoming: DataFrame, path: str, key: str, well_formed: Column, normalise=None, order: Column | None = None) -> dict[str, int]:
    """Append the rows of ``incoming`` whose key is well formed and not stored; each key once, the first by ``order``.

    Keys are normalised before they are compared, so a variant of a stored key
    doesn't pass. Running it again appends nothing: a lost run can be repeated.
    """
    rows = incoming.withColumn(key, normalise(F.col(key))) if normalise else incoming
    counted = rows.agg(F.count("*").alias("n"), F.coalesce(F.count_if(~F.coalesce(well_formed, F.lit(False))), F.lit(0)).alias("bad")).first()
    first = rows.where(F.coalesce(well_formed, F.lit(False))).groupBy(key).agg(F.min_by(F.struct(*rows.columns), order if order is not None else F.xxhash64(*rows.columns)).alias("x")).select("x.*")
    new = first
    if exists(spark, path):
        new = first.join(spark.read.parquet(path).select(F.col(key).alias("__k")).distinct(), F.col(key) == F.col("__k"), "left_anti")
    batch = f"{path}-batch-{uuid.uuid4().hex}"
    new.write.parquet(batch)  # written once: what is counted is what is appended
    done = spark.read.schema(new.schema).parquet(batch)
    inserted = done.count()
    if inserted:
        done.write.mode("append").parquet(path)
    delete(spark, batch)
    return {"inserted": inserted, "rejected": counted["bad"], "skipped": counted["n"] - counted["bad"] - inserted}


def update_by_key(spark: SparkSession, path: str, updates: DataFrame, key: str, fields: list[str], out: str) -> tuple[int, DataFrame]:
    """``path`` with the non-null fields of ``updates`` written to ``out``; how many rows were updated, and the updates that found no row or share their key."""
    many = updates.groupBy(key).agg(F.count("*").alias("n"), F.first(F.struct(*fields)).alias("u"))
    old = spark.read.parquet(path)
    single = many.where("n = 1").select(F.col(key).alias("__k"), *[F.col(f"u.{f}").alias(f"__{f}") for f in fields])
    joined = old.join(single, old[key] == F.col("__k"), "left")
    joined.select(*[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in old.columns]).write.parquet(out)
    missing = many.join(old.select(F.col(key).alias("__o")).distinct(), F.col(key) == F.col("__o"), "left")
    errors = missing.where("n > 1 OR __o IS NULL").select(key, F.when(F.col("n") > 1, "several updates").otherwise("not found").alias("error"))
    ok = missing.where("n = 1 AND __o IS NOT NULL").count()
    return ok, errors


def upsert_latest(spark: SparkSession, path: str, updates: DataFrame, key: list[str], latest: str, out: str) -> DataFrame:
    """Rows of ``path`` replaced or joined by the newest of ``updates`` for each key (ties: the largest row); written to ``out`` and read again."""
    rest = [c for c in updates.columns if c not in key]
    new = updates.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(latest, F.struct(*rest))).alias("x")).select(*key, "x.*")
    old = spark.read.parquet(path).join(new.select(*key), key, "left_anti")
    old.unionByName(new, allowMissingColumns=True).write.parquet(out)
    return spark.read.parquet(out)


def append_series(points: DataFrame, path: str, ts: str = "ts") -> None:
    """A time series by day: a day that ages out is a folder to remove."""
    points.withColumn("day", F.to_date(ts)).repartition("day").write.partitionBy("day").mode("append").parquet(path)


def retained(spark: SparkSession, path: str, days: int, today: str) -> DataFrame:
    """The series of the last ``days`` days; older folders are not read."""
    return spark.read.parquet(path).where(F.col("day") >= F.date_sub(F.lit(today).cast("date"), days))


def export_metrics(points: DataFrame, path: str, names: list[str] | None = None, since: str | None = None, form: str = "json") -> None:
    """Points as JSON lines or CSV: of the names given, from a time on; metadata as JSON text in CSV."""
    out = points
    if names is not None:
        out = out.where(F.col("name").isin(*names)) if names else out.limit(0)
    if since is not None:
        out = out.where(F.col("ts") >= F.lit(since).cast("timestamp"))
    if form == "json":
        out.write.json(path)
    else:
        nested = [f.name for f in out.schema if f.dataType.typeName() in ("map", "struct", "array")]
        out.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in out.columns]).write.csv(path, header=True, escape='"')


def write_records_csv(df: DataFrame, path: str, columns: list[str], bom: bool = True, numbered: str | None = None) -> None:
    """The columns in this order, nulls as empty text, with a byte-order mark and, if asked for, ids from 1 on in order of the first column."""
    out = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])
    if numbered:
        sized = out.withColumn("__p", F.spark_partition_id())
        sizes = {r["__p"]: r["n"] for r in sized.groupBy("__p").agg(F.count("*").alias("n")).collect()}  # one number a partition
        before, at = {}, 0
        for p in sorted(sizes):
            before[p], at = at, at + sizes[p]
        table = F.create_map(*[F.lit(x) for p, b in before.items() for x in (p, b)]) if before else None
        place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + 1
        out = sized.select((place + (table[F.col("__p")] if table is not None else F.lit(0))).alias(numbered), *columns)
    if bom and out.columns:
        out = out.withColumnRenamed(out.columns[0], BOM + out.columns[0])
    out.write.csv(path, header=True, escape='"')


def merge_outputs(spark: SparkSession, paths: list[str], key: str, out: str) -> DataFrame:
    """The outputs of workers as one table sorted by key; of rows with one key that of the last path."""
    every = None
    for i, p in enumerate(paths):
        one = spark.read.parquet(p).withColumn("__w", F.lit(i))
        every = one if every is None else every.unionByName(one, allowMissingColumns=True)
    rest = [c for c in every.columns if c not in (key, "__w")]
    merged = every.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("__w", F.xxhash64(*rest))).alias("x")).select(key, "x.*")
    merged.orderBy(key).write.parquet(out)
    return spark.read.parquet(out)


def write_failed(rows: DataFrame, path: str) -> int:
    """Rows with errors, with their warnings and fixes, as JSON lines; how many there were."""
    rows.where("size(errors) > 0").write.json(path)
    return rows.sparkSession.read.schema(rows.schema).json(path).count()


def preview(df: DataFrame, path: str, order: str, rows: int = 5) -> list:
    """The first rows as CSV for approval, and themselves."""
    top = df.orderBy(order).limit(rows)
    top.select(*[F.col(c).cast("string") for c in df.columns]).write.csv(path, header=True, escape='"')
    return top.collect()


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


class Checkpoint:
    """A small JSON state in a folder that Spark can reach: each save is a new file, loading takes the newest whole one.

    A crash while saving leaves an unfinished folder that is never read, which is
    what writing to the side and renaming gives on one machine.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def save(self, state: dict) -> None:
        done = self._saved()
        version = max(done, default=0) + 1
        self.spark.createDataFrame([(json.dumps(state, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/v{version}")
        for old in sorted(done)[:-1]:
            delete(self.spark, f"{self.path}/v{old}")

    def load(self, default: dict | None = None) -> dict | None:
        done = self._saved()
        return json.loads(self.spark.read.text(f"{self.path}/v{max(done)}", wholetext=True).first()["value"]) if done else default

    def _saved(self) -> list[int]:
        if not exists(self.spark, self.path):
            return []
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        names = [s.getPath().getName() for s in at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)]
        return [int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit() and exists(self.spark, f"{self.path}/{n}/_SUCCESS")]


def deep_merge(base: dict, update: dict) -> dict:
    """A configuration with another one laid over it, mapping by mapping."""
    return {**base, **{k: deep_merge(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in update.items()}}
