"""DataFrame operators over keyed records: newest rows, merges, differences, registries of checks and fixes."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.text import change_hash

BROADCAST_ROWS = 100_000


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the folder that ``spark.checkpoint.dir`` names; only a local session may make its own."""
    spark, sc = df.sparkSession, df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="docloom-"))
    return df.checkpoint(eager=True)


def keep_newest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``, found by partial aggregation so that a hot key is no window partition."""
    rest = [c for c in df.columns if c not in key]
    packed = df.select(*key, F.struct(*rest).alias("__row"), F.struct(*order).alias("__order"))
    return packed.groupBy(*key).agg(F.max_by("__row", "__order").alias("__row")).select(*key, "__row.*")


def anti_join_ingest(incoming: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key is not stored; rows without a key pass."""
    keys = stored.select(F.col(key).alias("__k")).where("__k IS NOT NULL").distinct()
    return incoming.join(keys, incoming[key] == F.col("__k"), "left_anti")


def merge_update(target: DataFrame, updates: DataFrame, key: str, fields: list[str], version: str | None = None) -> DataFrame:
    """``target`` with the non-blank fields of ``updates`` taken over; a stale ``expected`` version leaves its row alone."""
    u = updates.select(F.col(key).alias("__k"), *[F.col(f).alias(f"__{f}") for f in fields], *([F.col("expected").alias("__v")] if version else []))
    fresh = F.col("__v").isNull() | F.col(version).eqNullSafe(F.col("__v")) if version else F.lit(True)
    new = {f: F.coalesce(F.when(fresh, F.nullif(F.col(f"__{f}"), F.lit(""))), F.col(f)) for f in fields}
    j = target.join(u, target[key] == F.col("__k"), "left")
    return j.select(*[new[c].alias(c) if c in new else F.col(c) for c in target.columns])


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, op (insert, update, delete), changed fields and hash of every row that differs."""
    o = old.select(F.col(key).alias("__ok"), *[F.col(f).alias(f"__o_{f}") for f in fields])
    n = new.select(F.col(key).alias("__nk"), *[F.col(f).alias(f"__n_{f}") for f in fields], change_hash(*fields).alias("change_hash"))
    j = o.join(n, F.col("__ok") == F.col("__nk"), "full_outer")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"__o_{f}").eqNullSafe(F.col(f"__n_{f}")), F.lit(f)) for f in fields]))
    op = F.when(F.col("__ok").isNull(), "insert").when(F.col("__nk").isNull(), "delete").otherwise("update")
    return j.select(F.coalesce("__ok", "__nk").alias(key), op.alias("op"), changed.alias("changed"), "change_hash").where("op <> 'update' OR size(changed) > 0")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame marked for broadcast if it has at most ``rows`` rows, as it is otherwise."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def scan(df: DataFrame, key: str, checks: dict[str, Column], names: Iterable[str] | None = None) -> DataFrame:
    """Issues of the named checks (all by default; unknown names are skipped) in one pass: key, check_key, severity."""
    chosen = [n for n in (names or checks) if n in checks]
    if not chosen:
        return df.select(key, F.lit(None).cast("string").alias("check_key"), F.lit(None).cast("string").alias("severity")).where(F.lit(False))
    rows = F.array(*[F.struct(F.lit(n).alias("check_key"), checks[n].alias("severity")) for n in chosen])
    return df.select(key, F.explode(F.filter(rows, lambda x: x["severity"].isNotNull())).alias("x")).select(key, "x.*")


def apply_fixes(df: DataFrame, fixes: dict[str, Callable[[DataFrame], DataFrame]], names: Iterable[str], key: str, dry_run: bool = True) -> DataFrame:
    """The frame after the named fixes, or in a dry run the rows that would change with old and new values."""
    out = df
    for n in names:
        out = fixes[n](out)
    if not dry_run:
        return out
    fields = [c for c in df.columns if c != key]
    o = df.select(F.col(key), F.struct(*fields).alias("old"))
    n = out.select(F.col(key), F.struct(*fields).alias("new"))
    return o.join(n, key).where(~F.col("old").eqNullSafe(F.col("new")))


def first_n(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group; Spark limits each task's rows before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")
