"""Incremental runs: changes to the checks they need, reports, alerts, monitors. Changes themselves are processed in ``changes``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.records import scan, small


def needed_checks(changes: DataFrame, routes: dict[str, tuple[str, ...]], every: tuple[str, ...]) -> DataFrame:
    """key, check_key: the checks of the changed fields of an update, all for an insert, the mark ``deleted`` for a delete.

    ``changes`` has key, op (in any case) and changed, an array of field names. The table of routes has a row a field, written by hand.
    """
    table = F.create_map(*[x for f, cs in routes.items() for x in (F.lit(f), F.array(*map(F.lit, cs)))])
    op = F.lower("op")
    checks = F.when(op == "insert", F.array(*map(F.lit, every))).when(op == "delete", F.array(F.lit("deleted"))).otherwise(
        F.flatten(F.transform(F.coalesce("changed", F.array().cast("array<string>")), lambda f: F.coalesce(table[f], F.array().cast("array<string>")))))
    return changes.select("key", F.explode(F.array_distinct(checks)).alias("check_key")).distinct()


def incremental_scan(old: DataFrame, new: DataFrame, key: str, fields: list[str], checks: dict[str, Column]) -> DataFrame:
    """Report of an incremental scan: issues by check and severity over the rows of ``new`` that are new or changed, with how many there are."""
    from docloom.functions.text import change_hash

    before = old.select(F.col(key).alias("__k"), change_hash(*fields).alias("__h"))
    changed = new.withColumn("__n", change_hash(*fields)).join(before, F.col(key) == F.col("__k"), "left").where("__h IS NULL OR __h <> __n").drop("__k", "__h", "__n")
    issues = scan(changed, key, checks)
    return issues.groupBy("check_key", "severity").agg(F.count("*").alias("n_issues"), F.count_distinct(key).alias("n_rows"))


def route_alerts(metrics: DataFrame, limits: dict[str, tuple[float, float]], bounds: DataFrame | None = None) -> DataFrame:
    """Alerts over name, ts, value: over the second limit critical, over the first a warning; outside ``bounds`` (name, mean, sd) by two deviations an anomaly."""
    table = F.create_map(*[x for n, (w, c) in limits.items() for x in (F.lit(n), F.struct(F.lit(float(w)).alias("w"), F.lit(float(c)).alias("c")))])
    limit = table[F.col("name")]
    d = metrics.join(small(bounds), "name", "left") if bounds is not None else metrics.withColumns({"mean": F.lit(None).cast("double"), "sd": F.lit(None).cast("double")})
    beyond = (F.abs(F.col("value") - F.col("mean")) - 2 * F.col("sd")) / F.col("sd")
    severity = F.when(F.col("value") > limit["c"], "critical").when(F.col("value") > limit["w"], "warning").when((F.col("sd") > 0) & (beyond >= 0.7), "anomaly")
    return d.select("name", "ts", "value", severity.alias("severity")).where("severity IS NOT NULL")


def resolve(alerts: DataFrame, ids: DataFrame) -> DataFrame:
    """Alerts with those of ``ids`` resolved, and a row of severity info for each that was open."""
    keys = ids.select(F.col("alert_id").alias("__a")).distinct()
    done = alerts.join(keys, F.col("alert_id") == F.col("__a"), "left").withColumn("hit", F.col("__a").isNotNull() & ~F.col("resolved"))
    told = done.where("hit").select(*[F.lit("info").alias(c) if c == "severity" else F.lit(True).alias(c) if c == "resolved" else F.col(c) for c in alerts.columns])
    return done.select(*[(F.col("resolved") | F.col("hit")).alias(c) if c == "resolved" else F.col(c) for c in alerts.columns]).unionByName(told)


def monitor(stream: DataFrame, checks: dict[str, Callable[[DataFrame], DataFrame]], out: str, checkpoint: str, interval: str | None = None):
    """Run all checks on each micro-batch, once an ``interval`` or over what is there; results of a batch replace an earlier try of it."""

    def batch(df: DataFrame, epoch: int) -> None:
        df = df.persist()
        try:
            for name, check in checks.items():
                check(df).withColumn("check_key", F.lit(name)).write.mode("overwrite").parquet(f"{out}/batch={epoch}/part={name}")
        finally:
            df.unpersist()

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
