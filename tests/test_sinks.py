"""Sinks, checkpoints and incremental runs on small tables."""

import glob

import pytest
from docloom.sources import sinks
from docloom.streaming import incremental, metrics as streams
from pyspark.sql import functions as F


def test_insert_new_is_idempotent_and_normalises(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("37_1", "a"), ("37/_1", "b"), ("bad", "c"), ("37_2", "d"), (None, "e")], "k string, v string")
    ok, norm = F.col("k").rlike("^[0-9]+_[0-9]+$"), lambda c: F.regexp_replace(c, "/", "")
    first = sinks.insert_new(spark, rows, path, "k", ok, norm, F.col("v"))
    assert first == {"inserted": 2, "rejected": 2, "skipped": 1}
    again = sinks.insert_new(spark, rows, path, "k", ok, norm, F.col("v"))
    assert again == {"inserted": 0, "rejected": 2, "skipped": 3}
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [("37_1", "a"), ("37_2", "d")]


def test_updates_and_upserts(spark, tmp_path):
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, t int").write.parquet(str(tmp_path / "t"))
    up = spark.createDataFrame([(1, "z"), (3, "q"), (2, "x"), (2, "y")], "k int, v string")
    ok, errors = sinks.update_by_key(spark, str(tmp_path / "t"), up, "k", ["v"], str(tmp_path / "u"))
    assert ok == 1 and sorted((r.k, r.error) for r in errors.collect()) == [(2, "several updates"), (3, "not found")]
    assert sorted((r.k, r.v) for r in spark.read.parquet(str(tmp_path / "u")).collect()) == [(1, "z"), (2, "b")]
    new = spark.createDataFrame([(2, "old", 2), (2, "new", 5), (4, "w", 1)], "k int, v string, t int")
    got = sinks.upsert_latest(spark, str(tmp_path / "t"), new, ["k"], "t", str(tmp_path / "w"))
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "a"), (2, "new"), (4, "w")]


def test_series_and_exports(spark, tmp_path):
    p = spark.createDataFrame([("m", "2024-01-01 10:00:00", 1.0, {"a": "b"}), ("n", "2024-03-01 10:00:00", 2.0, None)], "name string, ts string, value double, metadata map<string,string>").withColumn("ts", F.col("ts").cast("timestamp"))
    sinks.append_series(p, str(tmp_path / "s"))
    assert [r.name for r in sinks.retained(spark, str(tmp_path / "s"), 10, "2024-03-05").collect()] == ["n"]
    sinks.export_metrics(p, str(tmp_path / "j"), ["m"])
    assert [(r.name, r.metadata.a) for r in spark.read.json(str(tmp_path / "j")).collect()] == [("m", "b")]
    sinks.export_metrics(p, str(tmp_path / "c"), since="2024-02-01", form="csv")
    assert [r.name for r in spark.read.csv(str(tmp_path / "c"), header=True).collect()] == ["n"]
    d = spark.range(20).select(F.format_string("%02d", "id").alias("k"), F.lit(None).cast("string").alias("v")).orderBy("k")
    sinks.write_records_csv(d, str(tmp_path / "b"), ["k", "v"], numbered="n")
    text = "".join(open(f, encoding="utf-8").read() for f in glob.glob(str(tmp_path / "b" / "*.csv")))
    assert text.startswith("﻿n,k,v") and sorted(int(r.n) for r in spark.read.csv(str(tmp_path / "b"), header=True).toDF("n", "k", "v").collect()) == list(range(1, 21))
    for i in range(2):
        spark.createDataFrame([(1, f"w{i}"), (2 + i, "x")], "k int, v string").write.parquet(str(tmp_path / f"o{i}"))
    assert [(r.k, r.v) for r in sinks.merge_outputs(spark, [str(tmp_path / "o0"), str(tmp_path / "o1")], "k", str(tmp_path / "m")).orderBy("k").collect()] == [(1, "w1"), (2, "x"), (3, "x")]
    f = spark.createDataFrame([(1, ["bad"]), (2, [])], "k int, errors array<string>")
    assert sinks.write_failed(f, str(tmp_path / "f")) == 1
    assert [r.k for r in sinks.preview(f.select("k"), str(tmp_path / "pv"), "k", 1)] == [1]


def test_checkpoint_and_merge_of_settings(spark, tmp_path):
    c = sinks.Checkpoint(spark, str(tmp_path / "c"))
    assert c.load() is None and c.load({"skip": 0}) == {"skip": 0}
    for i in range(4):
        c.save({"skip": i})
    (tmp_path / "c" / "v99").mkdir()  # a save that never finished
    assert c.load() == {"skip": 3}
    assert sinks.deep_merge({"a": {"b": 1, "c": 2}, "d": 1}, {"a": {"b": 3}, "d": {"e": 1}}) == {"a": {"b": 3, "c": 2}, "d": {"e": 1}}


def test_needed_checks_and_reports(spark):
    ch = spark.createDataFrame([(1, "UPDATE", ["a", "zz"]), (2, "insert", None), (3, "delete", []), (1, "update", ["a"])], "key int, op string, changed array<string>")
    got = incremental.needed_checks(ch, {"a": ("x", "y")}, ("x", "y", "z"))
    assert sorted((r.key, r.check_key) for r in got.collect()) == [(1, "x"), (1, "y"), (2, "x"), (2, "y"), (2, "z"), (3, "deleted")]
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "c"), (3, "")], "k int, v string")
    rep = incremental.incremental_scan(old, new, "k", ["v"], {"blank": F.when(F.col("v") == "", "high"), "any": F.lit("low")})
    assert sorted((r.check_key, r.n_issues) for r in rep.collect()) == [("any", 2), ("blank", 1)]
    m = spark.createDataFrame([("m", 1, 12.0), ("m", 2, 7.0), ("m", 3, 1.0), ("n", 1, 50.0)], "name string, ts int, value double")
    b = spark.createDataFrame([("n", 10.0, 5.0)], "name string, mean double, sd double")
    assert sorted((r.name, r.ts, r.severity) for r in incremental.route_alerts(m, {"m": (5, 10)}, b).collect()) == [("m", 1, "critical"), ("m", 2, "warning"), ("n", 1, "anomaly")]
    al = spark.createDataFrame([("x", "critical", False), ("y", "warning", True)], "alert_id string, severity string, resolved boolean")
    out = incremental.resolve(al, spark.createDataFrame([("x",), ("y",)], "alert_id string"))
    assert sorted((r.alert_id, r.severity, r.resolved) for r in out.collect()) == [("x", "critical", True), ("x", "info", True), ("y", "warning", True)]


def test_sessions_changed_rows_late_data_and_monitor(spark, tmp_path):
    rows = [(i, 86400 + i * 600 + (7200 if i > 5 else 0), i % 2, "a", 1.0, "{}") for i in range(12)]
    late = [(99, 86400 - 5 * 3600, 0, "a", 1.0, "{}")]
    frame = lambda rs: spark.createDataFrame(rs, "event_id long, s long, user_id long, event_type string, value double, props string").select("event_id", F.timestamp_seconds("s").alias("ts"), "user_id", "event_type", "value", "props")
    frame(rows).coalesce(1).write.parquet(str(tmp_path / "in"))
    frame([(50, 86400 + 40 * 3600, 0, "a", 1.0, "{}")]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run(df, name):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.table(name).collect()

    got = run(streams.sessions(streams.events(spark, str(tmp_path / "in"))), "sessions_t")
    assert sorted((r.user_id, r.n) for r in got if r.n < 12) == [(0, 3), (0, 3), (1, 3), (1, 3)]
    frame(late).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    counts = run(streams.tumbling(streams.events(spark, str(tmp_path / "in"))), "late_t")
    assert sum(r.n for r in counts) == 12  # the late row is dropped, the newest window is open
    q = incremental.monitor(streams.events(spark, str(tmp_path / "in"), 100), {"rows": lambda d: d.agg(F.count("*").alias("n")), "high": lambda d: d.agg(F.count_if(F.col("value") > 5).alias("n"))}, str(tmp_path / "mo"), str(tmp_path / "mc"))
    q.awaitTermination(120)
    assert sorted((r.check_key, r.n) for r in spark.read.parquet(*glob.glob(str(tmp_path / "mo" / "batch=*" / "part=*"))).collect()) == [("high", 0), ("rows", 14)]


def test_values_by_hand(spark, tmp_path):
    """The metric queries against numbers computed by hand."""
    import datetime as dt

    from docloom.plans import catalogue

    day = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
    rows = [(i, day(i), 1, "m", 10.0 if i < 9 else 100.0, "{}") for i in range(10)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    s = catalogue.QUERIES["metric_summary"](spark, str(tmp_path)).first()
    assert (s.latest, s.p50, s.p95, s.n) == (100.0, 10.0, pytest.approx(10 + 90 * 0.55), 10)
    a = catalogue.QUERIES["metric_anomaly"](spark, str(tmp_path)).collect()
    mean, sd = 19.0, (sum((v - 19) ** 2 for v in [10.0] * 9 + [100.0]) / 9) ** 0.5
    assert [(r.day, r.confidence) for r in a] == [("2024-01-10", pytest.approx((100 - mean - 2 * sd) / sd))]
    spark.createDataFrame([(1, day(0), 7, "click", 1.0, ""), (2, day(1), 7, "purchase", 1.0, ""), (3, day(2), 7, "click", 1.0, ""), (4, day(0), 8, "view", 1.0, "")],
                          "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "d" / "events.parquet"))
    got = {r.event_id: (r.position, r.n_depends, r.n_dropped) for r in catalogue.QUERIES["dependency_order"](spark, str(tmp_path / "d")).collect()}
    assert got == {2: (1, 0, 1), 1: (2, 1, 0), 3: (3, 2, 0), 4: (1, 0, 0)}
