"""Percentiles and cooldowns of skewed groups against plain Python."""

import random
import statistics

import numpy as np
import pytest

from docloom.operators import selection
from docloom.plans import catalogue


@pytest.mark.parametrize("whole", [0, 10**9])
def test_percentiles_of_heavy_tails(spark, whole):
    rng = random.Random(1)
    groups = {
        "heavy": [rng.paretovariate(0.5) for _ in range(20_000)], "same": [7.0] * 5000, "two": [1.0] * 3000 + [1e18] * 3000, "few": [3.0, 1.0], "one": [5.0], None: [float(i) for i in range(4001)],
        "outlier": [rng.random() for _ in range(9999)] + [1e300], "steps": [float(i // 700) for i in range(7000)]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("none", None), ("few", None)]
    rng.shuffle(rows)
    ps = (0.0, 0.25, 0.5, 0.9, 0.999, 1.0)
    got = {r.g: r[1:] for r in selection.percentiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", ps, whole).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g] == pytest.approx(tuple(np.quantile(vs, ps)), rel=1e-12), g


def test_a_heavy_tail_is_ranked_by_few_rows(spark):
    """The rows that are ranked stay few although nearly all values are in one part in a million of the range."""
    df = spark.range(300_000).selectExpr("'g' AS g", "CASE WHEN id = 0 THEN 1e12 ELSE rand(3) END AS v")
    q = selection.percentiles(df, ["g"], "v", (0.5,), 0)
    assert 0.49 < q.first().q0 < 0.51


def greedy(points, wait):
    out, last = [], None
    for p in sorted(set(points)):
        if last is None or p >= last + wait:
            out.append(p)
            last = p
    return out


@pytest.mark.parametrize("block,whole", [(7, 0), (60, 0), (10_000, 0), (60, 10**6)])
def test_cooldown_equals_the_fold(spark, block, whole):
    rng = random.Random(2)
    groups = {"a": ([rng.randrange(20_000) for _ in range(900)], 50), "b": ([rng.randrange(100_000) for _ in range(60)], 3000), "c": ([5], 10), None: (list(range(0, 700, 3)), 10), "d": ([0, 10, 20, 20, 29, 30, 40], 10)}
    rows = [(g, t, w) for g, (ts, w) in groups.items() for t in ts]
    got = {}
    for r in selection.greedy(spark.createDataFrame(rows, "g string, t long, w long"), ["g"], "t", "w", block, whole).collect():
        got.setdefault(r.g, []).append(r.t)
    assert {g: sorted(ts) for g, ts in got.items()} == {g: greedy(ts, w) for g, (ts, w) in groups.items()}


def test_one_metric_has_all_alerts(spark, tmp_path, monkeypatch):
    import datetime as dt

    monkeypatch.setattr(selection.greedy, "__defaults__", (0,))

    t0 = dt.datetime(2024, 1, 1)
    rng = random.Random(3)
    rows = [(i, t0 + dt.timedelta(seconds=rng.randrange(40 * 86400)), 1, "m", 160.0, "{}") for i in range(5000)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    got = {r.event_id for r in catalogue.QUERIES["alert_cooldown"](spark, str(tmp_path)).collect()}
    want = greedy([int((r[1] - t0).total_seconds()) for r in rows], 3600)
    first = {}
    for r in rows:
        s = int((r[1] - t0).total_seconds())
        first[s] = min(first.get(s, r[0]), r[0])
    assert got == {first[s] for s in want}


def test_medians_by_selection_equal_those_by_aggregate(spark, monkeypatch):
    want = sorted(map(str, catalogue.QUERIES["metric_periods_day"](spark, "/root/testdata/sf0.001").collect()))
    monkeypatch.setattr(selection, "WHOLE", 0)
    got = sorted(map(str, catalogue.QUERIES["metric_periods_day"](spark, "/root/testdata/sf0.001").collect()))
    assert got == want and statistics.median([1, 2]) == 1.5
