"""Metric time series over events: periods, summaries, trend, anomaly, health, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import graph, selection
from docloom.operators.records import cut
from docloom.plans.dialect import DUCK, Dialect, registry
from docloom.session import table


def _period_sql(unit: str) -> str:
    """DuckDB: count, range, mean, median and deviation by type and period."""
    d = DUCK
    period = d.day("CAST(ts AS DATE) - CAST(dayofweek(ts) AS INTEGER) + 1") if unit == "week" else d.stamp(f"date_trunc('{unit}', ts)")
    return f"""SELECT event_type, {period} AS period, count(*) AS n, min(value) AS lo, max(value) AS hi, avg(value) AS mean, quantile_cont(value, 0.5) AS median, coalesce(stddev_samp(value), 0) AS stdev FROM events GROUP BY 1, 2"""


def _period(unit: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        e = table(spark, sf_dir, "events")
        if unit == "week":  # weeks start on Sunday; the week is named by its Monday
            day = F.to_date("ts")
            period = F.date_format(F.date_add(F.date_sub(day, F.dayofweek(day) - 1), 1), "yyyy-MM-dd")
        else:
            period = F.date_format(F.date_trunc(unit, "ts"), "yyyy-MM-dd HH:mm:ss")
        e = e.select("event_type", period.alias("period"), "value")
        by = ["event_type", "period"]
        facts = [F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.avg("value").alias("mean"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("stdev")]
        return _with_percentiles(e, by, facts, (0.5,), ("median",)).select(*by, "n", "lo", "hi", "mean", "median", "stdev")

    q.__name__, q.__doc__ = f"metric_periods_{unit}", f"Count, range, mean, median and deviation by type and {unit}."
    return q


def _with_percentiles(rows: DataFrame, by: list[str], facts: list, ps: tuple[float, ...], names: tuple[str, ...]) -> DataFrame:
    """Facts and percentiles by group: in one aggregate while every group is small, else joined from a selection."""
    most = rows.groupBy(*by).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    if most <= selection.WHOLE:
        every = rows.groupBy(*by).agg(*facts, F.percentile("value", F.array(*map(F.lit, ps))).alias("__q"))
        return every.select("*", *[F.col("__q")[i].alias(n) for i, n in enumerate(names)]).drop("__q")
    q = selection.percentiles(rows, by, "value", ps, selection.WHOLE).select(*[F.col(c).alias(f"__{c}") for c in by], *[F.col(f"q{i}").alias(n) for i, n in enumerate(names)])
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return rows.groupBy(*by).agg(*facts).join(q, same, "left").drop(*[f"__{c}" for c in by])


SUMMARY = (0.25, 0.5, 0.75, 0.9, 0.95)


def metric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest value, range, mean and percentiles of each metric, negatives left out."""
    e = table(spark, sf_dir, "events").where("value >= 0").select("event_type", "ts", "event_id", "value")
    facts = [F.count("*").alias("n"), F.max_by("value", F.struct("ts", "event_id")).alias("latest"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.avg("value").alias("mean"),
             F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("stdev")]
    names = tuple(f"p{int(p * 100)}" for p in SUMMARY)
    return _with_percentiles(e, ["event_type"], facts, SUMMARY, names).select("event_type", "n", "latest", "lo", "hi", "mean", "stdev", *names)


def _summary_sql() -> str:
    return f"""SELECT event_type, count(*) AS n, first(value ORDER BY ts DESC, event_id DESC) AS latest, min(value) AS lo, max(value) AS hi, avg(value) AS mean, coalesce(stddev_samp(value), 0) AS stdev,
  {', '.join(f'quantile_cont(value, {p}) AS p{int(p * 100)}' for p in SUMMARY)} FROM events WHERE value >= 0 GROUP BY event_type"""


def _daily(d: Dialect) -> str:
    return f"daily AS (SELECT event_type, {d.day('ts')} AS day, avg(value) AS value FROM {d.t('events')} GROUP BY event_type, {d.day('ts')})"


def metric_trend(d: Dialect) -> str:
    """Mean of the five samples before against the five before those, with a 5% dead band."""
    w = "OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN {} PRECEDING AND {} PRECEDING)"
    return f"""WITH {_daily(d)}, t AS (SELECT event_type, day, value, avg(value) {w.format(5, 1)} AS recent, avg(value) {w.format(10, 6)} AS older, count(*) {w.format(1000, 1)} AS seen FROM daily)
SELECT event_type, day, CASE WHEN seen < 3 OR older IS NULL THEN 'unknown' WHEN recent > older * 1.05 THEN 'up' WHEN recent < older * 0.95 THEN 'down' ELSE 'stable' END AS trend FROM t"""


def metric_anomaly(d: Dialect) -> str:
    """Values outside two deviations of the last 1000 samples (itself included); the confidence is the distance beyond the bound in deviations, at most 1; from 0.7 on it alerts."""
    w = "OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)"
    beyond = "least((abs(value - m) - 2 * sd) / sd, 1)"
    return f"""WITH {_daily(d)}, s AS (SELECT event_type, day, value, avg(value) {w} AS m, stddev_samp(value) {w} AS sd, count(*) {w} AS n FROM daily)
SELECT event_type, day, {beyond} AS confidence, {beyond} >= 0.7 AS alerts FROM s WHERE n >= 10 AND sd > 0 AND abs(value - m) > 2 * sd"""


def health_score(d: Dialect) -> str:
    """Mean of each metric's 0 to 100 score against its critical threshold."""
    return f"""WITH m AS (SELECT event_type, avg(value) AS v FROM {d.t('events')} GROUP BY event_type),
s AS (SELECT event_type, CASE WHEN event_type = 'error' THEN least(greatest(100 * (1 - v / 100), 0), 100) ELSE least(greatest(100 * v / 60, 0), 100) END AS score FROM m)
SELECT avg(score) AS health, min(score) AS worst, count(*) AS n FROM s"""


def alert_stats(d: Dialect) -> str:
    """Alerts of the last day of the stream by severity and metric."""
    return f"""WITH m AS (SELECT max(ts) AS as_of FROM {d.t('events')})
SELECT CASE WHEN value > 150 THEN 'critical' WHEN value > 75 THEN 'warning' ELSE 'info' END AS severity, event_type, count(*) AS n FROM {d.t('events')} CROSS JOIN m WHERE ts > as_of - INTERVAL '24' HOUR GROUP BY 1, 2"""


def retention(d: Dialect) -> str:
    """Rows kept and dropped by age: raw rows stay 10 days."""
    return f"WITH m AS (SELECT max(ts) AS as_of FROM {d.t('events')}) SELECT ts >= as_of - INTERVAL '240' HOUR AS kept, count(*) AS n FROM {d.t('events')} CROSS JOIN m GROUP BY 1"


def alert_lifecycle(d: Dialect) -> str:
    """Alert ids by metric and severity with first and last time and state."""
    return f"""SELECT substring(md5(event_type || '_' || sev), 1, 12) AS alert_id, event_type, sev AS severity, {d.stamp('min(ts)')} AS opened, {d.stamp('max(ts)')} AS last_seen, count(*) AS n, CASE WHEN count(*) > 100 THEN 'open' ELSE 'resolved' END AS state
FROM (SELECT event_type, ts, CASE WHEN value > 150 THEN 'critical' ELSE 'warning' END AS sev FROM {d.t('events')} WHERE value > 75) x GROUP BY event_type, sev"""


def json_flatten(d: Dialect) -> str:
    """Nested JSON properties as columns, required key checked."""
    return f"SELECT event_id, try_cast({d.json('props', 'k')} AS BIGINT) AS k, {d.json('props', 'k')} IS NOT NULL AS has_k FROM {d.t('events')}"


def confidence_rollup(d: Dialect) -> str:
    """Mean of positive confidences by label, clamped; overall as the mean of both, or the larger if one is zero."""
    return f"""WITH c AS (SELECT event_type, least(greatest(coalesce(try_cast({d.json('props', 'k')} AS DOUBLE) / 100, 0.5), 0), 1) AS a, least(greatest(value / 100, 0), 1) AS b FROM {d.t('events')}),
m AS (SELECT event_type, coalesce(avg(CASE WHEN a > 0 THEN a END), 0) AS conf_a, coalesce(avg(CASE WHEN b > 0 THEN b END), 0) AS conf_b FROM c GROUP BY event_type)
SELECT event_type, conf_a, conf_b, CASE WHEN conf_a = 0 OR conf_b = 0 THEN greatest(conf_a, conf_b) ELSE (conf_a + conf_b) / 2 END AS overall FROM m"""


def stream_tumbling(d: Dialect) -> str:
    """Batch form of the hourly tumbling aggregate that ``streaming`` keeps up to date."""
    return f"SELECT event_type, {d.stamp("date_trunc('hour', ts)")} AS window_start, count(*) AS n, sum(value) AS total FROM {d.t('events')} GROUP BY 1, 2"


def stream_dedup(d: Dialect) -> str:
    """The first event of each user and type in an hour."""
    return f"SELECT user_id, event_type, {d.stamp("date_trunc('hour', ts)")} AS hour, min(event_id) AS first_id FROM {d.t('events')} GROUP BY 1, 2, 3"


def stream_session(d: Dialect) -> str:
    """Sessions of a user: a gap of 30 minutes or more starts a new one. Days are numbered apart and put together, so a user of very many events is no window."""
    if not d.spark:
        return f"""WITH g AS (SELECT user_id, ts, event_id, value, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL '30' MINUTE THEN 0 ELSE 1 END AS opens FROM {d.t('events')}),
s AS (SELECT user_id, ts, value, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT user_id, {d.long('session')} AS session, count(*) AS n, {d.stamp('min(ts)')} AS started, sum(value) AS total FROM s GROUP BY user_id, session"""
    same = "x.user_id <=> y.user_id AND x.day <=> y.day"
    return f"""WITH e AS (SELECT user_id, ts, event_id, value, CAST(ts AS DATE) AS day FROM {d.t('events')}),
m AS (SELECT user_id, day, max(ts) AS last_ts FROM e GROUP BY user_id, day), p AS (SELECT user_id, day, lag(last_ts) OVER (PARTITION BY user_id ORDER BY day) AS before_ts FROM m),
g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS near FROM e),
o AS (SELECT x.*, CASE WHEN ts < coalesce(near, before_ts) + INTERVAL '30' MINUTE THEN 0 ELSE 1 END AS opens FROM g x JOIN p y ON {same}),
c AS (SELECT user_id, day, sum(opens) AS n FROM o GROUP BY user_id, day), b AS (SELECT user_id, day, sum(n) OVER (PARTITION BY user_id ORDER BY day) - n AS before FROM c),
s AS (SELECT x.user_id, ts, value, before + sum(opens) OVER (PARTITION BY x.user_id, x.day ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM o x JOIN b y ON {same})
SELECT user_id, {d.long('session')} AS session, count(*) AS n, {d.stamp('min(ts)')} AS started, sum(value) AS total FROM s GROUP BY user_id, session"""


def as_of_join(d: Dialect) -> str:
    """Each purchase with the last earlier click of its user: windows within days, and the newest click of earlier days; no range join, no window over all of a user's events."""
    click = "CASE WHEN event_type = 'click' THEN ts END"
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    if not d.spark:
        return f"""WITH e AS (SELECT user_id, ts, event_id, event_type, max({click}) OVER (PARTITION BY user_id ORDER BY ts, event_id {before}) AS click_ts FROM {d.t('events')})
SELECT event_id, user_id, {d.stamp('click_ts')} AS click_at FROM e WHERE event_type = 'purchase'"""
    return f"""WITH e AS (SELECT user_id, ts, event_id, event_type, CAST(ts AS DATE) AS day FROM {d.t('events')} WHERE event_type IN ('click', 'purchase')),
m AS (SELECT user_id, day, max({click}) AS m FROM e GROUP BY user_id, day), p AS (SELECT user_id, day, max(m) OVER (PARTITION BY user_id ORDER BY day {before}) AS far FROM m),
w AS (SELECT *, max({click}) OVER (PARTITION BY user_id, day ORDER BY ts, event_id {before}) AS near FROM e)
SELECT event_id, w.user_id, {d.stamp('coalesce(near, far)')} AS click_at FROM w JOIN p ON w.user_id <=> p.user_id AND w.day <=> p.day WHERE event_type = 'purchase'"""


QUERIES, ORACLES = registry(metric_trend, metric_anomaly, health_score, alert_stats, retention, alert_lifecycle, json_flatten,
                            confidence_rollup, stream_tumbling, stream_dedup, stream_session, as_of_join)

COOLDOWN_S = {"critical": 3600, "warning": 6 * 3600}


def alert_cooldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts sent: one only if the last one sent for the metric and severity is a cooldown away (greedy).

    Times meet in blocks of a minute and by doubling pointers, so a metric with all
    alerts is in no task as a whole; the stream form keeps one number a group
    (``streaming.cooldown``).
    """
    e = table(spark, sf_dir, "events").where("value > 75").select(
        "event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.when(F.col("value") > 150, "critical").otherwise("warning").alias("severity"))
    by = ["event_type", "severity"]
    thin = cut(e.groupBy(*by, "at").agg(F.min("event_id").alias("event_id")))
    wait = F.when(F.col("severity") == "critical", COOLDOWN_S["critical"] * 1_000_000).otherwise(COOLDOWN_S["warning"] * 1_000_000)
    sent = selection.greedy(thin.withColumn("wait", wait.cast("long")), by, "at", "wait", 60_000_000)
    sent = sent.select(*[F.col(c).alias(f"__{c}") for c in (*by, "at")])
    same = (F.col("at") == F.col("__at")) & F.col("event_type").eqNullSafe(F.col("__event_type")) & (F.col("severity") == F.col("__severity"))
    return thin.join(sent, same).select("event_id", *by)


def ema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exponential moving average 0.9 / 0.1 of the daily values of each metric: an ordered fold over days."""
    daily = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.avg("value").alias("v"))
    series = daily.groupBy("event_type").agg(F.sort_array(F.collect_list(F.struct("day", "v"))).alias("s"))
    return series.select("event_type", F.aggregate(F.slice("s", 2, 1 << 30), F.col("s")[0]["v"], lambda a, x: a * 0.9 + x["v"] * 0.1).alias("ema"))


def dependency_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of each record in an order that respects their dependencies, with the number of changes each depends on.

    A change of the class (here a purchase) comes before every change of the tags
    (a click) of its record; a change of the tags before every later change. Where
    both say the opposite the second rule yields (``n_dropped`` dependencies), as in
    any order. Positions and counts are kept by day, so a hot record is no window.
    """
    table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.to_date("ts").alias("day"), (F.col("event_type") == "purchase").alias("c"), (F.col("event_type") == "click").alias("t")).createOrReplaceTempView("docloom_changes")
    return spark.sql("""
WITH n AS (SELECT user_id, c, day, count(*) AS n FROM docloom_changes GROUP BY user_id, c, day),
o AS (SELECT user_id, c, day, sum(n) OVER (PARTITION BY user_id ORDER BY c DESC, day ROWS UNBOUNDED PRECEDING) - n AS before FROM n),
p AS (SELECT user_id, day, count_if(t) AS nt, count_if(c) AS nc FROM docloom_changes GROUP BY user_id, day),
b AS (SELECT user_id, day, sum(nt) OVER (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING) - nt AS t_before, sum(nc) OVER (PARTITION BY user_id) AS c_all FROM p),
k AS (SELECT x.event_id, x.user_id, x.c, x.t, before + row_number() OVER (PARTITION BY x.user_id, x.c, x.day ORDER BY ts, event_id) AS position,
  t_before + sum(int(x.t)) OVER (PARTITION BY x.user_id, x.day ORDER BY ts) - sum(int(x.t)) OVER (PARTITION BY x.user_id, x.day, ts) AS earlier, c_all
  FROM docloom_changes x JOIN o ON x.user_id <=> o.user_id AND x.c = o.c AND x.day <=> o.day JOIN b ON x.user_id <=> b.user_id AND x.day <=> b.day)
SELECT event_id, user_id, position, IF(c, 0L, earlier) + IF(t, c_all, 0L) AS n_depends, IF(c, earlier, 0L) AS n_dropped FROM k""")


def dependency_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of a record and day by level: 0 waits for nothing, -1 stands in or between cycles, -2 behind one.

    Edges are a table: a change of the tags (here a click) comes before every later
    change of its record, one of the class (a purchase) before every change of the
    tags. Levels come from peeling, round after round.
    """
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", F.concat_ws(" ", "user_id", F.to_date("ts")).alias("record")).where("user_id IS NOT NULL")
    is_type = lambda t: F.col("event_type") == t
    edges = graph.dependency_edges(e, "record", "event_id", "ts", is_type("click"), (is_type("purchase"), is_type("click")))
    return graph.levels(e, edges, "event_id")


QUERIES.update(dependency_levels=dependency_levels)
ORACLES["dependency_levels"] = """
WITH RECURSIVE x AS (SELECT event_id AS id, user_id, CAST(ts AS DATE) AS day, ts, event_type = 'click' AS t, event_type = 'purchase' AS c FROM events WHERE user_id IS NOT NULL),
e AS (SELECT DISTINCT a.id AS o, b.id FROM x a JOIN x b ON a.user_id = b.user_id AND a.day = b.day AND a.id <> b.id AND ((a.t AND b.ts > a.ts) OR (a.c AND b.t))),
r AS (SELECT o AS a, id AS b FROM e UNION SELECT r.a, e.id FROM r JOIN e ON r.b = e.o),
cyc AS (SELECT a AS id FROM r WHERE a = b), behind AS (SELECT DISTINCT b AS id FROM r WHERE a IN (SELECT id FROM cyc)), ahead AS (SELECT DISTINCT a AS id FROM r WHERE b IN (SELECT id FROM cyc)),
free AS (SELECT id FROM x WHERE id NOT IN (SELECT id FROM behind)),
l AS (SELECT id, 0::BIGINT AS k FROM free UNION SELECT e.id, k + 1 FROM l JOIN e ON l.id = e.o JOIN free f ON f.id = e.id)
SELECT id AS event_id, max(k) AS level FROM l GROUP BY id UNION ALL SELECT id, CASE WHEN id IN (SELECT id FROM ahead) THEN -1 ELSE -2 END FROM behind"""
QUERIES.update(alert_cooldown=alert_cooldown, ema=ema, dependency_order=dependency_order, metric_summary=metric_summary)
ORACLES["metric_summary"] = _summary_sql()
for _unit in ("hour", "day", "week"):
    QUERIES[f"metric_periods_{_unit}"], ORACLES[f"metric_periods_{_unit}"] = _period(_unit), _period_sql(_unit)
ORACLES["alert_cooldown"] = """
WITH RECURSIVE a AS (SELECT event_type, CASE WHEN value > 150 THEN 'critical' ELSE 'warning' END AS severity, ts, event_id FROM events WHERE value > 75),
s AS (SELECT event_type, severity, min(ts) AS ts FROM a GROUP BY 1, 2
  UNION ALL SELECT s.event_type, s.severity, (SELECT min(a.ts) FROM a WHERE a.event_type = s.event_type AND a.severity = s.severity AND a.ts >= s.ts + CASE s.severity WHEN 'critical' THEN INTERVAL 1 HOUR ELSE INTERVAL 6 HOUR END)
  FROM s WHERE s.ts IS NOT NULL)
SELECT min(a.event_id) AS event_id, a.event_type, a.severity FROM s JOIN a ON a.event_type = s.event_type AND a.severity = s.severity AND a.ts = s.ts GROUP BY a.event_type, a.severity, a.ts"""
ORACLES["ema"] = """
WITH RECURSIVE d AS (SELECT event_type, CAST(ts AS DATE) AS day, avg(value) AS v FROM events GROUP BY 1, 2),
n AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day) AS i, count(*) OVER (PARTITION BY event_type) AS c FROM d),
e AS (SELECT event_type, i, c, v AS ema FROM n WHERE i = 1 UNION ALL SELECT n.event_type, n.i, n.c, e.ema * 0.9 + n.v * 0.1 FROM e JOIN n ON n.event_type = e.event_type AND n.i = e.i + 1)
SELECT event_type, ema FROM e WHERE i = c"""
ORACLES["dependency_order"] = """
WITH x AS (SELECT event_id, user_id, ts, event_type = 'purchase' AS c, event_type = 'click' AS t FROM events),
e AS (SELECT a.event_id, a.user_id, a.c, b.event_id AS on_id, a.t AND b.c AS first_rule FROM x a JOIN x b ON a.user_id = b.user_id AND a.event_id <> b.event_id AND ((a.t AND b.c) OR (b.t AND b.ts < a.ts))),
k AS (SELECT e.event_id, count(*) FILTER (NOT e.c) AS n_depends, count(*) FILTER (e.c) AS n_dropped FROM e GROUP BY e.event_id)
SELECT x.event_id, x.user_id, row_number() OVER (PARTITION BY x.user_id ORDER BY c DESC, CAST(ts AS DATE), ts, x.event_id) AS position, coalesce(n_depends, 0) AS n_depends, coalesce(n_dropped, 0) AS n_dropped FROM x LEFT JOIN k USING (event_id)"""
