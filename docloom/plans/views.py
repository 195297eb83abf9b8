"""Analytics views: issues, suspicion, dashboards, entity and period metrics."""

from __future__ import annotations

from docloom.plans.dialect import Dialect, registry

BASE_SCORE = (
    "least(greatest(50 + CASE WHEN len < 100 THEN -10 WHEN len > 500 THEN 20 ELSE 10 END"
    " + CASE WHEN slen BETWEEN 50 AND 200 THEN 15 ELSE 0 END + CASE WHEN lang IS NULL THEN -15 ELSE 15 END"
    " + CASE WHEN body IS NULL THEN -10 ELSE 15 END, 0), 100)"
)


def _docs(d: Dialect) -> str:
    """documents with the stand-in columns of a tagged record."""
    return f"""
  SELECT d.doc_id, d.text, d.lang, d.source, length(coalesce(d.text, '')) AS len, least(length(coalesce(d.text, '')), 120) AS slen,
         trim(substring(coalesce(d.text, ''), 1, 60)) AS title, CASE WHEN l.doc_id IS NOT NULL THEN d.source END AS body,
         l.quality, l.toxic
  FROM {d.t('documents')} d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM {d.t('labels')} GROUP BY doc_id) l ON d.doc_id = l.doc_id"""


def issue_summary(d: Dialect) -> str:
    """Issue codes, worst severity and count of each record, worst first."""
    codes = d.compact(
        "CASE WHEN len < 100 THEN 'SHORT_CONTENT' END", "CASE WHEN slen < 50 THEN 'SHORT_SUMMARY' END",
        "CASE WHEN lang IS NULL THEN 'NO_POLICY' END", "CASE WHEN body IS NULL THEN 'NO_BODY' END",
        f"CASE WHEN {d.like('coalesce(text, ' + d.lit('') + ')', '[#%&]{2}')} THEN 'SYMBOL_NOISE' END",
        "CASE WHEN quality = 0 THEN 'LOW_QUALITY' END", "CASE WHEN toxic = 1 THEN 'TOXIC' END")
    return f"""
WITH d AS ({_docs(d)}), i AS (SELECT doc_id, len, slen, lang, body, quality, toxic, {codes} AS issues FROM d)
SELECT doc_id, {d.join('issues', ',')} AS issues, {d.size('issues')} AS issue_count, {d.size('issues')} = 0 AS is_clean,
  CASE WHEN toxic = 1 THEN 'CRITICAL' WHEN len < 100 OR quality = 0 THEN 'HIGH' WHEN lang IS NULL OR body IS NULL THEN 'MEDIUM' ELSE 'LOW' END AS max_severity
FROM i
ORDER BY CASE WHEN toxic = 1 THEN 1 WHEN len < 100 OR quality = 0 THEN 2 WHEN lang IS NULL OR body IS NULL THEN 3 ELSE 4 END, doc_id"""


def _suspicion(d: Dialect) -> str:
    """s: flags and score of each record. Titles meet by digest; no text leaves its row."""
    title = d.swap("title", r"\s+", " ")
    return f"""
f AS (SELECT doc_id, len, slen, lang, source, body, quality, toxic, substring(title, 1, 40) AS preview, md5(trim({title})) AS th, {d.like('text', '!!')} AS shouts, text LIKE '%|%' AS has_table FROM d),
c AS (SELECT th AS ck, count(*) AS n FROM f GROUP BY th HAVING count(*) > 1),
s AS (SELECT doc_id, len, slen, lang, source, body, quality, toxic, preview, {d.compact("CASE WHEN len < 50 THEN 'TINY' END", "CASE WHEN n > 1 THEN 'DUPLICATE_TITLE' END", "CASE WHEN shouts THEN 'SHOUTING' END", "CASE WHEN has_table THEN 'TABLE' END")} AS flags,
  CASE WHEN len < 50 THEN 40 ELSE 0 END + CASE WHEN n > 1 THEN 25 ELSE 0 END + CASE WHEN shouts THEN 30 ELSE 0 END + CASE WHEN has_table THEN 15 ELSE 0 END AS score FROM f LEFT JOIN c ON th = ck)"""


RISK = "CASE WHEN score >= 70 THEN 'CRITICAL' WHEN score >= 50 THEN 'HIGH' WHEN score >= 30 THEN 'MEDIUM' WHEN score >= 15 THEN 'LOW' ELSE 'MINIMAL' END"


def suspicious_records(d: Dialect) -> str:
    """Weighted suspicion flags and risk level of records with any flag."""
    return f"""WITH d AS ({_docs(d)}), {_suspicion(d)}
SELECT doc_id, preview, {d.join('flags', ',')} AS flags, {d.long('score')} AS suspicion_score, {RISK} AS risk_level
FROM s WHERE score > 0 ORDER BY score DESC, doc_id"""


def quality_dashboard(d: Dialect) -> str:
    """One row: base counts, tier, severity and risk histograms by filtered aggregates over one pass."""
    high = "(len < 100 OR quality = 0)"
    return f"""
WITH d AS ({_docs(d)}), {_suspicion(d)},
q AS (SELECT *, {BASE_SCORE} AS quality_score FROM s)
SELECT count(*) AS total, count(DISTINCT lang) AS n_lang, count(DISTINCT source) AS n_source, {d.long('min(len)')} AS min_len, {d.long('max(len)')} AS max_len, avg(CASE WHEN body IS NOT NULL THEN {d.double('len')} END) AS avg_labelled_len,
  {d.flag('quality_score >= 90')} AS excellent, {d.flag('quality_score >= 75 AND quality_score < 90')} AS good, {d.flag('quality_score >= 60 AND quality_score < 75')} AS fair, {d.flag('quality_score < 60')} AS poor, avg({d.double('quality_score')}) AS avg_score,
  {d.flag('toxic = 1')} AS critical, {d.flag(f'coalesce(toxic, 0) <> 1 AND {high}')} AS high, {d.flag(f'coalesce(toxic, 0) <> 1 AND NOT coalesce({high}, false) AND (lang IS NULL OR body IS NULL)')} AS medium,
  {d.flag('coalesce(toxic, 0) <> 1 AND NOT coalesce(' + high + ', false) AND lang IS NOT NULL AND body IS NOT NULL')} AS low,
  {d.flag('score >= 70')} AS risk_critical, {d.flag('score >= 50 AND score < 70')} AS risk_high, {d.flag('score >= 30 AND score < 50')} AS risk_medium, {d.flag('score >= 15 AND score < 30')} AS risk_low, {d.flag('score < 15')} AS risk_minimal FROM q"""


def entity_analysis(d: Dialect) -> str:
    """Counts, length range, mean score, label rate and languages of each source."""
    return f"""
WITH d AS ({_docs(d)})
SELECT source, count(*) AS n, {d.long('min(len)')} AS min_len, {d.long('max(len)')} AS max_len, avg({d.double(BASE_SCORE)}) AS avg_score,
  {d.double('count(body)')} / count(*) * 100 AS label_rate, {d.join(d.gather_set('lang'), ',')} AS langs
FROM d GROUP BY source"""


def period_metrics(d: Dialect) -> str:
    """Named metrics of five look-back periods as rows: orders are summed once, periods are conditional sums over them, rows come from one unpivot."""
    periods = [("1d", 1), ("7d", 7), ("30d", 30), ("90d", 90), ("1y", 365)]
    sums = ", ".join(f"{d.flag(f'age < {n}')} AS n{n}, coalesce({d.long(f'sum(CASE WHEN age < {n} THEN n_lines END)')}, 0) AS l{n}, coalesce(sum(CASE WHEN age < {n} THEN revenue END), 0) AS r{n}" for _, n in periods)
    rows = d.array(*[d.struct(period=f"'{p}'", metric=f"'{m}'", value=e) for p, n in periods for m, e in (
        ("orders", d.double(f"n{n}")), ("lines", d.double(f"l{n}")), ("revenue", d.double(f"r{n}")), ("work", f"CASE WHEN l{n} > 0 THEN {d.double(f'r{n}')} / l{n} / 1000 + 2.5 ELSE CAST(0 AS DOUBLE) END"))])
    return f"""
WITH l AS (SELECT l_orderkey, count(l_orderkey) AS n_lines, sum(l_extendedprice) AS revenue FROM {d.t('lineitem')} GROUP BY l_orderkey), m AS (SELECT max(o_orderdate) AS as_of FROM {d.t('orders')}),
o AS (SELECT n_lines, revenue, {d.days('as_of', 'o_orderdate')} AS age FROM {d.t('orders')} JOIN l ON o_orderkey = l_orderkey CROSS JOIN m),
a AS (SELECT {sums} FROM o), x AS (SELECT {d.each(rows)} AS x FROM a) SELECT x.period AS period, x.metric AS metric, x.value AS value FROM x"""


def table_health(d: Dialect) -> str:
    """Health rows: volume, text coverage, label coverage, activity."""
    docs, labels = d.t("documents"), d.t("labels")
    status = lambda x, hi, lo: f"CASE WHEN {x} >= {hi} THEN 'OK' WHEN {x} >= {lo} THEN 'WARNING' ELSE 'CRITICAL' END"
    rows = [("volume", f"(SELECT {d.double('count(*)')} AS v FROM {docs})", 100, 10),
            ("text_coverage", f"(SELECT 100 * {d.double('count(text)')} / count(*) AS v FROM {docs})", 95, 80),
            ("label_coverage", f"(SELECT 100 * {d.double('count(DISTINCT l.doc_id)')} / count(DISTINCT d.doc_id) AS v FROM {docs} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id)", 80, 30),
            ("sources", f"(SELECT {d.double('count(DISTINCT source)')} AS v FROM {docs})", 10, 2)]
    return " UNION ALL ".join(f"SELECT '{n}' AS check_name, v AS value, {status('v', hi, lo)} AS status FROM {q} x" for n, q, hi, lo in rows)


def approval_digest(d: Dialect) -> str:
    """Count, date range and numeric id range of each status."""
    return f"""SELECT o_orderstatus, count(*) AS n, {d.day('min(o_orderdate)')} AS first_date, {d.day('max(o_orderdate)')} AS last_date,
  min(try_cast(o_orderkey AS BIGINT)) AS min_id, max(try_cast(o_orderkey AS BIGINT)) AS max_id, min(substring({d.day('o_orderdate')}, 1, 4)) AS first_year
FROM {d.t('orders')} GROUP BY o_orderstatus"""


def discovery_breakdown(d: Dialect) -> str:
    """Orders by nation, year and both, with the totals of a rollup."""
    return f"""SELECT coalesce(n_name, '*') AS nation, coalesce(yr, '*') AS yr, count(*) AS n, {d.flag('o_totalprice IS NULL')} AS n_missing
FROM (SELECT n_name, substring({d.day('o_orderdate')}, 1, 4) AS yr, o_totalprice FROM {d.t('orders')} JOIN {d.t('customer')} ON o_custkey = c_custkey JOIN {d.t('nation')} ON c_nationkey = n_nationkey) x
GROUP BY ROLLUP (n_name, yr)"""


def top_nations(d: Dialect) -> str:
    """The ten nations with most orders."""
    return f"""SELECT n_name, count(*) AS n FROM {d.t('orders')} JOIN {d.t('customer')} ON o_custkey = c_custkey JOIN {d.t('nation')} ON c_nationkey = n_nationkey
GROUP BY n_name ORDER BY n DESC, n_name LIMIT 10"""


def quality_grade(d: Dialect) -> str:
    """Mean of four coverage percentages and its grade, by source."""
    return f"""
WITH d AS ({_docs(d)}),
c AS (SELECT source, 100 * ({d.double('count(text)')} + {d.flag('slen >= 50')} + count(lang) + count(body)) / (4 * count(*)) AS coverage FROM d GROUP BY source)
SELECT source, coverage, CASE WHEN coverage >= 95 THEN 'A' WHEN coverage >= 85 THEN 'B+' WHEN coverage >= 75 THEN 'B' WHEN coverage >= 60 THEN 'C' ELSE 'D' END AS grade FROM c"""


def _unpivot(d: Dialect, items: dict[str, str], name: str, value: str) -> str:
    """An array of (name, value) rows."""
    return d.array(*[d.struct(**{name: f"'{k}'", value: e}) for k, e in items.items()])


def missing_fields(d: Dialect) -> str:
    """Missing rate of each field, and of any: counted in one pass, then unpivoted."""
    fields = {"text": "text IS NULL OR trim(text) = ''", "lang": "lang IS NULL", "body": "body IS NULL", "quality": "quality IS NULL", "title": "title = ''"}
    fields["any"] = " OR ".join(f"({c})" for c in fields.values())
    return f"""WITH d AS ({_docs(d)}), c AS (SELECT count(*) AS n, {', '.join(f'{d.flag(c)} AS n_{k}' for k, c in fields.items())} FROM d),
x AS (SELECT n, {d.each(_unpivot(d, {k: f'n_{k}' for k in fields}, 'field', 'm'))} AS x FROM c) SELECT x.field AS field, x.m AS n_missing, {d.double('x.m')} / n AS rate FROM x"""


def fixer_candidates(d: Dialect) -> str:
    """Rows each fixer would take up, in one pass."""
    fixers = {"short_content": "len < 100", "summaries": "slen < 50", "policy_tags": "lang IS NULL", "body_tags": "body IS NULL", "low_quality": "quality = 0", "special": "toxic = 1"}
    return f"WITH d AS ({_docs(d)}), x AS (SELECT doc_id, {d.each(d.compact(*[f'CASE WHEN {c} THEN {d.lit(n)} END' for n, c in fixers.items()]))} AS fixer FROM d) SELECT fixer, doc_id FROM x"


def detect_fix_counts(d: Dialect) -> str:
    """Detected and fixable issues by kind, in one pass."""
    kinds = {"content": ("len < 100", "len BETWEEN 50 AND 99"), "body": ("body IS NULL", "body IS NULL AND source IS NOT NULL"), "quality": ("quality = 0", "quality = 0 AND len > 500")}
    rows = d.array(*[d.struct(issue=f"'{k}'", detected=f"d_{k}", fixable=f"f_{k}") for k in kinds])
    return f"""WITH d AS ({_docs(d)}), c AS (SELECT count(*) AS n, {', '.join(f'{d.flag(a)} AS d_{k}, {d.flag(b)} AS f_{k}' for k, (a, b) in kinds.items())} FROM d),
x AS (SELECT n, {d.each(rows)} AS x FROM c) SELECT x.issue AS issue, n AS checked, x.detected AS detected, x.fixable AS fixable FROM x"""


QUERIES, ORACLES = registry(issue_summary, suspicious_records, quality_dashboard, entity_analysis, period_metrics, table_health,
                            approval_digest, discovery_breakdown, top_nations, quality_grade, missing_fields, fixer_candidates, detect_fix_counts)
