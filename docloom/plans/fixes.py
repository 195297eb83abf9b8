"""Fixes of record values, key formats and rewrites, consistency of texts, and page texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.plans.checks import BODIES, TAGS, _base
from docloom.plans.dialect import Dialect, registry
from docloom.session import table
from docloom.sources import html

#: fixed values: the special types of a key
KEY_TYPES = "COMMITTEE|SECURITY|ECON|SPECIAL"



def fix_locations(d: Dialect) -> str:
    """Claimed places without evidence are dropped: the name, or each of its words of three letters or more, must stand in the text."""
    claimed = d.array("'atlantis'", "'north bank'", "source", "regexp_extract(low, '([a-z]+)', 1)")
    words = d.keep("split(c, ' ')", "w", "length(w) > 2 AND NOT contains(low, w)")
    kept = d.keep("claimed", "c", f"c IS NOT NULL AND (contains(low, c) OR (length(c) > 2 AND {d.size(words)} = 0))")
    return f"""WITH t AS (SELECT doc_id, source, lower(coalesce(text, '')) AS low FROM {d.t('documents')}),
c AS (SELECT doc_id, low, {d.keep(claimed, 'c', "c IS NOT NULL AND c <> ''")} AS claimed FROM t),
k AS (SELECT doc_id, claimed, {kept} AS kept FROM c)
SELECT doc_id, {d.join('claimed', ', ')} AS old_value, {d.join('kept', ', ')} AS new_value, {d.size('claimed')} - {d.size('kept')} AS n_dropped FROM k WHERE {d.size('claimed')} <> {d.size('kept')}"""


def fix_bodies(d: Dialect) -> str:
    """Bodies that the text neither names nor implies (two keywords of a tag that expects them) are dropped."""
    claimed = d.array("source", *[f"'{b}'" for b in BODIES.values()])
    hits = {t: d.size(d.keep(d.array(*[f"'{w}'" for w in ws]), "w", "contains(low, w)")) for t, ws in TAGS.items()}
    implied = " ".join(f"WHEN b = '{b}' THEN hit_{t} >= 2" for t, b in BODIES.items())
    return f"""WITH t AS (SELECT doc_id, source, lower(coalesce(text, '')) AS low FROM {d.t('documents')}),
h AS (SELECT doc_id, low, {d.keep(claimed, 'b', 'b IS NOT NULL')} AS claimed, {', '.join(f'{x} AS hit_{t}' for t, x in hits.items())} FROM t),
k AS (SELECT doc_id, {d.sort(d.distinct('claimed'))} AS claimed, {d.sort(d.distinct(d.keep('claimed', 'b', f'contains(low, b) OR CASE {implied} ELSE false END')))} AS kept FROM h)
SELECT doc_id, {d.join('claimed', '; ')} AS old_value, {d.join('kept', '; ')} AS new_value, {d.size('kept')} AS n_kept FROM k"""


def fix_typos(d: Dialect) -> str:
    """Known misspellings of a closed value set are mapped, other values outside it cleared; rows that change."""
    messy = "CASE WHEN o_orderkey % 11 = 0 THEN 'opeen' WHEN o_orderkey % 13 = 0 THEN ' closd' WHEN o_orderkey % 17 = 0 THEN 'n/a' WHEN o_orderstatus = 'O' THEN 'open' WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'partial' END"
    return f"""WITH m AS (SELECT o_orderkey, {messy} AS old_value FROM {d.t('orders')}),
f AS (SELECT o_orderkey, old_value, CASE WHEN old_value IN ('open', 'closed', 'partial') THEN old_value WHEN trim(old_value) = 'opeen' THEN 'open' WHEN trim(old_value) = 'closd' THEN 'closed' ELSE '' END AS new_value FROM m)
SELECT o_orderkey, old_value, new_value FROM f WHERE old_value <> new_value"""


def _keys(d: Dialect) -> str:
    n = "o_orderkey % 9"
    return f"""SELECT o_orderkey, CASE {n} WHEN 0 THEN '37_' || o_custkey WHEN 1 THEN '37_mh' || o_custkey WHEN 2 THEN '37_' || o_custkey || 'a' WHEN 3 THEN '37_ECON_' || o_custkey
 WHEN 4 THEN '36_rhm/' || o_custkey WHEN 5 THEN '36_mh/' || o_custkey WHEN 6 THEN '36_bio/' || o_custkey WHEN 7 THEN '36_x ' || o_custkey || '-1' ELSE '' END AS raw FROM {d.t('orders')}"""


def key_format_gate(d: Dialect) -> str:
    """Keys by the loader's, the table's and the audit's idea of a format, which differ."""
    plain, typed = d.like("raw", "^[0-9]+_[0-9]+$"), d.like("raw", f"^[0-9]+_({KEY_TYPES})_[0-9]+$")
    return f"""WITH k AS ({_keys(d)}), g AS (SELECT raw, {plain} OR {typed} OR {d.like('raw', '^[0-9]+_[a-z]+[0-9]+[a-z]?$')} AS loader, {typed} OR {d.like('raw', '^[0-9]+_[0-9]+[a-z]?$')} AS stored, {plain} OR {typed} AS audit FROM k)
SELECT loader, stored, audit, count(*) AS n_keys, min(raw) AS first_key FROM g GROUP BY loader, stored, audit"""


#: this library's own: what stands before the number of a malformed key -> type of the key it becomes
REWRITES: dict[str, str] = {"rhm/": "COMMITTEE", "mh/": "SECURITY", "bio/": "ECON"}


def key_rewrite(d: Dialect) -> str:
    """Malformed keys taken apart, their kind looked up in a table of rules, put together again; with how many rows would hold the new key already."""
    rules = " UNION ALL ".join(f"SELECT '{a}' AS kind, '{b}' AS type" for a, b in REWRITES.items())
    return f"""WITH k AS ({_keys(d)}), rules AS ({rules}),
m AS (SELECT o_orderkey, raw, {d.grab('raw', '^([0-9]+)_')} AS gov, {d.grab('raw', '^[0-9]+_([a-z]+/)[0-9]+$')} AS kind, {d.grab('raw', '^[0-9]+_[a-z]+/([0-9]+)$')} AS number, {d.swap('raw', '[^0-9]', '')} AS digits
  FROM k WHERE raw <> '' AND NOT {d.like('raw', '^[0-9]+_[0-9]+$')}),
r AS (SELECT o_orderkey, raw, gov || '_' || coalesce(type, 'SPECIAL') || '_' || CASE WHEN type IS NULL THEN digits ELSE number END AS new_key FROM m LEFT JOIN rules ON m.kind = rules.kind),
c AS (SELECT new_key, count(*) AS n FROM r GROUP BY new_key)
SELECT r.o_orderkey, r.raw, r.new_key, c.n - 1 AS n_collisions FROM r JOIN c ON r.new_key = c.new_key"""


def text_consistency(d: Dialect) -> str:
    """Summary, tags and title held against the text: lengths, keyword and word hits, and the verdicts."""
    words = d.size(d.words("title"))
    met = d.size(d.keep(d.words("title"), "w", "contains(substring(low, 61), w)"))
    kw = d.size(d.keep("kw", "k", "contains(lower(summary), k)"))
    return f"""WITH {_base(d)}, m AS (SELECT doc_id, summary, title, {d.long('length(summary)')} AS summary_length, {words} AS title_words, {met} AS title_words_met, {kw} AS summary_hits FROM h)
SELECT doc_id, summary_length, title_words, title_words_met, summary_hits,
  CASE WHEN summary_length < 20 THEN 'short' WHEN summary_length > 800 THEN 'long' WHEN summary = title THEN 'title' ELSE 'ok' END AS summary_issue,
  summary_length >= 60 AND summary_hits = 0 AS off_tags, title_words >= 3 AND 5 * title_words_met < title_words AS off_title FROM m"""


def stream_late(d: Dialect) -> str:
    """Events over two hours behind the newest that had arrived from their user, by type: what a watermark of that length drops. Arrivals are looked at in runs of 65536."""
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    tail = f"SELECT event_type, count(*) AS n_events, {d.flag("ts < newest - INTERVAL '2' HOUR")} AS n_late FROM a GROUP BY event_type"
    if not d.spark:
        return f"WITH a AS (SELECT event_type, ts, max(ts) OVER (PARTITION BY user_id ORDER BY event_id {before}) AS newest FROM {d.t('events')}) {tail}"
    return f"""WITH e AS (SELECT *, event_id DIV 65536 AS run FROM {d.t('events')}), m AS (SELECT user_id, run, max(ts) AS m FROM e GROUP BY user_id, run),
p AS (SELECT user_id, run, max(m) OVER (PARTITION BY user_id ORDER BY run {before}) AS far FROM m),
w AS (SELECT *, max(ts) OVER (PARTITION BY user_id, run ORDER BY event_id {before}) AS near FROM e),
a AS (SELECT event_type, ts, CASE WHEN near IS NULL OR far > near THEN far ELSE near END AS newest FROM w JOIN p ON w.user_id <=> p.user_id AND w.run <=> p.run) {tail}"""


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, main text and all visible text's length of every page."""
    pages = html.with_page_parts(table(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select("page_id", "page.title", F.col("page.main").alias("main_text"), F.length("page.text").cast("long").alias("visible_chars"))


QUERIES, ORACLES = registry(fix_locations, fix_bodies, fix_typos, key_format_gate, key_rewrite, text_consistency, stream_late)
QUERIES["html_text"] = html_text
