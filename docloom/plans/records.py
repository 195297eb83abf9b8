"""Record operations: scans, duplicates, windows, merges, reconciliation, change data."""

from __future__ import annotations

from docloom.plans.dialect import Dialect, registry

CUTOFF = "1996-06-01"


def filtered_scan(d: Dialect) -> str:
    """Projected scan by date range and key prefix, newest first, key as tie-break."""
    return f"""SELECT o_orderkey, o_orderstatus, {d.day('o_orderdate')} AS order_date FROM {d.t('orders')}
WHERE o_orderdate >= TIMESTAMP '1995-01-01 00:00:00' AND o_orderdate <= TIMESTAMP '1997-12-31 00:00:00' AND CAST(o_orderkey AS VARCHAR(20)) LIKE '1%'
ORDER BY o_orderdate DESC, o_orderkey"""


def latest_row(d: Dialect) -> str:
    """The newest finished order."""
    return f"SELECT o_orderkey, {d.day('o_orderdate')} AS order_date FROM {d.t('orders')} WHERE o_orderstatus <> 'P' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1"


def point_lookup(d: Dialect) -> str:
    """Which of the wanted keys are stored."""
    return f"""SELECT DISTINCT o.o_orderkey FROM {d.t('orders')} o LEFT SEMI JOIN (SELECT l_orderkey * 2 AS k FROM {d.t('lineitem')}) w ON o.o_orderkey = w.k""" if d.spark else \
        f"SELECT DISTINCT o_orderkey FROM {d.t('orders')} WHERE o_orderkey IN (SELECT l_orderkey * 2 FROM {d.t('lineitem')})"


def stratified_sample(d: Dialect) -> str:
    """Five percent of each year, at least one row, by a seeded hash of the key: years are cut by counts of 4096 hash ranges, and only the range the cut falls in is ranked."""
    h = "md5(CAST(o_orderkey AS VARCHAR(20)) || ':42')"
    if not d.spark:
        return f"""
WITH o AS (SELECT o_orderkey, substring({d.day('o_orderdate')}, 1, 4) AS yr FROM {d.t('orders')}),
r AS (SELECT *, row_number() OVER (PARTITION BY yr ORDER BY {h}, o_orderkey) AS rn, count(*) OVER (PARTITION BY yr) AS n FROM o)
SELECT o_orderkey, yr FROM r WHERE rn <= greatest(1, floor(n * 5 / 100))"""
    return f"""
WITH o AS (SELECT o_orderkey, substring({d.day('o_orderdate')}, 1, 4) AS yr, {h} AS h FROM {d.t('orders')}),
c AS (SELECT yr, substring(h, 1, 3) AS b, count(*) AS n FROM o GROUP BY 1, 2),
t AS (SELECT yr, b, sum(n) OVER (PARTITION BY yr ORDER BY b) - n AS before, greatest(1, floor(sum(n) OVER (PARTITION BY yr) * 5 / 100)) AS need FROM c),
r AS (SELECT o_orderkey, o.yr, before + row_number() OVER (PARTITION BY o.yr, t.b ORDER BY h, o_orderkey) AS rn, need FROM o JOIN t ON o.yr = t.yr AND substring(h, 1, 3) = t.b WHERE before < need)
SELECT o_orderkey, yr FROM r WHERE rn <= need"""


def high_water_mark(d: Dialect) -> str:
    """Rows newer than a baseline: later date, or the same date and another number."""
    return f"""
WITH b AS (SELECT max(o_orderdate) AS last_date, max_by(o_orderkey, o_orderdate) AS unused FROM {d.t('orders')} WHERE o_orderdate < TIMESTAMP '{CUTOFF} 00:00:00'),
k AS (SELECT max(o_orderkey) AS last_key FROM {d.t('orders')} CROSS JOIN b WHERE o_orderdate = last_date)
SELECT o_orderkey, {d.day('o_orderdate')} AS order_date FROM {d.t('orders')} CROSS JOIN b CROSS JOIN k
WHERE o_orderdate >= last_date AND NOT (o_orderdate = last_date AND o_orderkey = last_key)"""


def _keyed(d: Dialect) -> str:
    """documents by a 128-bit digest and the length of their texts, which stand for the texts in every shuffle."""
    return f"(SELECT doc_id, lang, source, n_chars, md5(text) AS text_key, length(text) AS text_len FROM {d.t('documents')})"


def duplicate_groups(d: Dialect) -> str:
    """Texts held by more than one document: how many, smallest and largest id, sources."""
    return f"""SELECT text_key, count(*) AS n, min(doc_id) AS keep_id, max(doc_id) AS last_id, count(DISTINCT source) AS n_sources
FROM {_keyed(d)} x GROUP BY text_key, text_len HAVING count(*) > 1"""


def duplicate_members(d: Dialect) -> str:
    """Each document of a duplicate group: one row an id, since a group may be of any size."""
    return f"""WITH k AS (SELECT * FROM {_keyed(d)} x), g AS (SELECT text_key AS gk, text_len AS gl, min(doc_id) AS keep_id FROM k GROUP BY text_key, text_len HAVING count(*) > 1)
SELECT text_key, doc_id, keep_id FROM k JOIN g ON text_key = gk AND text_len = gl"""


def ordered_lines(d: Dialect) -> str:
    """The parts of each order as one array in line order: a group an order bounds."""
    parts = d("transform(array_sort(collect_list(struct(l_linenumber, l_partkey))), x -> CAST(x.l_partkey AS STRING))", "list(CAST(l_partkey AS VARCHAR) ORDER BY l_linenumber, l_partkey)")
    return f"SELECT l_orderkey, {d.join(parts, ',')} AS parts FROM {d.t('lineitem')} GROUP BY l_orderkey"


def duplicate_conflicts(d: Dialect) -> str:
    """Duplicate texts whose other columns disagree."""
    return f"""SELECT text_key, count(DISTINCT lang) AS n_lang, count(DISTINCT source) AS n_source, count(DISTINCT n_chars) AS n_len
FROM {_keyed(d)} x GROUP BY text_key, text_len HAVING count(*) > 1 AND (count(DISTINCT lang) > 1 OR count(DISTINCT source) > 1 OR count(DISTINCT n_chars) > 1)"""


def keep_newest(d: Dialect) -> str:
    """The newest order of each customer; ties by the larger key."""
    return f"""SELECT o_custkey, o_orderkey, {d.day('o_orderdate')} AS order_date FROM
(SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM {d.t('orders')}) x WHERE rn = 1"""


def dedup_backup(d: Dialect) -> str:
    """Documents a dedup by text would delete, with the one that stays."""
    return f"""WITH k AS (SELECT * FROM {_keyed(d)} x), g AS (SELECT text_key AS gk, text_len AS gl, min(doc_id) AS keep_id FROM k GROUP BY text_key, text_len HAVING count(*) > 1)
SELECT doc_id, keep_id, source FROM k JOIN g ON text_key = gk AND text_len = gl AND doc_id <> keep_id"""


def audit_rollup(d: Dialect) -> str:
    """One audit row over the duplicate groups, also as a JSON object; the duplicate rate is pairs over rows in percent, so it may exceed 100."""
    return f"""WITH g AS (SELECT count(*) AS n FROM {_keyed(d)} x GROUP BY text_key, text_len HAVING count(*) > 1), t AS (SELECT count(*) AS total FROM {d.t('documents')}),
a AS (SELECT count(*) AS n_groups, coalesce({d.long('sum(n)')}, 0) AS n_rows, coalesce({d.long('sum(n - 1)')}, 0) AS n_removed, coalesce({d.long('max(n)')}, 0) AS largest, coalesce(sum({d.double('n')} * (n - 1) / 2), 0) AS n_pairs FROM g)
SELECT n_groups, n_rows, n_removed, largest, n_pairs, n_pairs / total * 100 AS duplicate_rate, '{{"n_groups":' || CAST(n_groups AS VARCHAR(20)) || ',"n_removed":' || CAST(n_removed AS VARCHAR(20)) || '}}' AS detail FROM a CROSS JOIN t"""


#: this library's own: prefixes of keys as written, in the order they are tried -> their codes
PREFIXES: tuple[tuple[str, str], ...] = (("HLT", "hlt"), ("mh-", "mh"), ("RHM", "rhm"), ("bio ", "bio"), ("gb.", "gb"), ("sc-", "sc"))


def key_normalise(d: Dialect) -> str:
    """Keys rebuilt from messy forms: separators dropped, prefixes coded, formats gated."""
    forms = ["'HLT/' || o_custkey", "'mh-' || o_custkey || '/a'", "'  ' || o_custkey || '..'", "'none'", "'37_' || o_custkey || 'b'", "'RHM' || o_custkey", "'bio ' || o_custkey", "'gb.' || o_custkey", "'sc-' || o_custkey || '/'"]
    raw = f"CASE o_orderkey % {len(forms)} " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(forms)) + " END"
    clean = d.swap("trim(raw)", r"[/\\]|\.+$", "")
    coded = "CASE " + " ".join(f"WHEN c LIKE '{p}%' THEN '{code}' || substring(c, {len(p) + 1})" for p, code in PREFIXES) + " ELSE c END"
    return f"""
WITH r AS (SELECT o_orderkey, {raw} AS raw FROM {d.t('orders')}), c AS (SELECT o_orderkey, raw, {clean} AS c FROM r), k AS (SELECT o_orderkey, raw, {coded} AS k FROM c)
SELECT o_orderkey, raw, CASE WHEN lower(k) IN ('', 'none') THEN NULL ELSE '37_' || {d.swap('k', '^37_', '')} END AS decision_key,
  {d.like('k', '^[0-9]+$')} AS plain_key, {d.like('k', '^(hlt|mh|rhm|bio|gb|sc)[0-9]+[a-z]?$')} AS prefixed_key, {d.like('k', '^[0-9]+_[0-9]+[a-z]?$')} AS full_key FROM k"""


def anti_join_ingest(d: Dialect) -> str:
    """Incoming orders whose key is not stored yet."""
    body = f"(SELECT DISTINCT l_orderkey AS k FROM {d.t('lineitem')} WHERE l_quantity > 45) s"
    return d(f"SELECT o_orderkey, o_custkey FROM {d.t('orders')} o LEFT ANTI JOIN {body} ON o.o_orderkey = s.k",
             f"SELECT o_orderkey, o_custkey FROM {d.t('orders')} o WHERE NOT EXISTS (SELECT 1 FROM {body} WHERE o.o_orderkey = s.k)")


def set_reconciliation(d: Dialect) -> str:
    """Keys on both sides, left only and right only, by a full outer join."""
    return f"""
WITH a AS (SELECT DISTINCT o_orderkey AS k FROM {d.t('orders')} WHERE o_orderkey % 3 <> 0), b AS (SELECT DISTINCT l_orderkey AS k FROM {d.t('lineitem')} WHERE l_orderkey % 4 <> 0)
SELECT CASE WHEN a.k IS NULL THEN 'right_only' WHEN b.k IS NULL THEN 'left_only' ELSE 'both' END AS side, count(*) AS n, min(coalesce(a.k, b.k)) AS first_key
FROM a FULL OUTER JOIN b ON a.k = b.k GROUP BY 1"""


def set_operations(d: Dialect) -> str:
    """Difference, intersection and union of key sets."""
    a, b = f"SELECT o_orderkey AS k FROM {d.t('orders')} WHERE o_orderkey % 3 = 0", f"SELECT l_orderkey AS k FROM {d.t('lineitem')} WHERE l_orderkey % 2 = 0"
    return " UNION ALL ".join(f"SELECT '{n}' AS op, k FROM (({a}) {n} ({b})) x" for n in ("EXCEPT", "INTERSECT", "UNION"))


def merge_update(d: Dialect) -> str:
    """Updates applied field by field, blank keeps the old value; unknown keys are reported, and a stale version meets each of three modes: skip leaves the row, merge fills blanks only, overwrite applies all the same."""
    stale = "u.expected <> o.price"
    mode = lambda stays: f"CASE WHEN o.k IS NULL THEN NULL WHEN {stale} AND {stays} THEN o.status ELSE coalesce(nullif(u.status, ''), o.status) END"
    return f"""
WITH o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderstatus END AS status, o_totalprice AS price FROM {d.t('orders')}),
u AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN -o_orderkey ELSE o_orderkey END AS k, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'X' END AS status,
  CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 WHEN o_orderkey % 10 = 5 THEN NULL ELSE o_totalprice END AS expected FROM {d.t('orders')} WHERE o_orderkey % 5 = 0 OR o_orderkey % 7 = 0)
SELECT u.k, {mode("true")} AS skipped, {mode("o.status <> ''")} AS merged, {mode("false")} AS overwritten,
  CASE WHEN o.k IS NULL THEN 'not_found' WHEN {stale} THEN 'conflict' ELSE 'updated' END AS outcome FROM u LEFT JOIN o ON u.k = o.k"""


def _snapshots(d: Dialect) -> str:
    return f"""
old AS (SELECT o_orderkey AS k, o_orderstatus AS status, CAST(o_custkey AS VARCHAR(20)) AS cust FROM {d.t('orders')} WHERE o_orderkey % 11 <> 0),
new AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'Z' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 13 = 0 THEN '0' ELSE CAST(o_custkey AS VARCHAR(20)) END AS cust FROM {d.t('orders')} WHERE o_orderkey % 17 <> 0)"""


def _hash(alias: str) -> str:
    return f"md5(coalesce({alias}.status, '') || chr(1) || coalesce({alias}.cust, ''))"


def snapshot_diff(d: Dialect) -> str:
    """New, changed and unchanged rows by row hash."""
    return f"""WITH {_snapshots(d)}
SELECT new.k, CASE WHEN old.k IS NULL THEN 'new' WHEN {_hash('old')} <> {_hash('new')} THEN 'changed' ELSE 'unchanged' END AS state FROM new LEFT JOIN old ON new.k = old.k"""


def change_log(d: Dialect) -> str:
    """Change records between two snapshots: operation, changed fields, old and new values as JSON, priority, hash."""
    value = lambda x: f"CASE WHEN {x}.k IS NOT NULL THEN " + d(f"to_json(named_struct('status', {x}.status, 'cust', {x}.cust))", f"CAST(to_json({{'status': {x}.status, 'cust': {x}.cust}}) AS VARCHAR)") + " END"
    fields = d.compact("CASE WHEN old.status IS DISTINCT FROM new.status THEN 'status' END", "CASE WHEN old.cust IS DISTINCT FROM new.cust THEN 'cust' END")
    return f"""WITH {_snapshots(d)},
c AS (SELECT coalesce(new.k, old.k) AS k, CASE WHEN old.k IS NULL THEN 'insert' WHEN new.k IS NULL THEN 'delete' ELSE 'update' END AS op, {fields} AS f,
  {value('old')} AS old_values, {value('new')} AS new_values, md5(coalesce(old.status, '') || '>' || coalesce(new.status, '')) AS change_hash FROM old FULL OUTER JOIN new ON old.k = new.k)
SELECT k, op, CASE WHEN op = 'update' THEN {d.join('f', ',')} ELSE '' END AS changed_fields, old_values, new_values, {d.long("CASE WHEN op = 'delete' THEN 3 WHEN op = 'insert' THEN 2 ELSE 1 END")} AS priority, change_hash
FROM c WHERE op <> 'update' OR {d.size('f')} > 0"""


def change_report(d: Dialect) -> str:
    """Changes by operation, with a recommendation."""
    return f"""SELECT event_type AS op, count(*) AS n, count(DISTINCT user_id) AS n_records, {d.flag('value > 50')} AS n_priority,
  CASE WHEN count(*) > 1500 THEN 'scan all' WHEN count(*) > 500 THEN 'scan changed' ELSE 'none' END AS recommendation FROM {d.t('events')} GROUP BY event_type"""


def pending_changes(d: Dialect) -> str:
    """The 500 most urgent changes: priority down, time up."""
    return f"""SELECT event_id, {d.stamp('ts')} AS at, {d.long("CASE event_type WHEN 'error' THEN 3 WHEN 'purchase' THEN 2 ELSE 1 END")} AS priority FROM {d.t('events')} WHERE value >= 0
ORDER BY priority DESC, ts, event_id LIMIT 500"""


def check_routing(d: Dialect) -> str:
    """Checks that each changed record needs, from the fields that changed."""
    routes = {"click": ("url", "content"), "view": ("content",), "purchase": ("policy", "body", "date"), "error": ("url", "content", "policy", "body", "date")}
    case = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {d.array(*[repr(x) for x in v])}" for k, v in routes.items()) + f" ELSE {d.array(repr('content'))} END"
    return f"SELECT DISTINCT user_id, {d.each(case)} AS check_key FROM {d.t('events')}"


def resume_filter(d: Dialect) -> str:
    """Work left after a stop: keys without output, the first 200 by date and key."""
    body = f"(SELECT DISTINCT l_orderkey AS k FROM {d.t('lineitem')} WHERE l_linenumber >= 3) s"
    rest = d(f"{d.t('orders')} o LEFT ANTI JOIN {body} ON o.o_orderkey = s.k", f"{d.t('orders')} o WHERE NOT EXISTS (SELECT 1 FROM {body} WHERE o.o_orderkey = s.k)")
    return f"SELECT o_orderkey, {d.day('o_orderdate')} AS order_date FROM {rest} ORDER BY o_orderdate, o_orderkey LIMIT 200"


def liveness(d: Dialect) -> str:
    """Users without an event in the last 48 hours of the stream are stale."""
    return f"""WITH m AS (SELECT max(ts) AS as_of FROM {d.t('events')})
SELECT user_id, {d.stamp('max(ts)')} AS last_seen, max(ts) < max(as_of) - INTERVAL '48' HOUR AS is_stale FROM {d.t('events')} CROSS JOIN m GROUP BY user_id"""


def load_projection(d: Dialect) -> str:
    """Load-ready rows: keys built, blanks filled, incomplete and out-of-domain rows dropped."""
    return f"""SELECT CAST(o_custkey AS VARCHAR(20)) || '_' || CAST(o_orderkey AS VARCHAR(20)) AS decision_key, coalesce(o_orderstatus, '') AS status, coalesce(o_orderpriority, '') AS priority, {d.day('o_orderdate')} AS order_date
FROM {d.t('orders')} WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL AND o_orderstatus IN ('F', 'O')"""


def range_lookup(d: Dialect) -> str:
    """Orders outside the date range, 30 days of grace, of the era their key names."""
    return f"""
WITH era AS (SELECT e AS id, CAST('1992-01-01' AS DATE) + {d("make_dt_interval(CAST((e - 1) * 365 AS INT))", "CAST((e - 1) * 365 AS INTEGER)")} AS start_date, CAST('1992-01-01' AS DATE) + {d("make_dt_interval(CAST(e * 365 AS INT))", "CAST(e * 365 AS INTEGER)")} AS end_date FROM (SELECT {d("explode(sequence(1, 7))", "unnest(range(1, 8))")} AS e) x),
o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, 1 + o_orderkey % 7 AS era FROM {d.t('orders')})
SELECT o_orderkey, era, {d.day('day')} AS order_date FROM o JOIN era ON o.era = era.id WHERE {d.days('day', 'start_date')} < -30 OR {d.days('day', 'end_date')} > 30"""


def _title_classes(d: Dialect) -> str:
    """Titles of one day with the same words are a class: c(rep, day, w, n)."""
    return f"""p AS (SELECT doc_id, doc_id % 365 AS day, trim(substring(coalesce(text, ''), 1, 60)) AS title FROM {d.t('documents')}),
w AS (SELECT doc_id, day, {d.words('title')} AS w FROM p WHERE length(title) >= 10),
o AS (SELECT doc_id, day, {d.sort('w')} AS w FROM w),
c AS (SELECT min(doc_id) AS rep, day, w, count(*) AS n FROM o GROUP BY day, w)"""


def near_duplicate_titles(d: Dialect) -> str:
    """Title pairs within 30 days with word similarity over 0.85, as pairs of classes with the number of title pairs each stands for.

    Words are ordered by the number of classes that have them, rarest first. Two
    sets of that similarity share over 0.85 of either, so they share a word among
    the first ``n - floor(0.85 n)`` of each: joining on those words, in day
    buckets, loses no pair, and a word that many titles share joins few of them.
    """
    inner = "SELECT rep AS id_a, rep AS id_b, n * (n - 1) DIV 2 AS n_pairs, CAST(1 AS DOUBLE) AS similarity FROM c WHERE n > 1"
    if not d.spark:
        return f"""WITH {_title_classes(d)}
SELECT a.rep AS id_a, b.rep AS id_b, a.n * b.n AS n_pairs, {d.jaccard('a.w', 'b.w')} AS similarity FROM c a JOIN c b ON a.rep < b.rep AND abs(a.day - b.day) <= 30 AND {d.jaccard('a.w', 'b.w')} > 0.85
UNION ALL {inner.replace(' DIV ', ' // ')}"""
    return f"""WITH {_title_classes(d)},
e AS (SELECT rep, day, n, size(w) AS m, explode(w) AS word FROM c),
df AS (SELECT word, count(*) AS df FROM e GROUP BY word),
v AS (SELECT rep, day, n, transform(array_sort(collect_list(struct(df, e.word))), x -> x.word) AS w FROM e JOIN df ON e.word = df.word GROUP BY rep, day, n),
f AS (SELECT *, floor(day / 30) AS bucket, explode(slice(w, 1, size(w) - (85 * size(w)) DIV 100)) AS word FROM v),
g AS (SELECT rep, day, w, n, word, explode(array(bucket - 1, bucket, bucket + 1)) AS bucket FROM f),
j AS (SELECT DISTINCT a.rep AS id_a, b.rep AS id_b, a.n * b.n AS n_pairs, {d.jaccard('a.w', 'b.w')} AS similarity FROM g a JOIN f b
  ON a.word = b.word AND a.bucket = b.bucket AND a.rep < b.rep AND abs(a.day - b.day) <= 30 AND size(a.w) * 100 > 85 * size(b.w) AND size(b.w) * 100 > 85 * size(a.w))
SELECT id_a, id_b, n_pairs, similarity FROM j WHERE similarity > 0.85 UNION ALL {inner}"""


def near_duplicate_members(d: Dialect) -> str:
    """The class of each title in ``near_duplicate_titles``."""
    return f"WITH {_title_classes(d)} SELECT o.doc_id, c.rep AS class_id FROM o JOIN c ON o.day = c.day AND o.w = c.w"


def last_events(d: Dialect) -> str:
    """The newest 50 events of each type."""
    return f"""SELECT event_type, event_id, {d.stamp('ts')} AS at FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM {d.t('events')}) x WHERE rn <= 50"""


QUERIES, ORACLES = registry(
    filtered_scan, latest_row, point_lookup, stratified_sample, high_water_mark, duplicate_groups, duplicate_members, ordered_lines, duplicate_conflicts, keep_newest, dedup_backup, audit_rollup,
    key_normalise, anti_join_ingest, set_reconciliation, set_operations, merge_update, snapshot_diff, change_log, change_report, pending_changes, check_routing,
    resume_filter, liveness, load_projection, range_lookup, near_duplicate_titles, near_duplicate_members, last_events)
