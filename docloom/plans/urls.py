"""Addresses and numbers: slug families, candidates, validation against keys, manifests, small record helpers.

Pages stand in for catalogue entries; their slugs are made from the page's number, one family after another.
"""

from __future__ import annotations

from docloom.functions.slugs import RULES, SlugRule
from docloom.plans.dialect import Dialect, registry


def _pages(d: Dialect, rules: tuple[SlugRule, ...] = RULES) -> str:
    """e: one row a page as a catalogue entry. Every fourth has the number of the page after it in its slug, and every fourth that of the second one before it."""
    shown = "CASE WHEN page_id % 4 = 0 THEN page_id + 1 WHEN page_id % 4 = 2 THEN page_id - 2 WHEN page_id % 36 = 1 THEN page_id + 2000000 ELSE page_id END"
    fill = {"number": "m", "year": "yr", "serial": "'7'", "day": "'12jan2005'", "code": "'xy'"}
    forms = [r.filled(**fill) + (" || CASE WHEN page_id % 5 = 0 THEN 'b' ELSE '' END" if "tail" in r.fields() else "") for r in rules] + ["'item' || m", "''"]
    slug = f"CASE page_id % {len(forms)} " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(forms)) + " END"
    return f"""n AS (SELECT page_id, html, CAST(page_id AS VARCHAR(20)) AS n, CAST({shown} AS VARCHAR(20)) AS m, CAST(25 + page_id % 13 AS BIGINT) AS gov, CAST(2005 + page_id % 20 AS VARCHAR(4)) AS yr FROM {d.t('pages')} WHERE page_id IS NOT NULL),
e AS (SELECT page_id, html, n, gov, yr, {slug} AS slug, CASE WHEN page_id % 10 = 3 THEN '' ELSE CAST(gov AS VARCHAR(4)) || '_' || n END AS record_key, 'decision number ' || n || ' of ' || yr AS described FROM n),
u AS (SELECT *, 'https://www.example.org/en/pages/' || slug || CASE WHEN page_id % 3 = 0 THEN '?ref=1' ELSE '' END AS address FROM e)"""


PARTS = ("family", "slug_year", "slug_num", "suffix", "lead")


def _parts(d: Dialect, slug: str = "slug", rules: tuple[SlugRule, ...] = RULES) -> str:
    """family, year, number, suffix and the rest (day, code or serial) of a slug by the first rule that fits."""
    def part(*fields: str) -> str:
        found = [(r, next((f for f in fields if r.group(f)), None)) for r in rules]
        return "CASE " + " ".join(f"WHEN {d.like(slug, r.pattern())} THEN " + (f"coalesce({d.grab(slug, r.pattern(), r.group(f))}, '')" if f else "''") for r, f in found) + " ELSE '' END"

    family = "CASE " + " ".join(f"WHEN {d.like(slug, r.pattern())} THEN '{r.name}'" for r in rules) + " ELSE 'unknown' END"
    # made once a row: a generator keeps the optimiser from writing the cases into all that uses them
    return d.each(d.array(d.struct(family=family, slug_year=part("year"), slug_num=part("number"), suffix=part("tail"), lead=part("day", "code", "serial")))) + " AS x"


FIELDS = ", ".join(f"x.{f} AS {f}" for f in PARTS)


def slug_classes(d: Dialect) -> str:
    """Slugs (what follows /pages/ up to a question mark) by the first rule whose template fits, with their parts."""
    return f"WITH {_pages(d)}, s AS (SELECT page_id, coalesce({d.grab('address', '/pages/([^?]*)')}, '') AS slug FROM u), p AS (SELECT page_id, slug, {_parts(d)} FROM s) SELECT page_id, slug, {FIELDS} FROM p"


def _candidates(d: Dialect, rules: tuple[SlugRule, ...] = RULES) -> str:
    """k: candidate slugs of each entry with their place, in order, each once.

    First the slug's own form with the right number; then the forms in use in the
    entry's year, the newest first; then those worth a try in any year; last the
    number alone. A form is filled from what is known of the entry.
    """
    own = "CASE family " + " ".join(f"WHEN '{r.name}' THEN {d.array(r.filled(number='n', year='slug_year', day='lead', code='lead', serial='lead'))}" for r in rules) + f" ELSE {d.none()} END"
    plain = [r for r in sorted(rules, key=lambda r: -r.since) if set(r.fields()) <= {"number", "year", "tail"}]
    filled = {r: r.filled(number="n", year="yr") for r in plain}
    dated = [f"CASE WHEN yr BETWEEN '{r.since}' AND '{r.until}' THEN {d.array(filled[r])} ELSE {d.none()} END" for r in plain]
    any_year = d.array(*[filled[r] for r in plain if r.always], "'item' || n")
    place = d("posexplode(all_c) AS (pos, candidate)", "unnest(range(len(all_c))) AS pos, unnest(all_c) AS candidate")
    return f"""{_pages(d, rules)}, p0 AS (SELECT *, {_parts(d, rules=rules)} FROM u), p AS (SELECT page_id, slug, n, yr, gov, {FIELDS} FROM p0), c AS (SELECT *, {d.concat(own, *dated, any_year)} AS every FROM p),
w AS (SELECT page_id, slug, n, slug_num, {d.uniq('every')} AS all_c FROM c), k0 AS (SELECT page_id, slug, n, slug_num, {place} FROM w), k AS (SELECT page_id, slug, n, slug_num, CAST(pos AS BIGINT) AS pos, candidate FROM k0)"""


def slug_candidates(d: Dialect) -> str:
    """Corrected slugs of entries whose number differs from their slug's, in the order they are tried."""
    return f"WITH {_candidates(d)} SELECT page_id, slug, pos, candidate FROM k WHERE slug_num <> '' AND slug_num <> n"


def mismatch_diagnosis(d: Dialect) -> str:
    """The first candidate of each mismatch that resolves: that is a slug some entry of the catalogue has."""
    return f"""WITH {_candidates(d)}, known AS (SELECT DISTINCT slug AS s FROM u WHERE slug <> ''), t AS (SELECT k.* FROM k JOIN known ON candidate = s WHERE slug_num <> '' AND slug_num <> n),
h AS (SELECT page_id, {d("min_by(candidate, pos)", "arg_min(candidate, pos)")} AS candidate, count(*) AS n_resolving FROM t GROUP BY page_id),
m AS (SELECT DISTINCT page_id, slug FROM k WHERE slug_num <> '' AND slug_num <> n)
SELECT m.page_id, m.slug, h.candidate AS corrected, h.candidate IS NOT NULL AS resolves, coalesce(n_resolving, 0) AS n_resolving FROM m LEFT JOIN h ON m.page_id = h.page_id"""


def url_numbers(d: Dialect) -> str:
    """Numbers of an entry: from its address by four patterns in order, by the loose one, from its description; cleaned; and the address its key stands for."""
    ordered = ", ".join(d.grab("address", p) for p in (r"/pages/act-([0-9]+)", r"/pages/[0-9]{4}-[a-z]+-?([0-9]+)", r"/pages/a([0-9]+)[.]", r"(?:item|[.]p)([0-9]+)"))
    messy = "CASE page_id % 4 WHEN 0 THEN ' ' || n || '.. ' WHEN 1 THEN n || '(2)' WHEN 2 THEN n || ' (a) ' ELSE '' END"
    clean = lambda x: d.swap(d.swap(f"trim({x})", r"\.+$", ""), r"\(.*\)$", "")
    return f"""WITH {_pages(d)}, x AS (SELECT *, {messy} AS messy FROM u)
SELECT page_id, coalesce({ordered}) AS url_number, {d.grab('address', '[a-z]-?([0-9]+)')} AS loose_number, {d.grab('described', 'number ([0-9]+)')} AS described_number, nullif(trim({clean('messy')}), '') AS cleaned,
  CASE WHEN record_key <> '' THEN 'https://www.example.org/en/pages/' || replace(record_key, '_', '/') END AS rebuilt FROM x"""


def url_key_validation(d: Dialect) -> str:
    """An address against its key: numbers, difference, pattern, verdict and issues."""
    num = f"coalesce({', '.join(d.grab('address', p) for p in (r'/pages/act-([0-9]+)', r'-(?:act-|[a-z][a-z])([0-9]+)', r'/a([0-9]+)[.]', r'(?:item|[.]p)([0-9]+)'))})"
    want = d.grab("record_key", "_(.*)$")
    diff = "try_cast(got AS BIGINT) - try_cast(want AS BIGINT)"
    issues = d.compact("CASE WHEN want IS NULL THEN 'key format' WHEN got IS NULL THEN 'no number in address' WHEN got <> want AND difference IS NULL THEN 'number differs' WHEN difference <> 0 THEN 'off by ' || CAST(difference AS VARCHAR(20)) END",
                       "CASE WHEN abs(difference) > 1000000 THEN 'systematic offset' END")
    return f"""WITH {_pages(d)}, v AS (SELECT page_id, address, {want} AS want, {num} AS got FROM u), w AS (SELECT *, {diff} AS difference FROM v)
SELECT page_id, want, got, coalesce(difference, 0) AS difference, CASE WHEN contains(address, '/act-') THEN 'number first' WHEN {d.like('address', '/pages/[0-9]{4}-')} THEN 'year first' WHEN contains(address, '/item') THEN 'number only' ELSE 'other' END AS pattern,
  want IS NOT NULL AND got IS NOT NULL AND (got = want OR coalesce(difference = 0, false)) AS is_valid, {d.join(issues, '; ')} AS issues FROM w"""


def manifest_entries(d: Dialect) -> str:
    """New entries for the manifest: key '' where a part is missing, those it holds already left out, each key once."""
    return f"""WITH {_pages(d)}, k AS (SELECT page_id, address, described, CASE WHEN gov IS NULL OR n = '' OR page_id % 10 = 3 THEN '' ELSE CAST(gov AS VARCHAR(4)) || '_' || n END AS entry_key FROM u),
held AS (SELECT DISTINCT entry_key AS h FROM k WHERE page_id % 6 = 0 AND entry_key <> ''),
new AS (SELECT entry_key, min(page_id) AS page_id FROM k LEFT JOIN held ON entry_key = h WHERE h IS NULL GROUP BY entry_key, CASE WHEN entry_key = '' THEN page_id END)
SELECT new.entry_key, k.page_id, address, described FROM new JOIN k ON new.page_id = k.page_id"""


def round_robin(d: Dialect) -> str:
    """Entries dealt to four workers in turn after a sort by government down, number up.

    A place is what stands before its government and its range of numbers, plus
    its rank in that range: no task sorts all entries.
    """
    if not d.spark:
        return f"WITH {_pages(d)} SELECT page_id, (row_number() OVER (ORDER BY gov DESC, page_id) - 1) % 4 AS worker FROM u"
    return f"""WITH {_pages(d)}, b AS (SELECT page_id, gov, page_id DIV 65536 AS range FROM u), c AS (SELECT gov, range, count(*) AS n FROM b GROUP BY gov, range),
o AS (SELECT gov, range, sum(n) OVER (ORDER BY gov DESC, range) - n AS before FROM c)
SELECT page_id, (before + row_number() OVER (PARTITION BY b.gov, b.range ORDER BY page_id) - 1) % 4 AS worker FROM b JOIN o ON b.gov = o.gov AND b.range = o.range"""


def split_rows(d: Dialect) -> str:
    """Rows kept or rejected, with all reasons: missing key, odd address, no number, not newer than the baseline."""
    reasons = d.compact("CASE WHEN record_key = '' THEN 'no key' END", "CASE WHEN slug = '' THEN 'no slug' END", f"CASE WHEN NOT {d.like('slug', '[0-9]')} THEN 'no number' END", "CASE WHEN yr < '2010' OR (yr = '2010' AND page_id <= 100) THEN 'not new' END")
    return f"WITH {_pages(d)}, r AS (SELECT page_id, {reasons} AS reasons FROM u) SELECT page_id, {d.size('reasons')} = 0 AS kept, {d.join('reasons', '; ')} AS reasons FROM r"


def report_keys(d: Dialect) -> str:
    """Entries whose key a report's JSON list names."""
    doc = "'{\"failed\": [\"25_0\", \"26_1\", \"30_5\", \"37_12\", \"99_1\"]}'"
    keys = d(f"explode(from_json(get_json_object({doc}, '$.failed'), 'array<string>'))", f"unnest(from_json(json_extract({doc}, '$.failed'), '[\"VARCHAR\"]'))")
    return f"WITH {_pages(d)}, k AS (SELECT DISTINCT {keys} AS k) SELECT page_id, record_key FROM u JOIN k ON record_key = k"


def json_payload(d: Dialect) -> str:
    """A JSON array of updates as rows: a value by name, whether a name is there, and the object without its key."""
    doc = "'[{\"key\": \"' || CAST(event_id AS VARCHAR(20)) || '\", \"status\": \"' || event_type || '\"' || CASE WHEN event_id % 3 = 0 THEN ', \"expected\": \"1\"' ELSE '' END || '}]'"
    if d.spark:
        return f"""WITH a AS (SELECT explode(from_json({doc}, 'array<map<string,string>>')) AS m FROM {d.t('events')})
SELECT m['key'] AS k, m['status'] AS status, map_contains_key(m, 'expected') AS versioned, size(map_filter(m, (k, v) -> k <> 'key')) AS n_fields FROM a"""
    return f"""WITH a AS (SELECT unnest(from_json({doc}, '["JSON"]')) AS m FROM {d.t('events')})
SELECT m->>'key' AS k, m->>'status' AS status, json_exists(m, '$.expected') AS versioned, CAST(len(json_keys(m)) - 1 AS INTEGER) AS n_fields FROM a"""


def metadata_flatten(d: Dialect) -> str:
    """Metric rows for an export: names by list, from a cutoff on, metadata as JSON text."""
    meta = d("to_json(named_struct('k', get_json_object(props, '$.k'), 'user', CAST(user_id AS STRING)))", "CAST(to_json({'k': json_extract_string(props, '$.k'), 'user': CAST(user_id AS VARCHAR)}) AS VARCHAR)")
    return f"""WITH m AS (SELECT max(ts) AS as_of FROM {d.t('events')}) SELECT event_id, event_type, value, {meta} AS metadata FROM {d.t('events')} CROSS JOIN m WHERE event_type IN ('error', 'purchase') AND ts >= as_of - INTERVAL '72' HOUR"""


def label_lines(d: Dialect) -> str:
    """The line after a label, and a labelled name of at most four words up to the next separator, punctuation off."""
    text = f"'Committee: ' || p_name || ' and some more words of it, then' || chr(10) || 'Subject:  ' || p_type || ' ' || chr(10) || p_brand"
    name = d.grab("t", "Committee: *([^,;" + "\n" + "]*)")
    four = d("array_join(slice(split(name, ' '), 1, 4), ' ')", "array_to_string(split(name, ' ')[1:4], ' ')")
    return f"""WITH x AS (SELECT p_partkey, {text} AS t FROM {d.t('part')}), y AS (SELECT p_partkey, trim({d.grab('t', 'Subject: *([^' + chr(10) + ']*)')}) AS subject, {name} AS name FROM x)
SELECT p_partkey, subject, {d.swap(four, '[.:,;]+$', '')} AS committee FROM y"""


def plain_dates(d: Dialect) -> str:
    """DD.MM.YYYY as ISO without a range, '' where there is none or the day doesn't exist."""
    raw = f"CASE o_orderkey % 5 WHEN 0 THEN '31.02.2020' WHEN 1 THEN 'none' WHEN 2 THEN '' ELSE 'on ' || {d('date_format(o_orderdate, ' + repr('dd.MM.yyyy') + ')', 'strftime(o_orderdate, ' + repr('%d.%m.%Y') + ')')} END"
    iso = f"{d.grab('raw', '[0-9]{2}[.][0-9]{2}[.]([0-9]{4})')} || '-' || {d.grab('raw', '[0-9]{2}[.]([0-9]{2})[.][0-9]{4}')} || '-' || {d.grab('raw', '([0-9]{2})[.][0-9]{2}[.][0-9]{4}')}"
    return f"WITH r AS (SELECT o_orderkey, {raw} AS raw FROM {d.t('orders')}), i AS (SELECT o_orderkey, raw, {iso} AS iso FROM r) SELECT o_orderkey, CASE WHEN try_cast(iso AS DATE) IS NULL THEN '' ELSE iso END AS day FROM i"


def placeholder_tags(d: Dialect) -> str:
    """Placeholder tags taken out of a delimited list; the rest keeps its order."""
    raw = "p_type || ';placeholder ' || CAST(p_partkey % 9 AS VARCHAR(4)) || '; ' || p_brand || ';placeholder'"
    kept = d.keep(d.items("raw"), "x", f"NOT {d.like('x', '^placeholder( [0-9]+)?$')}")
    return f"WITH r AS (SELECT p_partkey, {raw} AS raw FROM {d.t('part')}) SELECT p_partkey, {d.join(kept, '; ')} AS tags FROM r"


def catalog_lookup(d: Dialect) -> str:
    """Addresses among the newest 100 entries that have the number looked for."""
    return f"""WITH {_pages(d)}, newest AS (SELECT page_id, address FROM u ORDER BY page_id DESC LIMIT 100), w AS (SELECT CAST(max(page_id) - 7 AS VARCHAR(20)) AS num FROM newest)
SELECT page_id, address FROM newest CROSS JOIN w WHERE {d.grab('address', '(?:act-|item|[.]p)([0-9]+)')} = num OR contains(address, num)"""


def alert_routing(d: Dialect) -> str:
    """Alerts by threshold, critical before warning, and by distance from the type's mean; where each goes."""
    return f"""WITH s AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS sd FROM {d.t('events')} GROUP BY event_type),
a AS (SELECT event_id, e.event_type, CASE WHEN value > 150 THEN 'critical' WHEN value > 75 THEN 'warning' WHEN sd > 0 AND (abs(value - m) - 2 * sd) / sd >= 0.7 THEN 'anomaly' END AS severity FROM {d.t('events')} e JOIN s ON e.event_type = s.event_type)
SELECT event_id, event_type, severity, CASE severity WHEN 'critical' THEN 'mail,webhook,log' WHEN 'warning' THEN 'webhook,log' ELSE 'log' END AS channels FROM a WHERE severity IS NOT NULL"""


def changed_field_checks(d: Dialect) -> str:
    """Checks each change needs: those of its changed fields for an update, all for a new row, none but a mark for a deleted one."""
    routes = {"status": ("operativity-validity", "operativity-vs-content"), "cust": ("tag-body", "government-body-hallucination", "location-vs-body")}
    every = d.array(*[repr(c) for cs in routes.values() for c in cs], "'content-quality'")
    by = d.concat(*[f"CASE WHEN {cond} THEN {d.array(*[repr(c) for c in routes[f]])} ELSE {d.none()} END" for f, cond in (("status", "o_orderkey % 7 = 0"), ("cust", "o_orderkey % 13 = 0"))])
    checks = f"CASE WHEN o_orderkey % 11 = 0 THEN {every} WHEN o_orderkey % 17 = 0 THEN {d.array(repr('mark-deleted'))} ELSE {by} END"
    return f"SELECT DISTINCT o_orderkey, {d.each(checks)} AS check_key FROM {d.t('orders')}"


QUERIES, ORACLES = registry(
    slug_classes, slug_candidates, mismatch_diagnosis, url_numbers, url_key_validation, manifest_entries, round_robin, split_rows, report_keys, json_payload, metadata_flatten, label_lines,
    plain_dates, placeholder_tags, catalog_lookup, alert_routing, changed_field_checks)
