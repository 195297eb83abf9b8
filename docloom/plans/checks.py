"""Record checks: one fused pass over documents, and the checks that need other tables."""

from __future__ import annotations

from docloom.plans.dialect import Dialect, registry

#: own rule pack: policy tag -> keywords found in the synthetic texts, and the body each tag expects
TAGS: dict[str, tuple[str, ...]] = {"en": ("the", "and", "that"), "fr": ("les", "des", "que"), "de": ("der", "und", "die"), "es": ("los", "que", "del")}
BODIES: dict[str, str] = {"en": "src1", "fr": "src2", "de": "src3", "es": "src4"}


def _case(x: str, pack: dict[str, str], otherwise: str = "NULL") -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in pack.items()) + f" ELSE {otherwise} END"


def _keywords(d: Dialect, x: str = "lang") -> str:
    return _case(x, {k: d.array(*[f"'{w}'" for w in v]) for k, v in TAGS.items()}, d("cast(array() as array<string>)", "CAST([] AS VARCHAR[])"))


def _base(d: Dialect) -> str:
    return f"""
d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, lower(coalesce(text, '')) AS low, length(coalesce(text, '')) AS len,
  trim(substring(coalesce(text, ''), 1, 60)) AS title, substring(coalesce(text, ''), 61, 120) AS summary, {_keywords(d)} AS kw FROM {d.t('documents')}),
h AS (SELECT *, {d.size(d.keep('kw', 'k', d('contains(low, k)', 'contains(low, k)')))} AS hits FROM d)"""


def _issues(d: Dialect) -> dict[str, tuple[str, str]]:
    """check key -> (severity or NULL, field)."""
    return {
        "content-quality": (f"CASE WHEN {d.like('low', 'captcha|access denied|just a moment')} THEN 'high' WHEN len < 100 THEN 'medium' WHEN {d.like('low', '^(home|menu|skip to)')} THEN 'low' END", "content"),
        "content-completeness": (f"CASE WHEN len >= 50 AND {d.like('text', '[.]{3}$')} THEN 'medium' END", "content"),
        "content-truncation": ("CASE WHEN len >= 32700 THEN 'medium' END", "content"),
        "summary-quality": ("CASE WHEN length(summary) < 20 THEN 'medium' WHEN length(summary) > 800 THEN 'low' WHEN summary = title THEN 'medium' END", "summary"),
        "policy-relevance": ("CASE WHEN len >= 100 AND hits = 0 THEN 'high' END", "policy"),
        "policy-fallback": ("CASE WHEN lang = 'es' THEN 'medium' END", "policy"),
        "summary-vs-tags": (f"CASE WHEN length(summary) >= 60 AND {d.size(d.keep('kw', 'k', 'contains(lower(summary), k)'))} = 0 THEN 'low' END", "summary"),
        "tag-body": (f"CASE WHEN {_case('lang', {k: chr(39) + v + chr(39) for k, v in BODIES.items()})} IS DISTINCT FROM source THEN 'low' END", "body"),
        "shouting": (f"CASE WHEN {d.like('text', '[A-Z]{12}')} THEN 'low' END", "content"),
        "title-vs-content": (f"CASE WHEN {d.size(d.words('title'))} >= 3 AND 5 * {d.size(d.keep(d.words('title'), 'w', 'contains(substring(low, 61), w)'))} < {d.size(d.words('title'))} THEN 'medium' END", "title"),
    }


def _long(d: Dialect) -> str:
    """One row an issue: every check is evaluated once per row, then unpivoted."""
    items = _issues(d)
    cols = ", ".join(f"{sev} AS c{i}" for i, (sev, _) in enumerate(items.values()))
    rows = d.array(*[d(f"named_struct('check_key', '{k}', 'severity', c{i}, 'field', '{f}')", f"{{'check_key': '{k}', 'severity': c{i}, 'field': '{f}'}}") for i, (k, (_, f)) in enumerate(items.items())])
    return f"""{_base(d)},
c AS (SELECT doc_id, {cols} FROM h),
x AS (SELECT doc_id, {d.each(rows)} AS x FROM c),
i AS (SELECT doc_id, x.check_key AS check_key, x.severity AS severity, x.field AS field FROM x WHERE x.severity IS NOT NULL)"""


def checks_fused(d: Dialect) -> str:
    """All issues of all checks in one scan."""
    return f"WITH {_long(d)} SELECT doc_id, check_key, severity, field FROM i"


def checks_summary(d: Dialect) -> str:
    """Issues, rows and rate of each check and severity; a class that over 80 % of the labelled rows have is its own row, with 30 % of them as the estimate of wrong ones."""
    return f"""WITH {_long(d)}, n AS (SELECT count(*) AS scanned FROM d)
SELECT check_key, severity, count(*) AS issues_found, count(DISTINCT doc_id) AS n_rows, {d.double('count(*)')} / max(scanned) * 100 AS rate, min(doc_id) AS sample_id FROM i CROSS JOIN n GROUP BY check_key, severity
UNION ALL SELECT 'lang-distribution', 'high', {d.long('floor(0.3 * top)')}, top, {d.double('top')} / scanned * 100, first_id FROM
 (SELECT {d.flag("lang = 'en'")} AS top, count(lang) AS labelled, min(CASE WHEN lang = 'en' THEN doc_id END) AS first_id FROM d) t CROSS JOIN n WHERE top > 0.8 * labelled"""


def check_samples(d: Dialect) -> str:
    """The first ten issues of each check."""
    return f"WITH {_long(d)} SELECT check_key, doc_id, severity FROM (SELECT *, row_number() OVER (PARTITION BY check_key ORDER BY doc_id, severity) AS rn FROM i) r WHERE rn <= 10"


def keyword_relevance(d: Dialect) -> str:
    """Keyword hits of every tag against every text: words that stand by themselves, before a comma or a full stop."""
    hit = lambda w: f"(contains(low, ' {w} ') OR contains(low, ' {w},') OR contains(low, ' {w}.'))"
    rows = d.array(*[d.struct(tag=d.lit(t), n_hits=d.long(" + ".join(f"CASE WHEN {hit(w)} THEN 1 ELSE 0 END" for w in ws)), n_words=str(len(ws))) for t, ws in TAGS.items()])
    return f"""WITH d AS (SELECT doc_id, ' ' || lower(coalesce(text, '')) || ' ' AS low FROM {d.t('documents')}), k AS (SELECT doc_id, {d.each(rows)} AS k FROM d)
SELECT doc_id, k.tag AS tag, k.n_hits AS n_hits, {d.double('k.n_hits')} / k.n_words AS score FROM k"""


def evidence_check(d: Dialect) -> str:
    """Claimed words without evidence in the text: all missing is high, some is low."""
    claimed = d.array("'the'", "'clown'", "'license'", "source")
    return f"""WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS low, {claimed} AS claimed FROM {d.t('documents')}),
m AS (SELECT doc_id, {d.keep('claimed', 'w', 'NOT contains(low, w)')} AS missing, {d.size('claimed')} AS n FROM d)
SELECT doc_id, {d.join('missing', ';')} AS missing, CASE WHEN {d.size('missing')} = n THEN 'high' ELSE 'low' END AS severity FROM m WHERE {d.size('missing')} > 0"""


def date_checks(d: Dialect) -> str:
    """Dates as text: before the first or after the last valid day by string order, and those that don't parse."""
    return f"""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN 'invalid-date' WHEN o_orderkey % 103 = 0 THEN '1947-05-14' WHEN o_orderkey % 107 = 0 THEN '' WHEN o_orderkey % 109 = 0 THEN '1995-13-01' ELSE {d.day('o_orderdate')} END AS s FROM {d.t('orders')})
SELECT o_orderkey, s, CASE WHEN s = '' THEN 'missing' WHEN s < '1948-01-01' THEN 'before' WHEN s > '2026-01-01' THEN 'after' WHEN try_cast(s AS DATE) IS NULL THEN 'unparsed' END AS issue
FROM o WHERE s = '' OR s < '1948-01-01' OR s > '2026-01-01' OR try_cast(s AS DATE) IS NULL"""


def row_validation(d: Dialect) -> str:
    """Errors and warnings of each row before it is loaded."""
    errors = d.compact("CASE WHEN doc_id IS NULL THEN 'no_id' END", "CASE WHEN lang IS NULL OR lang NOT IN ('en', 'fr', 'de', 'es') THEN 'bad_lang' END", "CASE WHEN length(coalesce(text, '')) < 50 THEN 'too_short' END",
                       f"CASE WHEN NOT {d.like('coalesce(source, ' + d.lit('') + ')', '^src[0-9]+$')} THEN 'bad_source' END", f"CASE WHEN {d.like('coalesce(text, ' + d.lit('') + ')', '[.]{3}$')} THEN 'truncated' END")
    warnings = d.compact("CASE WHEN length(coalesce(text, '')) > 20000 THEN 'very_long' END", "CASE WHEN text LIKE '%http%' THEN 'has_url' END", "CASE WHEN try_cast(substring(source, 4) AS BIGINT) > 15 THEN 'late_source' END")
    return f"SELECT doc_id, {d.join('e', ',')} AS errors, {d.join('w', ',')} AS warnings, {d.size('e')} = 0 AS is_valid FROM (SELECT doc_id, {errors} AS e, {warnings} AS w FROM {d.t('documents')}) x"


def content_gates(d: Dialect) -> str:
    """The first reason to refuse a scraped page, with the same gates for documents."""
    gate = lambda t: f"CASE WHEN {d.like(f'lower({t})', 'captcha|just a moment')} THEN 'challenge' WHEN length({t}) < 40 THEN 'too_short' WHEN NOT {d.like(t, d(r'\p{L}', r'\pL'))} THEN 'no_script' WHEN {d.like(f'lower({t})', '^(home|menu)')} THEN 'navigation' ELSE 'ok' END"
    return f"""SELECT 'page' AS kind, page_id AS id, {gate("coalesce(html, '')")} AS gate FROM {d.t('pages')}
UNION ALL SELECT 'document', doc_id, {gate("coalesce(text, '')")} FROM {d.t('documents')}"""


def inline_warnings(d: Dialect) -> str:
    """Warning list of each record by plain containment."""
    w = d.compact("CASE WHEN low LIKE '%password%' THEN 'secret' END", "CASE WHEN low LIKE '%@%' THEN 'address' END", "CASE WHEN low LIKE '%licensed under%' THEN 'licence' END", "CASE WHEN hits = 0 THEN 'irrelevant' END", "CASE WHEN len < 100 THEN 'short' END")
    return f"WITH {_base(d)} SELECT doc_id, {d.join('w', ';')} AS warnings FROM (SELECT doc_id, {w} AS w FROM h) x WHERE {d.size('w')} > 0"


def whitelist_check(d: Dialect) -> str:
    """Part names with a word outside the whitelist, and the words."""
    allowed = d.array(*[f"'{w}'" for w in "SMALL LARGE RED RING WIDGET BOLT GEAR".split()])
    bad = d.keep("split(upper(p_name), ' ')", "w", d(f"NOT array_contains({allowed}, w)", f"NOT list_contains({allowed}, w)"))
    return f"SELECT p_partkey, {d.join('bad', ',')} AS unauthorised FROM (SELECT p_partkey, {bad} AS bad FROM {d.t('part')}) x WHERE {d.size('bad')} > 0"


def default_patterns(d: Dialect) -> str:
    """Value distribution by year with share and bias flag."""
    return f"""WITH o AS (SELECT substring({d.day('o_orderdate')}, 1, 4) AS yr, o_orderpriority AS v FROM {d.t('orders')}),
n AS (SELECT yr, v, count(*) AS n FROM o GROUP BY yr, v)
SELECT yr, v, n, {d.double('n')} / sum(n) OVER (PARTITION BY yr) AS share, n > 0.8 * sum(n) OVER (PARTITION BY yr) AS biased FROM n ORDER BY yr DESC, n DESC, v"""


def dictionary_consistency(d: Dialect) -> str:
    """Dictionary joins: a nation's expected region by substring, first match by list order, and its reverse."""
    rules = " UNION ALL ".join(f"SELECT {i} AS pos, '{k}' AS key, {r} AS region" for i, (k, r) in enumerate((("AN", 2), ("IA", 2), ("IN", 1), ("E", 3), ("A", 0))))
    return f"""WITH r AS ({rules}),
m AS (SELECT n_nationkey, n_name, n_regionkey, pos, key, region, row_number() OVER (PARTITION BY n_nationkey ORDER BY pos) AS rn FROM {d.t('nation')} JOIN r ON contains(upper(n_name), key))
SELECT n_nationkey, n_name, key AS matched, region = n_regionkey AS consistent FROM m WHERE rn = 1"""


def integrity_audit(d: Dialect) -> str:
    """Audits over page urls in one pass: odd numbers, duplicates, lengths, characters."""
    rows = d.array(d.struct(issue="'no_number'", v="CASE WHEN num IS NULL THEN url END"), d.struct(issue="'number_mismatch'", v="CASE WHEN try_cast(num AS BIGINT) <> page_id THEN num END"),
                   d.struct(issue="'too_long'", v="CASE WHEN length(url) > 45 THEN url END"), d.struct(issue="'query'", v="CASE WHEN url LIKE '%?%' THEN url END"), d.struct(issue="'fragment'", v="CASE WHEN url LIKE '%#%' THEN url END"),
                   d.struct(issue="'duplicate'", v="CASE WHEN n > 1 THEN num END"))
    return f"""WITH u AS (SELECT page_id, url, {d.grab('url', '/([0-9]+)(?:[/?#]|$)')} AS num FROM {d.t('pages')}), c AS (SELECT num AS k, count(*) AS n FROM u WHERE num IS NOT NULL GROUP BY num),
j AS (SELECT page_id, url, num, n FROM u LEFT JOIN c ON u.num = c.k), x AS (SELECT page_id, {d.each(rows)} AS x FROM j)
SELECT x.issue AS issue, page_id, x.v AS current_value FROM x WHERE x.v IS NOT NULL"""


QUERIES, ORACLES = registry(checks_fused, checks_summary, check_samples, keyword_relevance, evidence_check, date_checks, row_validation, content_gates,
                            inline_warnings, whitelist_check, default_patterns, dictionary_consistency, integrity_audit)
