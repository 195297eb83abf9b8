"""Tags, URLs and text rewriting: mapping cascades, similarity, slugs, clean-up, fixes."""

from __future__ import annotations

from docloom.plans.dialect import Dialect, registry

#: own vocabulary that free tags are mapped onto, in order of preference
VOCABULARY = ("small ring", "large red ring", "small blue bolt", "red widgets and bolts", "blue steel bolt", "large hot gear", "green nut", "tiny pin")


def _vocabulary(d: Dialect) -> str:
    return " UNION ALL ".join(f"SELECT {i} AS pos, '{v}' AS entry" for i, v in enumerate(VOCABULARY))


def tag_dedup(d: Dialect) -> str:
    """Delimited tags split, trimmed, blanks dropped, repeated ones dropped, joined again in sorted order."""
    tags = d.distinct(d.keep(d.map("split(raw, ';')", "x", "trim(x)"), "x", "x <> ''"))
    raw = "p_brand || ' ; ' || split(p_type, ' ')[{}] || ';;' || p_brand || ' ;' || p_type".format(d("0", "1"))
    return f"SELECT p_partkey, {d.join(d.sort(tags), '; ')} AS tags, {d.size(tags)} AS n_tags FROM (SELECT p_partkey, p_type, p_brand, {raw} AS raw FROM {d.t('part')}) x"


def all_tags(d: Dialect) -> str:
    """Distinct values of all tag columns of an order's lines."""
    return f"""SELECT l_orderkey, {d.join(d.gather_set('tag'), ',')} AS all_tags, count(DISTINCT tag) AS n FROM
(SELECT l_orderkey, {d.each(d.array('l_returnflag', 'l_linestatus', "CASE WHEN l_discount > 0.05 THEN 'discounted' END"))} AS tag FROM {d.t('lineitem')}) x WHERE tag IS NOT NULL GROUP BY l_orderkey"""


def tag_inventory(d: Dialect) -> str:
    """Every word of the type column with its count, and whether it is an entry's word."""
    return f"""WITH v AS (SELECT DISTINCT {d.each("split(entry, ' ')")} AS w FROM ({_vocabulary(d)}) x), t AS (SELECT {d.each("split(lower(p_name), ' ')")} AS w FROM {d.t('part')})
SELECT t.w AS tag, count(*) AS n, max(CASE WHEN v.w IS NOT NULL THEN 1 ELSE 0 END) = 1 AS authorised FROM t LEFT JOIN v ON t.w = v.w GROUP BY t.w"""


def _matches(d: Dialect, over: str) -> str:
    return f"""
t AS (SELECT DISTINCT lower(p_name) AS tag FROM {d.t('part')}),
w AS (SELECT tag, {d.words('tag')} AS w FROM t), v AS (SELECT pos, entry, {d.words('entry')} AS vw FROM ({_vocabulary(d)}) x),
m AS (SELECT tag, pos, entry, {d.jaccard('w', 'vw')} AS similarity FROM w CROSS JOIN v WHERE {d.size('w')} >= 2),
best AS (SELECT tag, entry, similarity FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY similarity DESC, pos) AS rn FROM m WHERE similarity {over}) r WHERE rn = 1)"""


def fuzzy_best_match(d: Dialect) -> str:
    """Best vocabulary entry of each distinct tag of two words or more, by word similarity of 0.5 or more; ties by list order."""
    return f"WITH {_matches(d, '>= 0.5')} SELECT tag, entry, similarity FROM best"


def tag_mapping_cascade(d: Dialect) -> str:
    """Exact, then prefix, then similarity, then the fallback: on distinct tags, joined back to the rows."""
    return f"""WITH {_matches(d, '> 0.5')},
p AS (SELECT tag, entry FROM (SELECT t.tag, v.entry, row_number() OVER (PARTITION BY t.tag ORDER BY v.pos) AS rn FROM t JOIN v ON split(t.tag, ' ')[{d('0', '1')}] = split(v.entry, ' ')[{d('0', '1')}]) r WHERE rn = 1),
c AS (SELECT t.tag, coalesce(v.entry, p.entry, best.entry, 'other') AS mapped, CASE WHEN v.entry IS NOT NULL THEN 'exact' WHEN p.entry IS NOT NULL THEN 'prefix' WHEN best.entry IS NOT NULL THEN 'similarity' ELSE 'fallback' END AS method
  FROM t LEFT JOIN v ON t.tag = v.entry LEFT JOIN p ON t.tag = p.tag LEFT JOIN best ON t.tag = best.tag)
SELECT p_partkey, mapped, method FROM {d.t('part')} JOIN c ON lower(p_name) = c.tag"""


def mapping_report(d: Dialect) -> str:
    """Tags and share of each mapping method."""
    return f"""SELECT method, count(*) AS n, {d.double('count(*)')} / max(total) * 100 AS share FROM ({tag_mapping_cascade(d)}) x CROSS JOIN (SELECT count(*) AS total FROM {d.t('part')}) y GROUP BY method"""


def mapping_changed_rows(d: Dialect) -> str:
    """Rows that a mapping changes, with collisions against stored names."""
    return f"""WITH n AS (SELECT p_partkey, p_name, lower({d.swap('p_name', '^small ', 'tiny ')}) AS renamed FROM {d.t('part')})
SELECT n.p_partkey, n.renamed, EXISTS (SELECT 1 FROM {d.t('part')} o WHERE o.p_name = n.renamed AND o.p_partkey <> n.p_partkey) AS collides FROM n WHERE n.p_name <> n.renamed"""


def tag_typos(d: Dialect) -> str:
    """Unknown words with the vocabulary word that shares most letters."""
    v = f"(SELECT DISTINCT {d.each("split(entry, ' ')")} AS word FROM ({_vocabulary(d)}) x)"
    letters = lambda x: d.distinct(f"split({x}, '')" if d.spark else f"string_split({x}, '')")
    return f"""WITH t AS (SELECT DISTINCT {d.each("split(lower(p_name), ' ')")} AS tag FROM {d.t('part')}), v AS {v},
m AS (SELECT tag, word, {d.jaccard(d.keep(letters('tag'), 'c', "c <> ''"), d.keep(letters('word'), 'c', "c <> ''"))} AS similarity FROM t CROSS JOIN v WHERE tag NOT IN (SELECT word FROM v))
SELECT tag, word AS suggestion, similarity FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY similarity DESC, word) AS rn FROM m WHERE similarity > 0.4) r WHERE rn = 1"""


def prefix_match(d: Dialect) -> str:
    """The first entry that starts with a tag's first word, or whose start the tag has."""
    return f"""SELECT p_partkey, entry FROM (SELECT p_partkey, entry, row_number() OVER (PARTITION BY p_partkey ORDER BY pos) AS rn FROM {d.t('part')} JOIN ({_vocabulary(d)}) v
ON starts_with(entry, split(lower(p_name), ' ')[{d('0', '1')}]) OR starts_with(lower(p_name), substring(entry, 1, 10))) r WHERE rn = 1""".replace("starts_with", d("startswith", "starts_with"))


def tag_validation_counts(d: Dialect) -> str:
    """Checked, invalid and correctable types by brand."""
    fixed = d.swap(d.swap("upper(p_type)", "ANODISED", "ANODIZED"), r"\s+", " ")
    return f"""SELECT p_brand, count(*) AS checked, {d.flag(f"NOT {d.like('upper(p_type)', '(TIN|NICKEL|BRASS|STEEL|COPPER)$')}")} AS invalid, {d.flag(f'{fixed} <> p_type')} AS corrected FROM {d.t('part')} GROUP BY p_brand"""


def special_tag_score(d: Dialect) -> str:
    """Weighted keyword score of each document in bands of 60, 35 and 15."""
    weights = {"password": 30, "licensed": 15, "idiot": 30, "clown": 15, "pathetic": 15, "the ": 3, "copyright": 8}
    score = " + ".join(f"CASE WHEN contains(low, '{k}') THEN {w} ELSE 0 END" for k, w in weights.items())
    return f"""WITH s AS (SELECT doc_id, {d.long(score)} AS score FROM (SELECT doc_id, lower(coalesce(text, '')) AS low FROM {d.t('documents')}) x)
SELECT doc_id, score, CASE WHEN score >= 60 THEN 'strong' WHEN score >= 35 THEN 'medium' WHEN score >= 15 THEN 'weak' ELSE 'none' END AS band FROM s"""


def profile_relevance(d: Dialect) -> str:
    """Keyword share of each language profile over the whole text ; best profile and confidence of each document."""
    from docloom.plans.checks import TAGS

    share = {t: f"{d.double(d.size(d.both('w', d.array(*[repr(x) for x in ws]))))} / {len(ws)}" for t, ws in TAGS.items()}
    weigh = ", ".join(f"s_{t} * 10 + CASE WHEN lang = '{t}' THEN 1 ELSE 0 END" for t in TAGS)
    best = "CASE " + " ".join(f"WHEN s_{t} * 10 + CASE WHEN lang = '{t}' THEN 1 ELSE 0 END = greatest({weigh}) THEN '{t}'" for t in TAGS) + " END"
    over = " + ".join(f"CASE WHEN s_{t} >= 0.3 THEN 1 ELSE 0 END" for t in TAGS)
    foreign = " + ".join(f"CASE WHEN s_{t} >= 0.3 AND lang <> '{t}' THEN 1 ELSE 0 END" for t in TAGS)
    return f"""WITH d AS (SELECT doc_id, lang, {d.words("coalesce(text, '')")} AS w FROM {d.t('documents')}), s AS (SELECT doc_id, lang, {', '.join(f'{e} AS s_{t}' for t, e in share.items())} FROM d)
SELECT doc_id, {d.double(over)} / {len(TAGS)} AS confidence, {best} AS best, {d.long(foreign)} AS n_foreign FROM s"""


def alignment_score(d: Dialect) -> str:
    """Similarity of a summary's words with those of the whole rest of the text, with floor, cap and verdict."""
    return f"""WITH d AS (SELECT doc_id, {d.words("substring(coalesce(text, ''), 1, 200)")} AS a, {d.words("substring(coalesce(text, ''), 201)")} AS b FROM {d.t('documents')}),
j AS (SELECT doc_id, {d.jaccard('a', 'b')} AS j FROM d), s AS (SELECT doc_id, CASE WHEN j < 0.05 THEN least(j, 0.4) WHEN j > 0.1 THEN greatest(j, 0.7) ELSE j END AS score FROM j)
SELECT doc_id, score, score >= 0.7 AS aligned FROM s"""


def operativity_override(d: Dialect) -> str:
    """Class flipped by ordered patterns of the other class."""
    low = "lower(coalesce(text, ''))"
    return f"""SELECT doc_id, CASE WHEN quality = 1 AND {d.like(low, 'idiot|clown|pathetic|worthless')} THEN 'flipped_down' WHEN quality = 0 AND {d.like(low, 'licensed under')} THEN 'flipped_up' WHEN quality IS NULL AND {d.like(low, 'password|token')} THEN 'operative' WHEN quality IS NULL THEN 'unclear' ELSE 'kept' END AS outcome
FROM (SELECT d.doc_id, text, quality FROM {d.t('documents')} d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM {d.t('labels')} GROUP BY doc_id) l ON d.doc_id = l.doc_id) x"""


def text_cleanup(d: Dialect) -> str:
    """White space collapsed, marks dropped, truncated ends repaired, head and tail excerpt, token budget."""
    clean = d.swap(d.swap("coalesce(text, '')", "[​‎‏﻿]", ""), "[ \t\r\n]+", " ")
    return f"""WITH c AS (SELECT doc_id, trim({clean}) AS c FROM {d.t('documents')}), s AS (SELECT doc_id, c, substring(c, 1, 160) AS s FROM c)
SELECT doc_id, md5(c) AS clean_md5, CASE WHEN {d.like('s', '[.!?]$')} THEN s ELSE {d.swap('s', ' [^ ]*$', '')} || '...' END AS summary,
  CASE WHEN length(c) > 400 THEN substring(c, 1, 280) || ' [...] ' || substring(c, length(c) - 119, 120) ELSE c END AS excerpt,
  {d.long("CASE WHEN length(c) < 2000 THEN 200 WHEN length(c) < 5000 THEN 400 WHEN length(c) < 10000 THEN 600 WHEN length(c) < 20000 THEN 800 ELSE 1000 END")} AS token_budget FROM s"""


def label_extract(d: Dialect) -> str:
    """Labelled values: what follows a label, and the first dotted or ISO date."""
    return f"""SELECT doc_id, {d.grab('text', 'password ?= ?([A-Za-z0-9]+)')} AS value, {d.grab('text', 'Licensed under (?:the )?([A-Z][A-Za-z]+)')} AS licence, {d.grab('text', '([0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3})')} AS address
FROM {d.t('documents')} WHERE {d.like('text', 'password ?=|Licensed under|[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}')}"""


def date_extract(d: Dialect) -> str:
    """DD.MM.YYYY written into text and read back as ISO, with a range test."""
    s = "substring(iso, 9, 2) || '.' || substring(iso, 6, 2) || '.' || substring(iso, 1, 4)"
    return f"""WITH o AS (SELECT o_orderkey, {d.day('o_orderdate')} AS iso FROM {d.t('orders')}), t AS (SELECT o_orderkey, 'signed on ' || {s} || ' by x' AS t FROM o),
p AS (SELECT o_orderkey, {d.grab('t', '([0-9]{2})[.][0-9]{2}[.][0-9]{4}')} AS dd, {d.grab('t', '[0-9]{2}[.]([0-9]{2})[.][0-9]{4}')} AS mm, {d.grab('t', '[0-9]{2}[.][0-9]{2}[.]([0-9]{4})')} AS yy FROM t)
SELECT o_orderkey, CASE WHEN yy BETWEEN '1993' AND '2027' THEN yy || '-' || mm || '-' || dd END AS day FROM p"""


def word_sets(d: Dialect) -> str:
    """Words over two letters without stop words, as a sorted set."""
    return f"""SELECT doc_id, {d.size('w')} AS n_words, md5({d.join(d.sort('w'), ' ')}) AS set_md5 FROM (SELECT doc_id, {d.keep(d.words("coalesce(text, '')"), 'w', "length(w) > 2 AND w NOT IN ('the', 'and', 'les', 'der', 'und', 'que')")} AS w FROM {d.t('documents')}) x"""


def affix_strip(d: Dialect) -> str:
    """Prefix letters and the longest suffix taken off brand words while enough remains."""
    one = "CASE WHEN length(w) > 3 AND substring(w, 1, 1) IN ('s', 'b', 'l', 'm', 'p', 'e') THEN substring(w, 2) ELSE w END"
    suffix = lambda x: d.swap(x, "^(.{3,}?)(ished|ized|ated|ed|s)$", d("$1", "\\1"))
    return f"SELECT w, s1, {suffix('s1')} AS stem FROM (SELECT w, {one} AS s1 FROM (SELECT DISTINCT {d.each("split(lower(p_type), ' ')")} AS w FROM {d.t('part')}) a) b"


def post_process_chain(d: Dialect) -> str:
    """Dedup, normalise, drop generic values, enforce the whitelist, fall back: one projection after another."""
    tags = d.distinct(d.keep(d.map("split(lower(p_type), ' ')", "x", "CASE x WHEN 'burnished' THEN 'polished' WHEN 'anodized' THEN 'plated' ELSE x END"), "x", "x NOT IN ('standard', 'promo')"))
    allowed = d.keep("t", "x", "x IN ('tin', 'nickel', 'brass', 'steel', 'copper', 'polished', 'plated', 'brushed')")
    return f"""WITH a AS (SELECT p_partkey, {tags} AS t FROM {d.t('part')}), b AS (SELECT p_partkey, {allowed} AS t FROM a)
SELECT p_partkey, CASE WHEN {d.size('t')} = 0 THEN 'other' ELSE {d.join(d.sort('t'), '; ')} END AS tags FROM b"""


def fix_values(d: Dialect) -> str:
    """Typos mapped, unknown values cleared, values without evidence dropped."""
    return f"""SELECT doc_id, CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' WHEN 'de' THEN 'german' ELSE '' END AS lang_fixed,
  CASE WHEN contains(lower(coalesce(text, '')), 'licensed') THEN source ELSE '' END AS source_fixed FROM {d.t('documents')}"""


def name_parse(d: Dialect) -> str:
    """A labelled number and what follows it."""
    return f"SELECT s_suppkey, try_cast({d.grab('s_name', '([0-9]+)')} AS BIGINT) AS num, {d.grab('s_name', '^([A-Za-z]+)')} AS label FROM {d.t('supplier')}"


def url_validation(d: Dialect) -> str:
    """Valid, missing and odd urls of each host kind, with the number pattern they have."""
    return f"""WITH u AS (SELECT page_id, url, {d.grab('url', '^https?://([a-z]+)[.]')} AS sub, {d.grab('url', '/([0-9]+)(?:[/?#]|$)')} AS num FROM {d.t('pages')})
SELECT CASE WHEN sub IN ('www', 'blog', 'm') THEN sub ELSE 'bare' END AS kind, count(*) AS n, {d.flag('num IS NULL')} AS missing, {d.flag('try_cast(num AS BIGINT) = page_id')} AS matching, {d.flag('abs(try_cast(num AS BIGINT) - page_id) > 100')} AS far_off,
  {d.double(d.flag('num IS NOT NULL'))} / count(*) AS rate FROM u GROUP BY 1"""


def slug_families(d: Dialect) -> str:
    """Slugs by ordered pattern families, with their parts."""
    slug = d.swap(d.swap("url", "^[a-z]+://[^/]+/", ""), "[?#].*$", "")
    fam = f"CASE WHEN {d.like('slug', '^[a-z]{2}/[0-9]+$')} THEN 'plain' WHEN {d.like('slug', '^[a-z]{2}/[0-9]+/$')} THEN 'slash' WHEN {d.like('slug', '^[a-z]{2}/[0-9]+/[0-9]+$')} THEN 'paged' WHEN slug = '' THEN 'root' ELSE 'unknown' END"
    return f"SELECT page_id, slug, {fam} AS family, {d.grab('slug', '^([a-z]{2})/')} AS lang, try_cast({d.grab('slug', '/([0-9]+)')} AS BIGINT) AS num FROM (SELECT page_id, {slug} AS slug FROM {d.t('pages')}) x"


def mismatch_kinds(d: Dialect) -> str:
    """Kinds of difference between a page's number and its url's."""
    letters = lambda x: d.join(d.sort(f"split(CAST({x} AS VARCHAR(20)), '')" if d.spark else f"string_split(CAST({x} AS VARCHAR), '')"), "")
    return f"""WITH u AS (SELECT page_id, try_cast({d.grab('url', '/([0-9]+)(?:[/?#]|$)')} AS BIGINT) AS num FROM {d.t('pages')}),
k AS (SELECT page_id, num, CASE WHEN num IS NULL THEN 'missing' WHEN num = page_id THEN 'same' WHEN abs(num - page_id) = 1 THEN 'off_by_one' WHEN {letters('num')} = {letters('page_id')} THEN 'transposed' WHEN abs(num - page_id) <= 10 THEN 'small' WHEN num > 10 * (page_id + 1) THEN 'magnitude' ELSE 'large' END AS kind FROM u)
SELECT kind, count(*) AS n, min(page_id) AS first_page FROM k GROUP BY kind"""


def candidate_urls(d: Dialect) -> str:
    """Candidate urls of each page in order of trial."""
    items = ["host || '/' || CAST(page_id AS VARCHAR(20))"] + [f"host || '/{l}/' || CAST(page_id AS VARCHAR(20))" for l in ("en", "fr")] + [f"host || '/' || CAST(page_id AS VARCHAR(20)) || '{s}'" for s in ("a", "b", "-a")]
    rows = d.array(*[d(f"named_struct('pos', {i}L, 'u', {e})", f"{{'pos': {i}::BIGINT, 'u': {e}}}") for i, e in enumerate(items)])
    return f"SELECT page_id, x.pos AS pos, x.u AS candidate FROM (SELECT page_id, {d.each(rows)} AS x FROM (SELECT page_id, {d.grab('url', '^(https?://[^/]+)')} AS host FROM {d.t('pages')}) a) b"


def url_sort(d: Dialect) -> str:
    """All urls by number down, host up, unknown numbers last."""
    return f"""SELECT page_id, url FROM (SELECT page_id, url, try_cast({d.grab('url', '/([0-9]+)(?:[/?#]|$)')} AS BIGINT) AS num FROM {d.t('pages')}) x ORDER BY CASE WHEN num IS NULL THEN 1 ELSE 0 END, num DESC, url, page_id"""


def drop_classification(d: Dialect) -> str:
    """Reasons to drop a page; one page may have several."""
    r = d.compact(f"CASE WHEN {d.grab('url', '/([0-9]+)')} IS NULL THEN 'invalid_format' END", "CASE WHEN html NOT LIKE '%</html>%' THEN 'truncated' END", f"CASE WHEN {d.like('url', '^http:')} THEN 'insecure' END")
    return f"SELECT reason, count(*) AS n FROM (SELECT {d.each(r)} AS reason FROM {d.t('pages')}) x GROUP BY reason"


QUERIES, ORACLES = registry(tag_dedup, all_tags, tag_inventory, fuzzy_best_match, tag_mapping_cascade, mapping_report, mapping_changed_rows, tag_typos, prefix_match,
                            tag_validation_counts, special_tag_score, profile_relevance, alignment_score, operativity_override, text_cleanup, label_extract, date_extract,
                            word_sets, affix_strip, post_process_chain, fix_values, name_parse, url_validation, slug_families, mismatch_kinds, candidate_urls, url_sort, drop_classification)
