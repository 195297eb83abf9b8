"""Tagged records: checks, validators and post-processing over rule packs.

A document stands in for a record; its tags, bodies, places, committee, class and
summary are derived from its key, with faults of every kind, and a closing
sentence gives some of them evidence. The rule packs are this library's own.
"""

from __future__ import annotations

from docloom.plans.dialect import Dialect, registry

#: tag -> words that speak for it
KEYWORDS: dict[str, tuple[str, ...]] = {
    "health": ("hospital", "nurse"), "law": ("statute", "regulation"), "budget": ("million", "budget"), "appointments": ("appoint", "term of office"), "culture": ("museum", "theatre"), "admin": ("working group", "travel")}
FALLBACK = "other"
TAG_LIST = (*KEYWORDS, FALLBACK)
#: body -> words that name it, the tag that implies it
BODY_WORDS: dict[str, tuple[str, ...]] = {"police": ("police",), "army": ("army", "soldier"), "treasury": ("treasury", "finance minister"), "health ministry": ("health ministry", "minister of health"), "media office": ("media office", "press office")}
BODY_TAG: dict[str, str] = {"police": "law", "army": "law", "treasury": "budget", "health ministry": "health", "media office": "culture"}
#: spelling -> body, empty where the name is dropped
BODY_MAP: dict[str, str] = {"ministry of health": "health ministry", "health min": "health ministry", "the cabinet": "", "press office": "media office"}
#: variant contained in a committee's name -> its name, in order
COMMITTEES: tuple[tuple[str, str], ...] = (("ministerial committee for law", "law committee"), ("committee on budget", "budget committee"), ("law committee", "law committee"), ("health", "health committee"))
COMMITTEE_TAGS: dict[str, tuple[str, ...]] = {"law": ("law", "admin"), "budget": ("budget",), "health": ("health",)}
PLACE_BODIES: dict[str, tuple[str, ...]] = {"north": ("army", "police"), "capital": ("treasury",), "south": ("police",)}
GENERIC_PLACES = ("the country", "everywhere", "abroad")
TYPOS: dict[str, str] = {"opertive": "operative", "declartive": "declarative"}
OPERATIVE = ("allocate", "shall", "appoint", "approve")
DECLARATIVE = ("takes note", "expresses", "welcomes")
SPECIAL: dict[str, tuple[str, ...]] = {"northern recovery": ("north", "border"), "women": ("women", "gender")}
COMBOS = ("police; treasury", "treasury")
SUSPICIOUS = ("culture", "health")


def _array(d: Dialect, items) -> str:
    return d.array(*[d.lit(x) for x in items]) if items else d.none()


def _case(x: str, pack: dict[str, str], otherwise: str = "NULL") -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in pack.items()) + f" ELSE {otherwise} END"


def _hits(d: Dialect, words, text: str = "low") -> str:
    """How many of the words a text holds."""
    return "(" + " + ".join(f"CASE WHEN contains({text}, '{w}') THEN 1 ELSE 0 END" for w in words) + ")"


def _pick(by: int, *values: str) -> str:
    return f"CASE doc_id % {by} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " ELSE '' END"


def records(d: Dialect) -> str:
    """r: one row a document that has an id."""
    said = _pick(11, " the police and the army met; a soldier was hurt", " one million is allocated from the budget by the treasury", " the government takes note of the statute", " to appoint a nurse to the hospital for a term of office",
                 " the museum and the theatre, in the north by the border", " travel of the working group", " the regulation shall be approved by the press office", " it welcomes women and expresses thanks in the capital")
    return f"""r0 AS (SELECT doc_id, source, trim(substring(coalesce(text, ''), 1, 60)) AS title, coalesce(text, '') || {said} AS content FROM {d.t('documents')} WHERE doc_id IS NOT NULL),
r AS (SELECT doc_id, title, content, lower(content || ' ' || title) AS low, length(content) AS len,
  CASE WHEN doc_id % 5 = 0 THEN 'Decision number 12 of the government: ' ELSE '' END || trim(substring(content, greatest(length(content) - 119, 1), 120)) AS summary,
  {_pick(6, 'operative', 'declarative', 'opertive', ' declarative', '', 'n/a')} AS operativity,
  {_pick(7, 'health; law', 'other', 'law;;health;law', 'helth', 'budget; placeholder 1', 'appointments; culture; budget')} AS policy,
  {_pick(8, 'police; treasury', 'treasury', 'media office; police', 'ministry of health', 'the cabinet; army', 'health min; police', 'law committee (special)')} AS bodies,
  {_pick(5, 'north, capital', 'the country', 'south', 'atlantis, everywhere')} AS places,
  {_pick(4, 'ministerial committee for law ', 'committee  on   budget', 'board')} AS committee,
  {_pick(9, 'northern recovery', 'women', 'northern recovery; women')} AS special,
  2019 + doc_id % 7 AS yr, CAST(25 + doc_id % 13 AS VARCHAR(20)) || '_' || CAST(doc_id AS VARCHAR(20)) AS record_key FROM r0),
a AS (SELECT *, {d.items('policy')} AS tags, {d.items('bodies')} AS body_list, {d.items('places', ',')} AS place_list, {_hits(d, OPERATIVE)} AS op_hits, {_hits(d, DECLARATIVE)} AS decl_hits FROM r)"""


def _named(d: Dialect, body: str) -> str:
    """Whether a text names a body: by its words, else by its name."""
    return "CASE " + " ".join(f"WHEN {body} = '{b}' THEN {_hits(d, ws)} > 0" for b, ws in BODY_WORDS.items()) + f" ELSE contains(low, {body}) END"


def _implied(d: Dialect, body: str, tags: str = "tags") -> str:
    """Whether a body follows from a tag it belongs to, or from two words of that tag."""
    return "CASE " + " ".join(f"WHEN {body} = '{b}' THEN {d.has(tags, d.lit(t))} OR {_hits(d, KEYWORDS[t])} >= 2" for b, t in BODY_TAG.items()) + " ELSE false END"


def _place_found(d: Dialect, place: str) -> str:
    """Whether a text has a place, or any of its words of more than two characters."""
    return f"(contains(low, {place}) OR {d.any(d.keep(f'split({place}, {chr(39)} {chr(39)})', 'w', 'length(w) > 2'), 'w', 'contains(low, w)')})"


def _tag_told(d: Dialect, tag: str, text: str) -> str:
    """Whether a text has a tag's name or one of its keywords."""
    words = "CASE " + " ".join(f"WHEN {tag} = '{t}' THEN {_hits(d, ws, text)} > 0" for t, ws in KEYWORDS.items()) + " ELSE false END"
    return f"(contains({text}, {tag}) OR {words})"


def _decided(d: Dialect) -> str:
    """The day of a record: in June of its year."""
    return d("make_date(CAST(yr AS INT), 6, 15)", "make_date(CAST(yr AS INTEGER), 6, 15)")


def _era(d: Dialect, days: int) -> str:
    """So many days after a government's first: 200 days lie between two of them, and one lasts 400."""
    n = f"(doc_id % 13) * 200 + {days}"
    return d(f"date_add(CAST('2018-01-01' AS DATE), CAST({n} AS INT))", f"CAST('2018-01-01' AS DATE) + CAST({n} AS INTEGER)")


GARBAGE = "(len < 100 OR contains(low, 'cloudflare') OR contains(low, 'just a moment'))"


def _issues(d: Dialect) -> dict[str, str]:
    """check key -> severity or NULL over the columns of a."""
    committee = "CASE " + " ".join(
        f"WHEN contains(committee, '{k}') THEN CASE WHEN {' OR '.join(d.has('tags', d.lit(t)) for t in ts)} THEN NULL ELSE 'low' END" for k, ts in COMMITTEE_TAGS.items()) + " END"
    place = " OR ".join(f"(contains(places, '{k}') AND NOT ({' OR '.join(d.has('body_list', d.lit(b)) for b in bs)}))" for k, bs in PLACE_BODIES.items())
    named = d.size(d.keep("body_list", "b", _named(d, "b")))
    words = "CASE " + " ".join(f"WHEN {d.at('tags', 1)} = '{t}' THEN {_hits(d, KEYWORDS[t])}" for t in SUSPICIOUS) + " END"
    expected = "CASE " + " ".join(f"WHEN {d.at('tags', 1)} = '{t}' THEN {' OR '.join(d.has('body_list', d.lit(b)) for b, x in BODY_TAG.items() if x == t)}" for t in ("health", "law", "budget", "culture")) + " ELSE true END"
    title = d.words("CASE WHEN doc_id % 19 = 0 THEN 'quarterly figures about something unrelated' ELSE title END")  # some records have another one's title
    return {
        "operativity-vs-content": "CASE WHEN operativity = 'operative' AND decl_hits > 0 AND op_hits = 0 THEN 'high' WHEN operativity = 'declarative' AND op_hits > 0 AND decl_hits = 0 THEN 'medium' END",
        "tag-body": f"CASE WHEN bodies <> '' AND {d.size('tags')} = 1 AND NOT ({expected}) THEN 'low' END",
        "committee-tag": f"CASE WHEN committee <> '' AND policy <> '' THEN {committee} END",
        "location-vs-body": f"CASE WHEN places <> '' AND bodies <> '' AND ({place}) THEN 'low' END",
        "location-hallucination": f"CASE WHEN {d.any('place_list', 'p', f'NOT {_place_found(d, chr(112))}')} THEN 'medium' END",
        "government-body-hallucination": f"CASE WHEN bodies = '' OR {GARBAGE} THEN NULL WHEN {named} = 0 THEN 'high' WHEN {named} < {d.size('body_list')} THEN 'low' END",
        "body-default": f"CASE WHEN {GARBAGE} OR bodies NOT IN ({', '.join(map(repr, COMBOS))}) THEN NULL WHEN {named} = 0 THEN 'high' WHEN {named} < {d.size('body_list')} THEN 'low' END",
        "policy-default": f"CASE WHEN {GARBAGE} OR {d.size('tags')} <> 1 OR {d.at('tags', 1)} NOT IN ({', '.join(map(repr, SUSPICIOUS))}) THEN NULL WHEN {words} = 0 THEN 'high' END",
        "operativity-validity": "CASE WHEN trim(operativity) NOT IN ('operative', 'declarative', '') THEN 'high' END",
        "policy-fallback": f"CASE WHEN {d.size('tags')} = 1 AND {d.at('tags', 1)} = '{FALLBACK}' THEN 'medium' END",
        "summary-vs-tags": f"CASE WHEN length(summary) >= 60 AND {d.size('tags')} > 0 AND NOT {d.any('tags', 't', _tag_told(d, 't', 'lower(summary)'))} THEN 'low' END",
        "date-vs-government": f"CASE WHEN {_decided(d)} < {_era(d, -30)} OR {_decided(d)} > {_era(d, 430)} THEN 'high' END",
        "title-vs-content": f"CASE WHEN {d.size(title)} >= 3 AND 5 * {d.size(d.keep(title, 'w', 'contains(lower(content), w)'))} < {d.size(title)} THEN 'medium' END",
        "tag-consistency": f"CASE WHEN {d.any('tags', 't', f'NOT {d.has(_array(d, TAG_LIST), chr(116))}')} THEN 'medium' END",
    }


#: checks that hold one field against another, scanned together
CROSS_FIELD = (
    "operativity-vs-content", "tag-body", "committee-tag", "summary-vs-tags", "location-vs-body", "date-vs-government", "title-vs-content", "body-default", "policy-default")


def _scan(d: Dialect, names) -> str:
    every = _issues(d)
    cols = ", ".join(f"{every[n]} AS c{i}" for i, n in enumerate(names))
    rows = d.array(*[d.struct(check_key=d.lit(n), severity=f"c{i}") for i, n in enumerate(names)])
    return f"""{records(d)}, c AS (SELECT doc_id, record_key, operativity, {cols} FROM a), x AS (SELECT doc_id, record_key, operativity, {d.each(rows)} AS x FROM c),
i AS (SELECT doc_id, record_key, operativity, x.check_key AS check_key, x.severity AS severity FROM x WHERE x.severity IS NOT NULL)"""


def tagged_checks(d: Dialect) -> str:
    """All checks over tagged records in one pass, with the value a typo should have."""
    typo = _case("trim(operativity)", {k: f"'{v}'" for k, v in TYPOS.items()}, "''")
    return f"WITH {_scan(d, tuple(_issues(d)))} SELECT doc_id, record_key, check_key, severity, CASE WHEN check_key = 'operativity-validity' THEN {typo} ELSE '' END AS expected FROM i"


def cross_field_checks(d: Dialect) -> str:
    """The cross-field group: issues by check and severity."""
    return f"WITH {_scan(d, CROSS_FIELD)} SELECT check_key, severity, count(*) AS n, min(doc_id) AS first_id FROM i GROUP BY check_key, severity"


def named_checks(d: Dialect) -> str:
    """A list of checks by name, as a user gives it: those that are known are run, in one pass; unknown names are skipped."""
    asked = ("policy-fallback", "no-such-check", "title-vs-content", "tag-consistency", "")
    return f"WITH {_scan(d, tuple(n for n in asked if n in _issues(d)))} SELECT check_key, severity, count(*) AS n, min(doc_id) AS first_id FROM i GROUP BY check_key, severity"


def suspicious_bodies(d: Dialect) -> str:
    """Default-looking body combinations: rows, without evidence, with some of it."""
    named = d.size(d.keep("body_list", "b", _named(d, "b")))
    return f"""WITH {records(d)} SELECT bodies, count(*) AS total, {d.flag(f'{named} = 0')} AS flagged, {d.flag(f'{named} > 0 AND {named} < {d.size("body_list")}')} AS partly
FROM a WHERE bodies IN ({', '.join(map(repr, COMBOS))}) AND NOT {GARBAGE} GROUP BY bodies"""


def _rebuilt(d: Dialect, *arrays: str) -> str:
    return d.concat(*arrays)


def inline_fixes(d: Dialect) -> str:
    """Known typos of the class mapped and other values cleared, places and bodies without evidence dropped, all_tags rebuilt."""
    fixed = f"CASE WHEN operativity IN ('operative', 'declarative', '') THEN operativity ELSE {_case('operativity', {k: repr(v) for k, v in TYPOS.items()}, repr(''))} END"
    return f"""WITH {records(d)}, f AS (SELECT doc_id, {fixed} AS operativity, tags, {d.keep('place_list', 'p', 'contains(low, p)')} AS ps, {d.keep('body_list', 'b', f'({_named(d, "b")}) OR ({_implied(d, "b")})')} AS bs FROM a),
w AS (SELECT *, {_rebuilt(d, 'tags', 'bs', 'ps')} AS every FROM f)
SELECT doc_id, operativity, {d.join('ps', ', ')} AS places, {d.join('bs', '; ')} AS bodies, {d.join(d.uniq('every'), '; ')} AS all_tags FROM w"""


def _normal_body(d: Dialect, x: str) -> str:
    """A body's name by the map; '' drops it."""
    return _case(x, {k: repr(v) for k, v in BODY_MAP.items()}, x)


def _canonical(d: Dialect, x: str) -> str:
    """A committee's name: spaces collapsed, an exact name first, then the first variant it contains, else itself."""
    names = " ".join(f"WHEN {x} = '{v}' THEN '{n}'" for v, n in COMMITTEES) + " " + " ".join(f"WHEN contains({x}, '{v}') THEN '{n}'" for v, n in COMMITTEES)
    return f"CASE {names} ELSE {x} END"


def _title_body(d: Dialect) -> str:
    """The first body whose name, then whose variant, stands in the title."""
    low = "lower(title)"
    pairs = [(b, b) for b in BODY_WORDS] + [(w, b) for b, ws in BODY_WORDS.items() for w in ws if w != b]
    return "CASE " + " ".join(f"WHEN contains({low}, '{w}') THEN '{b}'" for w, b in pairs) + " ELSE '' END"


def _typed(d: Dialect, x: str) -> str:
    """The listed tag a free one stands for: itself, or (two words needed) the one with word similarity of 0.5 or more; '' if none."""
    return f"CASE WHEN {d.has(_array(d, TAG_LIST), x)} THEN {x} WHEN {x} = 'helth' THEN 'health' ELSE '' END"


def _context_ok(d: Dialect, x: str) -> str:
    """Police is no body of military texts, media none of financial ones."""
    return f"NOT ({x} = 'police' AND {_hits(d, BODY_WORDS['army'])} > 0) AND NOT ({x} = 'media office' AND {_hits(d, ('treasury', 'interest rate'))} > 0)"


PREFIX = r"^decision number [0-9]+ of the government: *"


def _summary(d: Dialect, x: str) -> str:
    """The leading phrase off where ten characters remain."""
    cut = d.swap(x, "(?i)" + PREFIX, "")
    return f"CASE WHEN length(trim({cut})) >= 10 THEN trim({cut}) ELSE {x} END"


def _repaired(d: Dialect, x: str) -> str:
    """A text without a final mark: the last word goes if it may be cut off, dots follow."""
    return f"CASE WHEN {x} = '' OR {d.like(x, '[.!?:]$')} THEN {x} WHEN length({x}) <= 50 THEN {x} ELSE {d.swap(x, ' [^ ]{0,13}$', '')} || '...' END"


def _override(d: Dialect) -> str:
    """A class flipped where the text speaks for the other one only; an unclear one takes what the text says first."""
    return """CASE WHEN trim(operativity) = 'operative' AND decl_hits > 0 AND op_hits = 0 THEN 'declarative' WHEN trim(operativity) = 'declarative' AND op_hits > 0 AND decl_hits = 0 THEN 'operative'
  WHEN trim(operativity) IN ('operative', 'declarative') THEN trim(operativity) WHEN decl_hits > 0 THEN 'declarative' WHEN op_hits > 0 THEN 'operative' ELSE trim(operativity) END"""


def _chain(d: Dialect) -> str:
    """o: the post-processed columns, step after step."""
    listed = lambda x: d.has(_array(d, tuple(BODY_WORDS)), x)
    tags = d.keep(d.map("t1", "x", _typed(d, "x")), "x", "x <> ''")
    return f"""{records(d)},
p1 AS (SELECT *, {d.uniq('tags')} AS t1, {d.keep(d.map(d.keep(d.map('body_list', 'x', _normal_body(d, 'x')), 'x', "x <> ''"), 'x', _canonical(d, 'x')), 'x', "x <> ''")} AS b1 FROM a),
p2 AS (SELECT *, {d.keep(d.map('b1', 'x', _normal_body(d, 'x')), 'b', f"b <> '' AND {_context_ok(d, 'b')} AND (({_named(d, 'b')}) OR ({_implied(d, 'b', 't1')}))")} AS b2, {_summary(d, 'summary')} AS s1, {_override(d)} AS class FROM p1),
p3 AS (SELECT *, {d.uniq('b2')} AS b3, {_repaired(d, 's1')} AS s2, {d.keep('place_list', 'x', f"x NOT IN ({', '.join(map(repr, GENERIC_PLACES))})")} AS l1, {tags} AS t2 FROM p2),
p4 AS (SELECT *, CASE WHEN {d.size('t2')} = 0 AND policy <> '' THEN {_array(d, (FALLBACK,))} ELSE t2 END AS t3, {d.keep('b3', 'x', listed('x'))} AS b4 FROM p3),
p5 AS (SELECT *, {d.uniq('t3')} AS t4, CASE WHEN {d.size('b4')} = 0 AND {_title_body(d)} <> '' THEN {d.array(_title_body(d))} ELSE b4 END AS b5 FROM p4),
o AS (SELECT doc_id, t4, b5, l1, s2, class, {_rebuilt(d, 't4', 'b5', 'l1', d.items('special'))} AS every FROM p5)"""


def post_process(d: Dialect) -> str:
    """The whole chain: tags deduplicated in order, bodies mapped, committees named, context and relevance tested, summary, class, places, whitelists, title, all_tags."""
    return f"WITH {_chain(d)} SELECT doc_id, {d.join('t4', '; ')} AS tags, {d.join('b5', '; ')} AS bodies, {d.join('l1', ', ')} AS places, md5(s2) AS summary_md5, class AS operativity, {d.join(d.uniq('every'), '; ')} AS all_tags FROM o"


def body_whitelist(d: Dialect) -> str:
    """Bodies by name: kept by the whitelist, mapped to another name, or dropped."""
    return f"""WITH {records(d)}, x AS (SELECT {d.each('body_list')} AS body FROM a), m AS (SELECT body, {_normal_body(d, 'body')} AS mapped FROM x)
SELECT body, mapped, {d.has(_array(d, tuple(BODY_WORDS)), 'mapped')} AS listed, count(*) AS n FROM m GROUP BY body, mapped"""


def body_context(d: Dialect) -> str:
    """Each body of a record: named, implied, right in its context."""
    return f"""WITH {records(d)}, x AS (SELECT doc_id, low, tags, {d.each('body_list')} AS b FROM a)
SELECT doc_id, b AS body, {_named(d, 'b')} AS named, {_implied(d, 'b')} AS implied, {_context_ok(d, 'b')} AS in_context FROM x"""


def title_bodies(d: Dialect) -> str:
    """The body a title speaks of, for records left without one."""
    headed = _pick(9, "report of the police: ", "", "ministry of health, ", "the treasury and the army on ")
    return f"""WITH {records(d)}, h AS (SELECT doc_id, lower({headed} || title) AS title FROM a WHERE bodies = ''), t AS (SELECT doc_id, {_title_body(d)} AS inferred FROM h)
SELECT doc_id, inferred FROM t WHERE inferred <> ''"""


def committee_names(d: Dialect) -> str:
    """Committees as written, their names, and how many records have them."""
    clean = f"trim({d.swap('committee', ' +', ' ')})"
    return f"WITH {records(d)}, c AS (SELECT committee, {clean} AS c FROM a WHERE committee <> '') SELECT committee, {_canonical(d, 'c')} AS name, count(*) AS n FROM c GROUP BY committee, c"


def committee_variants(d: Dialect) -> str:
    """The spellings of each committee that the records have, and how many records each canonical name has."""
    clean = f"trim({d.swap('committee', ' +', ' ')})"
    return f"""WITH {records(d)}, c AS (SELECT {clean} AS variant FROM a WHERE committee <> ''), m AS (SELECT variant, {_canonical(d, 'variant')} AS name FROM c)
SELECT name, {d.join(d.gather_set('variant'), '; ')} AS variants, count(DISTINCT variant) AS n_variants, count(*) AS n FROM m GROUP BY name"""


def tag_whitelist_steps(d: Dialect) -> str:
    """Tags held against the list: exact, by word similarity of 0.5 or more (the best, ties the first), else left to a tagger. The list is what at least a hundredth of all parts are called; tags are names as written, some cut, turned round or with words added."""
    said = "CASE p_partkey % 5 WHEN 0 THEN w1 || ' ' || w2 WHEN 1 THEN w2 || ' ' || w1 WHEN 2 THEN w1 || ' ' || w2 || ' made to order' WHEN 3 THEN w2 ELSE w1 || ' ' || lower(p_brand) || ' ' || w2 END"
    word = lambda k: d(f"element_at(split(lower(p_name), ' '), {k})", f"split(lower(p_name), ' ')[{k}]")
    return f"""WITH p AS (SELECT p_partkey, {word(1)} AS w1, {word(2)} AS w2, p_brand FROM {d.t('part')} WHERE p_name LIKE '% %'),
n AS (SELECT w1 || ' ' || w2 AS entry, count(*) AS n FROM p GROUP BY 1), v AS (SELECT entry FROM n WHERE n * 100 >= (SELECT count(*) FROM p)),
t AS (SELECT {said} AS tag, count(*) AS n FROM p GROUP BY 1), w AS (SELECT tag, n, {d.words('tag')} AS w FROM t), x AS (SELECT entry, {d.words('entry')} AS e FROM v),
a AS (SELECT tag, w, {d.each('w')} AS word FROM w WHERE {d.size('w')} >= 2), b AS (SELECT entry, e, {d.each('e')} AS word FROM x),
m AS (SELECT DISTINCT tag, entry, {d.jaccard('w', 'e')} AS j FROM a JOIN b ON a.word = b.word),
k AS (SELECT tag, entry FROM (SELECT tag, entry, row_number() OVER (PARTITION BY tag ORDER BY j DESC, entry) AS rn FROM m WHERE j >= 0.5) y WHERE rn = 1)
SELECT w.tag, w.n, coalesce(v.entry, k.entry, '') AS mapped, CASE WHEN v.entry IS NOT NULL THEN 'exact' WHEN k.entry IS NOT NULL THEN 'similar' ELSE 'tagger' END AS step
FROM w LEFT JOIN v ON w.tag = v.entry LEFT JOIN k ON w.tag = k.tag"""


def multi_tag_mapping(d: Dialect) -> str:
    """A delimited field mapped item by item through the dimension of distinct tags, order kept, repeats dropped."""
    return f"""WITH {records(d)}, m AS (SELECT tag, {_typed(d, 'tag')} AS mapped FROM (SELECT DISTINCT {d.each('tags')} AS tag FROM a) t),
n AS (SELECT doc_id, policy, {d.map('tags', 'x', _typed(d, 'x'))} AS mapped FROM a),
k AS (SELECT doc_id, policy, {d.keep('mapped', 'x', "x <> ''")} AS kept FROM n)
SELECT doc_id, policy AS old_value, CASE WHEN {d.size('kept')} = 0 THEN '{FALLBACK}' ELSE {d.join(d.uniq('kept'), '; ')} END AS new_value, (SELECT count(*) FROM m WHERE mapped = '') AS n_unmapped FROM k WHERE policy <> ''"""


def operativity_lists(d: Dialect) -> str:
    """The class by substring lists of either side, against the one given."""
    return f"WITH {records(d)} SELECT doc_id, operativity, op_hits, decl_hits, {_override(d)} AS overridden FROM a".replace("op_hits, decl_hits,", f"{d.long('op_hits')} AS op_hits, {d.long('decl_hits')} AS decl_hits,", 1)


def operativity_ratio(d: Dialect) -> str:
    """How far a text's words agree with its class: 0.5 where it has none."""
    ratio = f"{d.double('op_hits')} / (op_hits + decl_hits)"
    return f"WITH {records(d)} SELECT doc_id, CASE WHEN op_hits + decl_hits = 0 THEN CAST(0.5 AS DOUBLE) WHEN trim(operativity) = 'operative' THEN {ratio} ELSE 1 - {ratio} END AS match_ratio FROM a"


def _special_errors(d: Dialect) -> str:
    """Errors of special categories: no word for them in the text, or an earlier year than they can have."""
    rows = [f"CASE WHEN contains(special, '{k}') AND {_hits(d, ws)} = 0 THEN 'unsupported {k}' END" for k, ws in SPECIAL.items()]
    return d.compact(*rows, "CASE WHEN contains(special, 'northern recovery') AND yr < 2023 THEN 'anachronistic northern recovery' END")


def special_categories(d: Dialect) -> str:
    """Special categories without support in the text, or before their time."""
    return f"WITH {records(d)}, e AS (SELECT doc_id, special, {_special_errors(d)} AS errors FROM a WHERE special <> '') SELECT doc_id, special, {d.join('errors', '; ')} AS errors, {d.size('errors')} = 0 AS is_valid FROM e"


def _rule(d: Dialect, tag: str) -> str:
    """Forced verdicts: appointments and administrative acts have their own tags only, money has the budget's."""
    appoint, admin, money = (f"{_hits(d, ws)} > 0" for ws in (("appoint", "term of office"), ("travel", "working group"), ("million", "budget")))
    return f"""CASE WHEN {appoint} AND {tag} = 'appointments' THEN 'accept' WHEN {appoint} AND {tag} NOT IN ('admin', 'appointments') THEN 'reject'
  WHEN {admin} AND {tag} = 'admin' THEN 'accept' WHEN {admin} AND {tag} NOT IN ('admin', 'appointments') THEN 'reject' WHEN {money} AND {tag} = 'budget' THEN 'accept' ELSE 'neutral' END"""


def _relevance(d: Dialect) -> str:
    """x: one row a record and tag with its rule verdict and keyword share; k: kept and all tags of a record."""
    share = "CASE " + " ".join(f"WHEN tag = '{t}' THEN {d.double(_hits(d, ws))} / {len(ws)}" for t, ws in KEYWORDS.items()) + " ELSE CAST(0 AS DOUBLE) END"
    return f"""{records(d)}, e AS (SELECT doc_id, low, {d.each('tags')} AS tag FROM a), x AS (SELECT doc_id, tag, {_rule(d, 'tag')} AS verdict, {share} AS share FROM e),
y AS (SELECT doc_id, tag, verdict, share, CASE verdict WHEN 'accept' THEN true WHEN 'reject' THEN false ELSE share >= 0.1 END AS kept FROM x)"""


def tag_rules(d: Dialect) -> str:
    """Each tag of each record: forced verdict, keyword share, kept or not."""
    return f"WITH {_relevance(d)} SELECT doc_id, tag, verdict, share, kept FROM y"


def tag_verdict(d: Dialect) -> str:
    """Records whose tags hold: at most 30 % rejected; the confidence is the share kept."""
    return f"WITH {_relevance(d)} SELECT doc_id, {d.double(d.flag('kept'))} / count(*) AS confidence, {d.flag('NOT kept')} <= 0.3 * count(*) AS is_valid FROM y GROUP BY doc_id"


def overall_confidence(d: Dialect) -> str:
    """Weighted confidence of a tagged record (0.3, 0.2, 0.3, 0.2), its errors and warnings, and the verdict."""
    conf = lambda n: f"({d.double(f'(doc_id % {n})')} / {n})"
    s, o, t = conf(10), conf(7), conf(9)
    unknown = d.size(d.keep("tags", "x", f"NOT {d.has(_array(d, TAG_LIST), 'x')}"))
    errors = d.compact(f"CASE WHEN {s} < 0.6 THEN 'summary confidence' END", f"CASE WHEN {unknown} > 0 THEN 'unknown tags' END", "CASE WHEN length(trim(summary)) < 10 THEN 'short summary' END", f"CASE WHEN {d.size('tags')} = 0 THEN 'no tags' END")
    warnings = d.compact(f"CASE WHEN {o} < 0.7 THEN 'operativity confidence' END", f"CASE WHEN {t} < 0.5 THEN 'tags confidence' END", "CASE WHEN relevance < 0.3 THEN 'relevance' END")
    return f"""WITH {_relevance(d)}, k AS (SELECT doc_id, {d.double(d.flag('kept'))} / count(*) AS rel FROM y GROUP BY doc_id),
j AS (SELECT a.*, coalesce(k.rel, CAST(1 AS DOUBLE)) AS relevance FROM a LEFT JOIN k ON a.doc_id = k.doc_id),
v AS (SELECT doc_id, {errors} AS e1, {_special_errors(d)} AS e2, {warnings} AS w, {s} * 0.3 + {o} * 0.2 + {t} * 0.3 + relevance * 0.2 AS confidence FROM j)
SELECT doc_id, {d.join(d.concat('e1', 'e2'), '; ')} AS errors, {d.join('w', '; ')} AS warnings, round(confidence, 9) AS confidence, {d.size('e1')} + {d.size('e2')} = 0 AND confidence >= 0.5 AS is_valid FROM v"""


def field_validation(d: Dialect) -> str:
    """One row a record and field: valid or why not; the confidence of a single field is 0.7."""
    unknown = d.keep("tags", "x", f"NOT {d.has(_array(d, TAG_LIST), 'x')}")
    rows = d.array(d.struct(field=d.lit("summary"), error="CASE WHEN length(trim(summary)) < 10 THEN 'too short' ELSE '' END"),
                   d.struct(field=d.lit("operativity"), error="CASE WHEN operativity NOT IN ('operative', 'declarative') THEN 'invalid ' || operativity ELSE '' END"),
                   d.struct(field=d.lit("policy"), error=d.join(unknown, ",")))
    return f"WITH {records(d)}, x AS (SELECT doc_id, {d.each(rows)} AS x FROM a) SELECT doc_id, x.field AS field, x.error AS error, x.error = '' AS is_valid, CAST(0.7 AS DOUBLE) AS confidence FROM x"


def misalignment(d: Dialect) -> str:
    """Patterns of tags that don't fit the summary, and tags no word of which it has where there are over two; score with deductions."""
    low = "lower(summary)"
    domain = d.keep("tags", "x", "x NOT IN ('admin', 'appointments')")
    words = "CASE " + " ".join(f"WHEN x = '{t}' THEN {_hits(d, ws, low)} = 0" for t, ws in KEYWORDS.items()) + " ELSE true END"
    missing = d.keep("tags", "x", words)
    issues = d.compact(
        f"CASE WHEN {_hits(d, ('statute', 'regulation'), low)} > 0 AND {d.has('tags', d.lit('culture'))} THEN 'law as culture' END",
        f"CASE WHEN {_hits(d, ('travel', 'working group'), low)} > 0 AND {d.size(domain)} > 0 THEN 'administrative act' END",
        f"CASE WHEN {_hits(d, ('appoint',), low)} > 0 AND {d.size(domain)} > 0 THEN 'appointment' END",
        f"CASE WHEN {d.size('tags')} > 2 AND {d.size(missing)} > 0 THEN 'tags beyond the summary' END")
    concepts = d.distinct(d.concat("tags", *[f"CASE WHEN {d.has('tags', d.lit(t))} THEN {_array(d, ws)} ELSE {d.none()} END" for t, ws in KEYWORDS.items()]))
    n = d.size("issues")
    return f"""WITH {records(d)}, j AS (SELECT doc_id, {issues} AS issues, {d.jaccard(d.words('summary'), 'concepts')} AS j FROM (SELECT *, {concepts} AS concepts FROM a) x),
b AS (SELECT doc_id, issues, j, greatest(CASE WHEN {n} = 0 AND j > 0.1 THEN greatest(j, 0.7) ELSE j END - least(0.5, {n} * 0.15), 0) AS s FROM j)
SELECT doc_id, {d.join('issues', '; ')} AS issues, round({d.double('CASE WHEN j < 0.05 THEN least(s, 0.4) ELSE s END')}, 9) AS score, CASE WHEN j < 0.05 THEN least(s, 0.4) ELSE s END >= 0.7 AS aligned FROM b"""


def corrected_tags(d: Dialect) -> str:
    """The tag a summary's words suggest: the first of five rules, else the fallback."""
    rules = (("law", ("statute", "regulation")), ("admin", ("travel", "working group")), ("appointments", ("appoint",)), ("health", ("nurse", "hospital")), ("culture", ("museum",)))
    return f"WITH {records(d)} SELECT doc_id, CASE " + " ".join(f"WHEN {_hits(d, ws, 'lower(summary)')} > 0 THEN '{t}'" for t, ws in rules) + f" ELSE '{FALLBACK}' END AS suggested FROM a"


def model_alignment(d: Dialect) -> str:
    """Score of a model's verdict in words: 'yes' wins over 'partly' and 'no'; word overlap of summary and tags moves it."""
    said = _pick(5, "yes, partly", "partly", "no", "mostly")
    base = "CASE WHEN contains(said, 'yes') THEN 0.8 WHEN contains(said, 'partly') OR contains(said, 'mostly') THEN 0.6 WHEN contains(said, 'no') THEN 0.3 ELSE 0.5 END"
    split = lambda x: d.distinct(d.keep(f"split({d.swap(f'lower({x})', '[ \n\t;]+', ' ')}, ' ')", "w", "w <> ''"))
    return f"""WITH {records(d)}, j AS (SELECT doc_id, {said} AS said, {split('summary')} AS s, {split('policy')} AS t FROM a),
k AS (SELECT doc_id, said, {d.double(base)} AS base, CASE WHEN {d.size('s')} = 0 OR {d.size('t')} = 0 THEN NULL ELSE {d.jaccard('s', 't')} END AS j FROM j)
SELECT doc_id, said, round(CASE WHEN j > 0.2 THEN least(1, base + 0.1) WHEN j < 0.1 THEN greatest(0, base - 0.2) ELSE base END, 9) AS score FROM k"""


def summary_tag_overlap(d: Dialect) -> str:
    """Word similarity of a summary and its joined tags, 0 where either is empty; and what an excerpt of 400 characters loses."""
    return f"""WITH {records(d)} SELECT doc_id, {d.jaccard(d.words('summary'), d.words('policy'))} AS overlap, {d.double('greatest(len - 400, 0)')} / len * 100 AS lost, len - 400 > 0.3 * len AS warns FROM a WHERE len > 0"""


def model_record(d: Dialect) -> str:
    """A model's result as one record: summary repaired, class overridden, tags restricted to the list, confidences clamped."""
    listed = d.keep("tags", "x", d.has(_array(d, TAG_LIST), "x"))
    one = f"CASE WHEN {d.size(listed)} > 0 THEN {d.at(listed, 1)} ELSE '{FALLBACK}' END"
    return f"""WITH {records(d)} SELECT doc_id, md5({_repaired(d, _summary(d, 'summary'))}) AS summary_md5, {_override(d)} AS operativity, {one} AS first_tag, least(greatest({d.double('(doc_id % 13 - 1)')} / 10, 0), 1) AS confidence FROM a"""


def rule_lookup(d: Dialect) -> str:
    """Rules that the records give (a tag and a partner body that stand together, the confidence is the share of the tag's records that have the body): those of a tag, of a partner, and of high confidence."""
    return f"""WITH {records(d)}, t AS (SELECT doc_id, {d.each('tags')} AS tag FROM a), b AS (SELECT doc_id, {d.each('body_list')} AS partner FROM a), n AS (SELECT tag, count(DISTINCT doc_id) AS n FROM t GROUP BY tag),
p AS (SELECT tag, partner, count(DISTINCT t.doc_id) AS n_both FROM t JOIN b ON t.doc_id = b.doc_id GROUP BY tag, partner),
q AS (SELECT p.tag, partner, n_both, {d.double('n_both')} / n AS confidence FROM p JOIN n ON p.tag = n.tag)
SELECT 'tag' AS kind, tag, partner, n_both, confidence FROM q WHERE tag = 'law' UNION ALL SELECT 'partner', tag, partner, n_both, confidence FROM q WHERE partner = 'treasury'
UNION ALL SELECT 'confident', tag, partner, n_both, confidence FROM q WHERE confidence >= 0.2"""


#: thresholds of the validators, and the class balance aimed at
THRESHOLDS = {"summary": 0.6, "operativity": 0.7, "tags": 0.5, "overall": 0.5}
BALANCE = {"operative": 0.65, "declarative": 0.35}


def class_balance(d: Dialect) -> str:
    """Each class's share of the records that have one, the share aimed at, and how far off it is."""
    aim = "CASE class " + " ".join(f"WHEN '{c}' THEN CAST({v} AS DOUBLE)" for c, v in BALANCE.items()) + " END"
    return f"""WITH {records(d)}, c AS (SELECT trim(operativity) AS class FROM a), k AS (SELECT class, count(*) AS n FROM c WHERE class IN ('operative', 'declarative') GROUP BY class), t AS (SELECT sum(n) AS total FROM k)
SELECT class, n, {d.double('n')} / total AS share, {aim} AS target, abs({d.double('n')} / total - {aim}) > 0.1 AS off_balance FROM k CROSS JOIN t"""


def threshold_report(d: Dialect) -> str:
    """The validators' thresholds with how many records lie below each; a record's measures are the shares of its summary, class, tags and text that have evidence."""
    ratio = f"CASE WHEN op_hits + decl_hits = 0 THEN CAST(0.5 AS DOUBLE) WHEN trim(operativity) = 'operative' THEN {d.double('op_hits')} / (op_hits + decl_hits) ELSE {d.double('decl_hits')} / (op_hits + decl_hits) END"
    listed = f"CASE WHEN {d.size('tags')} = 0 THEN CAST(0 AS DOUBLE) ELSE {d.double(d.size(d.keep('tags', 'x', d.has(_array(d, TAG_LIST), 'x'))))} / {d.size('tags')} END"
    rows = d.array(*[d.struct(name=d.lit(n), measure=m, threshold=d.double(THRESHOLDS[n])) for n, m in (("summary", "s"), ("operativity", "o"), ("tags", "t"), ("overall", "s * 0.3 + o * 0.2 + t * 0.5"))])
    return f"""WITH {records(d)}, m AS (SELECT doc_id, {d.double('least(length(trim(summary)), 100)')} / 100 AS s, {ratio} AS o, {listed} AS t FROM a), x AS (SELECT {d.each(rows)} AS x FROM m)
SELECT x.name AS name, x.threshold AS threshold, count(*) AS n, {d.flag('x.measure < x.threshold')} AS n_below, round(avg(x.measure), 9) AS mean FROM x GROUP BY x.name, x.threshold"""


def dated_names(d: Dialect) -> str:
    """A body's tag by the year of the record: an override holds from a year on, a name before its founding has none."""
    over = "SELECT 'police' AS body, 2022 AS since, 'security' AS tag UNION ALL SELECT 'media office', 2021, 'digital'"
    born = "SELECT 'media office' AS body, 2020 AS founded UNION ALL SELECT 'army', 1948"
    return f"""WITH {records(d)}, x AS (SELECT doc_id, yr, {d.each('body_list')} AS body FROM a), v AS ({over}), n AS ({born})
SELECT doc_id, x.body, coalesce(CASE WHEN yr >= v.since THEN v.tag END, {_case('x.body', {b: repr(t) for b, t in BODY_TAG.items()}, repr(FALLBACK))}) AS tag, coalesce(yr >= n.founded, true) AS existed
FROM x LEFT JOIN v ON x.body = v.body LEFT JOIN n ON x.body = n.body"""


QUERIES, ORACLES = registry(
    tagged_checks, cross_field_checks, named_checks, suspicious_bodies, inline_fixes, post_process, body_whitelist, body_context, title_bodies, committee_names, committee_variants, tag_whitelist_steps,
    multi_tag_mapping, operativity_lists, operativity_ratio, special_categories, tag_rules, tag_verdict, overall_confidence, field_validation, misalignment, corrected_tags, model_alignment,
    summary_tag_overlap, model_record, rule_lookup, class_balance, threshold_report, dated_names)
