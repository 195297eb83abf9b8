"""Dictionary queries over tagged records: words with their forms, bodies and titles, places, committees, tag profiles.

The engine scans a text once with an automaton of all forms; the oracles ask for
each form of each word by plain containment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.affixes import TIERS, Affixes
from docloom.operators.mentions import forms, mentioned, mentions
from docloom.plans import tagged
from docloom.plans.dialect import DUCK, Dialect, runner

#: this library's own: seven prefix letters and seven suffixes
AFFIXES = Affixes("aubdelm", ("ations", "ation", "ings", "ing", "ers", "ed", "s"))

#: this library's own: body -> abbreviations; a body without any goes by its name
BODIES: dict[str, tuple[str, ...]] = {
    "ministry of health": ("health ministry", "department of health"), "ministry of finance": ("finance ministry",), "ministry of education": ("education ministry", "school board"), "ministry of transport": (),
    "ministry of justice": ("justice department",), "ministry of energy": (), "ministry of culture": ("arts ministry",), "ministry of labour": (), "ministry of housing": ("housing ministry",), "ministry of science": (),
    "ministry of defence": ("army", "soldier"), "office for digital affairs": ("digital office",), "office for statistics": (), "office for the environment": (), "police": ("police", "constable"), "treasury": ("treasury", "budget office"),
    "central bank": (), "prison service": ("prison service", "warden"), "fire service": ("fire brigade", "fire service")}
#: body -> the tag that implies it
BODY_TAGS: dict[str, str] = {"ministry of health": "health", "police": "law", "ministry of justice": "law", "treasury": "budget", "ministry of finance": "budget", "ministry of culture": "culture", "ministry of defence": "law"}


class Profile(tuple):
    """Keywords, priority keywords and negative indicators of a tag."""

    keywords = property(lambda s: s[0])
    priority = property(lambda s: s[1])
    negative = property(lambda s: s[2])


#: this library's own: tag -> what speaks for it, strongly for it, and against it
PROFILES: dict[str, Profile] = {
    "health": Profile((("hospital", "nurse", "clinic", "vaccine", "patient", "doctor"), ("hospital", "minister of health"), ("museum", "soldier"))),
    "law": Profile((("statute", "regulation", "court", "judge", "police", "prison", "appeal", "sentence", "verdict", "clause", "amendment"), ("statute", "regulation"), ("theatre",))),
    "budget": Profile((("million", "budget", "tax", "grant", "spending"), ("budget", "allocat"), ())),
    "culture": Profile((("museum", "theatre", "library", "concert"), ("museum",), ("soldier", "tax"))),
    "appointments": Profile((("appoint", "term of office", "candidate"), ("appoint",), ())),
    "admin": Profile((("working group", "travel", "delegation"), ("working group",), ())),
}
#: tags that the relevance check leaves out
GENERIC = (tagged.FALLBACK, "admin", "appointments")


def body_patterns(body: str) -> list[str]:
    """What names a body: its abbreviations or name, and the titles of whoever heads a ministry or an office."""
    out = list(BODIES.get(body) or (body,))
    if body.startswith("ministry of "):
        out += [f"minister of {body[12:]}", f"{body[12:]} minister"]
    if body.startswith("office for "):
        out += [f"head of the office for {body[11:]}", f"director for {body[11:]}"]
    return out


def _said(d: Dialect) -> str:
    """r: records whose text has one more sentence, with words under all affixes."""
    said = tagged._pick(
        17, " the unhospital and hospitals of the ministers of healths", " constables were alibrary", " a policed harbour and its wardens", " the head of the office for statistics spoke", " the culture minister met the director for digital affairs",
        " regulation of budgets and taxed grants", " soldiers near the museum", " the fire brigade and the school boards", " concerts in umuseum", " candidates were appointed", " delegations travelled", " energy ministers allocated a million",
        " courts and judged appeals", " bdoctors and patients at the clinic")
    return f"{tagged.records(d)}, b AS (SELECT doc_id, record_key, len, low || {said} AS low, tags, bodies, body_list, committee, places, policy FROM a)"


def _records(spark: SparkSession, sf_dir: str, columns: str) -> DataFrame:
    def q(d: Dialect) -> str:
        return f"WITH {_said(d)} SELECT {columns} FROM b"

    return runner(q)(spark, sf_dir)


def _table(rows, names: str) -> str:
    """DuckDB: a table of literals."""
    return "(VALUES " + ", ".join("(" + ", ".join(DUCK.lit(x) if isinstance(x, str) else str(x) for x in r) + ")" for r in rows) + f") v({names})"


def _found_sql(words, affixes) -> str:
    """DuckDB: m, the best tier of each rule for each record, by plain containment."""
    return f"f AS (SELECT * FROM {_table(forms(words, affixes), 'form, rule, tier')}), m AS (SELECT doc_id, rule, min(tier) AS tier FROM b JOIN f ON contains(low, form) GROUP BY doc_id, rule)"


KEYWORD_LIST = sorted({w for p in PROFILES.values() for part in p for w in part} | {w for t in PROFILES for w in t.split()})
KEYWORDS = list(enumerate(KEYWORD_LIST))
BODY_LIST = list(BODIES)
BODY_WORDS = [(i, p) for i, b in enumerate(BODY_LIST) for p in body_patterns(b)]
PLACES = ("north", "capital", "south", "harbour", "border")


def word_forms(d: Dialect) -> str:
    """The words of part names with what is left without prefixes (two rounds), without a suffix, and without both."""
    one = lambda x: f"CASE WHEN length({x}) > {AFFIXES.longer_than} AND substring({x}, 1, 1) IN ({', '.join(map(repr, AFFIXES.prefixes))}) THEN substring({x}, 2) ELSE {x} END"
    longest = sorted(AFFIXES.suffixes, key=lambda s: -len(s))
    cut = lambda x: "CASE " + " ".join(f"WHEN {x} LIKE '%{s}' AND length({x}) >= {AFFIXES.least + len(s)} THEN substring({x}, 1, length({x}) - {len(s)})" for s in longest) + f" ELSE {x} END"
    return f"""WITH w AS (SELECT DISTINCT {d.each(d.words("p_name || ' ' || p_type || ' ' || 'ablations dumbed bless bed unmatched'"))} AS w FROM {d.t('part')}),
x AS (SELECT w, {one('w')} AS p1 FROM w), y AS (SELECT w, {one('p1')} AS bare FROM x)
SELECT w, bare, {cut('w')} AS without_suffix, {cut('bare')} AS stem FROM y"""


def word_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every keyword that a record mentions in any form, with the best tier."""
    m = mentions(_records(spark, sf_dir, "doc_id, low"), "low", ["doc_id"], KEYWORDS, AFFIXES)
    return m.select("doc_id", F.element_at(F.array(*map(F.lit, KEYWORD_LIST)), F.col("rule") + 1).alias("word"), F.element_at(F.array(*[F.lit(TIERS[t]) for t in sorted(TIERS)]), F.col("tier")).alias("form"))


def body_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every body that a record mentions: by an abbreviation, by its name, or by the title of its head."""
    m = mentions(_records(spark, sf_dir, "doc_id, low"), "low", ["doc_id"], BODY_WORDS, AFFIXES)
    return m.select("doc_id", F.element_at(F.array(*map(F.lit, BODY_LIST)), F.col("rule") + 1).alias("body"), F.col("tier").cast("long").alias("tier"))


def _spread() -> str:
    """The bodies a record is tagged with, from its id: one to three of all."""
    n = len(BODY_LIST)
    return f"transform(sequence(0, cast(doc_id % 3 as int)), i -> element_at(array({', '.join(map(repr, BODY_LIST))}), cast((doc_id * 7 + i * 5) % {n} as int) + 1))"


def body_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each body a record is tagged with: mentioned, implied by one of its tags or by two keywords of that tag; and the record's severity (high where none is evident, low where some are not)."""
    r = _records(spark, sf_dir, "doc_id, low, tags").withColumn("body", F.expr(_spread()))
    words = [*BODY_WORDS, *((len(BODY_LIST) + k, w) for k, w in KEYWORDS)]
    r = r.withColumn("m", F.transform(mentioned(spark, F.col("low"), words, AFFIXES), lambda x: x["rule"])).select("doc_id", "tags", "m", F.explode("body").alias("body"))
    place = F.array_position(F.array(*map(F.lit, BODY_LIST)), F.col("body")).cast("int") - 1
    tag = F.create_map(*[F.lit(x) for b, t in BODY_TAGS.items() for x in (b, t)])[F.col("body")]
    of_tag = F.create_map(*[x for t, p in PROFILES.items() for x in (F.lit(t), F.array(*[F.lit(len(BODY_LIST) + KEYWORD_LIST.index(w)) for w in p.keywords]))])[tag]
    e = r.select("doc_id", "body", F.array_contains("m", place).alias("named"),
                 F.coalesce(F.array_contains("tags", tag), F.lit(False)).alias("tagged"), (F.coalesce(F.size(F.array_intersect("m", of_tag)), F.lit(0)) >= 2).alias("implied"))
    evident = F.col("named") | F.col("tagged") | F.col("implied")
    s = e.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(evident).alias("n_evident"), F.sort_array(F.collect_list(F.when(~evident, F.col("body")))).alias("missing"))
    return s.select("doc_id", "n", "n_evident", F.array_join("missing", "; ").alias("missing"), F.when(F.col("n_evident") == 0, "high").when(F.col("n_evident") < F.col("n"), "low").otherwise("").alias("severity"))


def dictionary_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first committee of the list that a record's committee contains, and all places that its text has."""
    r = _records(spark, sf_dir, "doc_id, low, committee")
    committees = list(enumerate(v for v, _ in tagged.COMMITTEES))
    d = r.select("doc_id", F.array_min(F.transform(mentioned(spark, F.regexp_replace(F.trim("committee"), " +", " "), committees), lambda x: x["rule"])).alias("c"),
                 F.transform(mentioned(spark, F.col("low"), list(enumerate(PLACES))), lambda x: x["rule"]).alias("p"))
    names, places = (F.array(*map(F.lit, x)) for x in ([n for _, n in tagged.COMMITTEES], PLACES))
    return d.select("doc_id", F.coalesce(F.try_element_at(names, F.col("c") + 1), F.lit("")).alias("committee"), F.array_join(F.transform("p", lambda i: F.element_at(places, i + 1)), "; ").alias("places"))


def policy_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags with a profile, but generic ones, of records with 100 characters or more: whether a word of the tag stands in the text, the share of its keywords that do; high where neither does, low_score under 0.15."""
    r = _records(spark, sf_dir, "doc_id, low, tags, len").where("len >= 100").withColumn("m", F.transform(mentioned(spark, F.col("low"), KEYWORDS, AFFIXES), lambda x: x["rule"]))
    table = spark.createDataFrame(
        [(t, [KEYWORD_LIST.index(w) for w in p.keywords], [KEYWORD_LIST.index(w) for w in t.split() if len(w) > 2]) for t, p in PROFILES.items() if t not in GENERIC], "tag string, words array<int>, own array<int>")
    e = r.select("doc_id", "m", F.explode(F.array_distinct("tags")).alias("tag")).join(F.broadcast(table), "tag")  # a row a profile of this module
    hits = F.size(F.array_intersect("m", "words"))
    d = e.select("doc_id", "tag", F.arrays_overlap("m", "own").alias("named"), (hits / F.size("words")).alias("score"))
    issue = F.when(F.col("named"), "").when(F.col("score") == 0, "high").when(F.col("score") < 0.15, "low_score").otherwise("")
    return d.select("doc_id", "tag", "named", "score", issue.alias("issue"))


def profile_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each tag of each record against its profile: forced verdicts first; negative indicators reject what isn't strong (a tenth of the keywords or a fifth of the priority ones); a tag without a profile is kept.

    The profile is a weighted table of tokens, joined once with the tokens that records mention.
    """
    r = _records(spark, sf_dir, "doc_id, low, tags")
    ids = {w: k for k, w in KEYWORDS}
    tokens = spark.createDataFrame([(t, ids[w], kind, 1.0 / len(ws)) for t, p in PROFILES.items() for kind, ws in (("keyword", p.keywords), ("priority", p.priority), ("negative", p.negative)) for w in ws],
                                   "tag string, rule int, kind string, weight double")
    d = r.select("doc_id", F.explode(F.array_distinct("tags")).alias("tag"), F.transform(mentioned(spark, F.col("low"), KEYWORDS), lambda x: x["rule"]).alias("m"))
    share = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("weight"))), F.lit(0.0)).alias(k)
    every = d.select("doc_id", "tag", F.explode_outer("m").alias("rule")).join(F.broadcast(tokens), ["tag", "rule"], "left").groupBy("doc_id", "tag").agg(share("keyword"), share("priority"), share("negative"))
    said = lambda *ws: F.arrays_overlap("m", F.array(*[F.lit(ids[w]) for w in ws]))
    forced = F.when(said("appoint", "term of office"), F.when(F.col("tag") == "appointments", "accept").when(F.col("tag") != "admin", "reject")).when(
        said("travel", "working group"), F.when(F.col("tag") == "admin", "accept").when(F.col("tag") != "appointments", "reject")).when(said("million", "budget") & (F.col("tag") == "budget"), "accept")
    d = d.select("doc_id", "tag", F.coalesce(forced, F.lit("")).alias("forced")).join(every, ["doc_id", "tag"])
    strong = (F.round("priority", 9) >= 0.2) | (F.round("keyword", 9) >= 0.1)
    verdict = F.when(~F.col("tag").isin(*PROFILES), "no profile").when(F.col("forced") == "reject", "rule").when(F.col("forced") == "accept", "kept").when(
        (F.col("negative") > 0) & ~strong, "negative").when(strong, "kept").otherwise("insufficient")
    return d.select("doc_id", "tag", F.round("keyword", 9).alias("keyword_share"), F.round("priority", 9).alias("priority_share"), (F.col("negative") > 0).alias("has_negative"), verdict.alias("verdict"))


def _oracles() -> dict[str, str]:
    b = _said(DUCK)
    names = lambda xs, col: f"(SELECT * FROM {_table(list(enumerate(xs)), col)})"
    spread = f"unnest(list_transform(range(0, doc_id % 3 + 1), lambda i: [{', '.join(map(repr, BODY_LIST))}][((doc_id * 7 + i * 5) % {len(BODY_LIST)}) + 1])) AS body"
    implied = [(b_, w) for b_, t in BODY_TAGS.items() for w in PROFILES[t].keywords]
    words = [(t, w) for t, p in PROFILES.items() if t not in GENERIC for w in p.keywords]
    own = [(t, w) for t in PROFILES if t not in GENERIC for w in t.split() if len(w) > 2]
    tokens = [(t, w, kind, 1.0 / len(ws)) for t, p in PROFILES.items() for kind, ws in (("keyword", p.keywords), ("priority", p.priority), ("negative", p.negative)) for w in ws]
    any_of = lambda *ws: "(" + " OR ".join(f"contains(low, '{w}')" for w in ws) + ")"
    return {
        "word_mentions": f"WITH {b}, {_found_sql(KEYWORDS, AFFIXES)} SELECT doc_id, word, form FROM m JOIN {names(KEYWORD_LIST, 'k, word')} ON rule = k JOIN (SELECT * FROM {_table(list(TIERS.items()), 't, form')}) ON tier = t",
        "body_mentions": f"WITH {b}, {_found_sql(BODY_WORDS, AFFIXES)} SELECT doc_id, body, tier::BIGINT AS tier FROM m JOIN {names(BODY_LIST, 'k, body')} ON rule = k",
        "body_evidence": f"""WITH {b}, f AS (SELECT * FROM {_table([(f, BODY_LIST[i]) for f, i, _ in forms(BODY_WORDS, AFFIXES)], 'form, body')}), t AS (SELECT * FROM {_table(list(BODY_TAGS.items()), 'body, tag')}),
i AS (SELECT * FROM {_table([(b_, w, f) for b_, w in implied for _, f in AFFIXES.forms(w)], 'body, word, form')}), x AS (SELECT doc_id, low, tags, {spread} FROM b),
e AS (SELECT doc_id, body, coalesce(EXISTS (SELECT 1 FROM f WHERE f.body = x.body AND contains(low, form)) OR EXISTS (SELECT 1 FROM t WHERE t.body = x.body AND list_contains(tags, tag))
  OR (SELECT count(DISTINCT word) FROM i WHERE i.body = x.body AND contains(low, form)) >= 2, false) AS evident FROM x)
SELECT doc_id, count(*) AS n, count(*) FILTER (evident) AS n_evident, coalesce(string_agg(body, '; ' ORDER BY body) FILTER (NOT evident), '') AS missing,
  CASE WHEN count(*) FILTER (evident) = 0 THEN 'high' WHEN count(*) FILTER (NOT evident) > 0 THEN 'low' ELSE '' END AS severity FROM e GROUP BY doc_id""",
        "dictionary_links": f"""WITH {b}, c AS (SELECT * FROM {_table([(i, v, n) for i, (v, n) in enumerate(tagged.COMMITTEES)], 'pos, variant, name')}), p AS (SELECT * FROM {_table(list(enumerate(PLACES)), 'pos, place')})
SELECT doc_id, coalesce((SELECT first(name ORDER BY pos) FROM c WHERE contains(regexp_replace(trim(committee), ' +', ' ', 'g'), variant)), '') AS committee,
  coalesce((SELECT string_agg(place, '; ' ORDER BY pos) FROM p WHERE contains(low, place)), '') AS places FROM b""",
        "policy_relevance": f"""WITH {b}, w AS (SELECT * FROM {_table([(t, w, f) for t, w in words for _, f in AFFIXES.forms(w)], 'tag, word, form')}), o AS (SELECT * FROM {_table([(t, f) for t, w in own for _, f in AFFIXES.forms(w)], 'tag, form')}),
k AS (SELECT tag, count(DISTINCT word) AS n FROM w GROUP BY tag), e AS (SELECT DISTINCT doc_id, low, unnest(tags) AS tag FROM b WHERE len >= 100),
s AS (SELECT doc_id, e.tag, EXISTS (SELECT 1 FROM o WHERE o.tag = e.tag AND contains(low, form)) AS named, (SELECT count(DISTINCT word) FROM w WHERE w.tag = e.tag AND contains(low, form))::DOUBLE / n AS score FROM e JOIN k ON e.tag = k.tag)
SELECT doc_id, tag, named, score, CASE WHEN named THEN '' WHEN score = 0 THEN 'high' WHEN score < 0.15 THEN 'low_score' ELSE '' END AS issue FROM s""",
        "profile_verdicts": f"""WITH {b}, t AS (SELECT * FROM {_table(tokens, 'tag, word, kind, weight')}), e AS (SELECT DISTINCT doc_id, low, unnest(tags) AS tag FROM b),
s AS (SELECT doc_id, low, tag, coalesce((SELECT sum(weight) FROM t WHERE t.tag = e.tag AND kind = 'keyword' AND contains(low, word)), 0) AS kw, coalesce((SELECT sum(weight) FROM t WHERE t.tag = e.tag AND kind = 'priority' AND contains(low, word)), 0) AS pri,
  EXISTS (SELECT 1 FROM t WHERE t.tag = e.tag AND kind = 'negative' AND contains(low, word)) AS neg, EXISTS (SELECT 1 FROM t WHERE t.tag = e.tag) AS has_profile FROM e),
v AS (SELECT *, CASE WHEN {any_of('appoint', 'term of office')} THEN CASE WHEN tag = 'appointments' THEN 'accept' WHEN tag <> 'admin' THEN 'reject' END
  WHEN {any_of('travel', 'working group')} THEN CASE WHEN tag = 'admin' THEN 'accept' WHEN tag <> 'appointments' THEN 'reject' END WHEN {any_of('million', 'budget')} AND tag = 'budget' THEN 'accept' END AS forced, round(pri, 9) >= 0.2 OR round(kw, 9) >= 0.1 AS strong FROM s)
SELECT doc_id, tag, round(kw, 9)::DOUBLE AS keyword_share, round(pri, 9)::DOUBLE AS priority_share, neg AS has_negative, CASE WHEN NOT has_profile THEN 'no profile' WHEN forced = 'reject' THEN 'rule' WHEN forced = 'accept' THEN 'kept' WHEN neg AND NOT strong THEN 'negative' WHEN strong THEN 'kept' ELSE 'insufficient' END AS verdict FROM v""",
    }


QUERIES = {"word_forms": runner(word_forms), **{f.__name__: f for f in (word_mentions, body_mentions, body_evidence, dictionary_links, policy_relevance, profile_verdicts)}}
ORACLES = {"word_forms": word_forms(DUCK), **_oracles()}
