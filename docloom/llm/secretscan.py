"""Operator 2: secret scans with corpus-wide ownership frequency. DataFrame functions only.

A text is scanned for the kinds below. The value of each candidate is hashed
and the hashes are aggregated by distinct repositories (documents) and owners
(sources): a value is a widely copied example if ``example_owners`` or more
owners hold it, or more than one owner and ``example_repos`` or more
repositories; many repositories of one owner share that owner's own value. Any other is specific to its owners, and looks live unless it is
a stand-in (``changeme``, ``your_token``, one character over and over). A value
found all over the corpus is reduced before it is shuffled and its frequency is
one row, so it is no skew. A scan shuffles candidates only; redaction also the
texts that have some.

A private key is its header and body (the end line is left out); its value is
the base64 of the body, so keys under one header text are told apart and the
body is what is replaced. A header without a body is no candidate.

Spans are code points, end exclusive. Positions come from splitting the text at
the matches of one kind; texts that lack what each match of a kind has skip
that. Time is in proportion to the text and its matches.

Defined results: a null text is empty; a row without candidates has empty spans
and zero counts; a null source counts as no owner, a null doc_id as one
repository; repeated rows get a row each and count once in the frequencies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import cut, load, reached, row_key, starts

_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_BETWEEN = r"""(?:[\s"',+]|\\[nr])*+"""  # what may stand between the lines of a key: also escaped and quoted line ends
#: header and body of a private key: all up to the end line or, where that is missing, header fields and lines of base64
_PEM = (
    r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----([^-]*+(?:-[^-]++){0,60}+(?=-----END [A-Z ]{0,20}PRIVATE KEY-----)"
    rf"|{_BETWEEN}(?:[A-Za-z][A-Za-z0-9-]{{1,30}}: [^\r\n\\]{{1,200}}+{_BETWEEN}){{0,8}}+[A-Za-z0-9+/]{{16,}}+={{0,2}}+(?:(?:[\s\"',]|\\[nr])++[A-Za-z0-9+/]{{16,}}+={{0,2}}+)*+(?:(?:[\s\"',]|\\[nr])++[A-Za-z0-9+/]{{1,15}}+={{1,2}}+)?)")
#: what a key's body has besides base64
_PEM_REST = r"[A-Za-z][A-Za-z0-9-]*:[^\r\n\\]*|\\[nr]|[^A-Za-z0-9+/=]"
#: kind -> (Java pattern, group that holds the value, fewest characters of the value); fixed values: the first three are the contract's
KINDS: dict[str, tuple[str, int, int]] = {
    "assign": (_ASSIGN, 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
    # spans the method adds
    "forge": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 36),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30),
    "pem": (_PEM, 1, 20),
}
BASE = ("assign", "access", "hex")
#: kind -> SQL over __t and __low (the text in lower case) that is true of every text with a match
GATES: dict[str, str] = {
    "assign": " or ".join(f"contains(__low, '{w}')" for w in ("passw", "secret", "token", "apikey", "api_key")),
    "access": "contains(__t, 'AKIA')",
    "hex": "__t rlike '[0-9a-f]{32}'",
    "forge": "contains(__t, '_') and (" + " or ".join(f"contains(__t, 'gh{c}_')" for c in "pousr") + ")",
    "jwt": "contains(__t, 'eyJ')",
    "pem": "contains(__t, 'PRIVATE KEY-----')",
}
#: values that stand in for a credential
STAND_IN = "(?i)example|sample|placeholder|change_?me|dummy|your[_-]|xxxx|[*]{4}|00000000|12345678|abcdefgh"
EXAMPLE_OWNERS = 3
EXAMPLE_REPOS = 20
MARK = "[SECRET]"
PART = 4096  # characters of a text that are cut out of one string


def _quoted(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _texts(docs: DataFrame, text_col: str, *cols) -> DataFrame:
    """``cols`` with __t, the text, and __low."""
    d = docs.select(*cols, F.coalesce(F.col(text_col), F.lit("")).alias("__t"))
    return d.withColumn("__low", F.lower("__t"))


def candidate(docs: DataFrame, text_col: str = "text"):
    """Whether a row may hold a candidate: a cheap test that is never false where there is one."""
    gate = " or ".join(f"({g})" for g in GATES.values())
    # the text in lower case is made once for all the tests
    return F.expr(f"exists(array(coalesce(`{text_col}`, '')), __t -> exists(array(lower(__t)), __low -> {gate}))")


def scan(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """``keep``, row key and array ``found`` of (start, rank, kind, end, value, from) for every row."""
    d = _texts(docs, text_col, *keep, row_key(*keep, text_col).alias("__key"))
    none = "cast(array() as array<struct<start:int,rank:int,kind:string,end:int,value:string,from:int>>)"
    for k, (kind, (pattern, group, least)) in enumerate(KINDS.items()):
        p = _quoted(pattern)
        # copies of a key count as one however their lines are broken
        value = f"regexp_replace(__values[i], '{_quoted(_PEM_REST)}', '')" if kind == "pem" else "__values[i]"
        cols = ["__key", "__t", "__low", *keep, *[f"__{x}" for x in list(KINDS)[:k]]]
        d = d.select(*cols, F.expr(GATES[kind]).alias("__gate"))
        d = d.select(*cols, F.expr(f"if(__gate, split(__t, '{p}', -1), null)").alias("__gaps"),
                     F.expr(f"if(__gate, regexp_extract_all(__t, '{p}', 0), null)").alias("__hits"),
                     F.expr(f"if(__gate, regexp_extract_all(__t, '{p}', {group}), null)").alias("__values"))
        d = d.withColumn("__acc", F.expr(starts("__hits", "length(__gaps[i])", "length(__hits[i])")))
        d = d.select(*cols, F.expr(
            f"if(__hits is null, {none}, filter(transform(__hits, (h, i) -> struct(__acc[i] as start, {k} as rank, '{kind}' as kind,"
            f" __acc[i] + length(h) as end, {value} as value, __acc[i] + length(h) - length(__values[i]) as from)), x -> length(x.value) >= {least}))").alias(f"__{kind}"))
    return d.select(*keep, "__key", F.array_sort(F.concat(*[f"__{k}" for k in KINDS])).alias("found"))


def ownership(found: DataFrame, repo: str = "doc_id", owner: str = "source", example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """value_hash, n_repos, n_owners, stand_in, is_example, is_live over the whole corpus."""
    each = found.select(F.col(repo).alias("r"), F.col(owner).alias("o"), F.explode("found").alias("x")).select(
        F.coalesce(F.col("r").cast("string"), F.lit("\x00")).alias("r"), "o", F.sha2("x.value", 256).alias("value_hash"),
        (F.col("x.value").rlike(STAND_IN) | F.col("x.value").rlike(r"^(.)\1*$")).alias("stand_in"))
    pairs = each.groupBy("value_hash", "o", "r").agg(F.max("stand_in").alias("stand_in"))  # copies meet here, map side first
    counted = pairs.groupBy("value_hash").agg(
        F.count_distinct("r").alias("n_repos"), F.count_distinct("o").alias("n_owners"), F.max("stand_in").alias("stand_in"))
    wide = (F.col("n_owners") >= example_owners) | ((F.col("n_owners") > 1) & (F.col("n_repos") >= example_repos))
    return counted.withColumn("is_example", wide).withColumn("is_live", ~wide & ~F.col("stand_in"))


def classified(docs: DataFrame, **how) -> DataFrame:
    """The scan, each entry of ``found`` with is_example, is_live, n_repos and n_owners of its value."""
    found = cut(scan(docs))  # texts are scanned once; what is cut holds candidates only
    some = found.where(F.size("found") > 0)
    # rows of one key hold the same candidates: each place is judged once
    each = some.select("__key", F.explode("found").alias("x")).select("__key", "x", F.sha2("x.value", 256).alias("value_hash")).distinct()
    judged = each.join(ownership(some, **how), "value_hash").groupBy(F.col("__key").alias("__at")).agg(
        F.sort_array(F.collect_list(F.struct("x.*", "is_example", "is_live", "n_repos", "n_owners"))).alias("judged"))
    return found.drop("found").join(judged, F.col("__key") == F.col("__at"), "left").select(
        *[c for c in found.columns if c != "found"], F.coalesce("judged", F.expr(f"cast(array() as {judged.schema['judged'].dataType.simpleString()})")).alias("found"))


def _cut_out(text: str, spans: str, mark: str) -> str:
    """SQL of the text with each of the spans (f, e) replaced; spans that overlap are one.

    What stays runs from the furthest end so far to the next start, and is taken
    from parts of the text, since a string is read from its start.
    """
    ends = "transform(xs, x -> x.e)"
    gaps = f"transform(arrays_zip(xs, {reached(ends)}), z -> struct(z['1'] as f, z.xs.f as e))"
    stays = (
        f"transform(array(array_sort({spans})), xs -> array_append(filter({gaps}, s -> s.f <= s.e),"
        f" struct(coalesce(array_max({ends}), 0) as f, length({text}) as e)))[0]")
    piece = (
        f"if(s.e <= s.f, '', array_join(transform(sequence(s.f div {PART}, (s.e - 1) div {PART}), q ->"
        f" substr(ps[q], cast(greatest(s.f - q * {PART}, 0) + 1 as int), cast(least(s.e - q * {PART}, {PART}) - greatest(s.f - q * {PART}, 0) as int))), ''))")
    parts = f"regexp_extract_all({text}, '(?s).{{1,{PART}}}', 0)"
    return f"transform(array({parts}), ps -> array_join(transform({stays}, s -> {piece}), '{mark}'))[0]"


def redact(docs: DataFrame, mark: str = MARK, **how) -> DataFrame:
    """The documents with every live-looking value replaced by ``mark``; examples and stand-ins stay, as do all rows.

    Only texts that may hold a candidate are shuffled to meet their verdicts.
    """
    may = candidate(docs)
    some = docs.where(may)
    c = classified(some.select("doc_id", "source", "text"), **how).where(F.size("found") > 0)
    c = c.select(F.col("__key").alias("__at"), F.col("doc_id").alias("__id"), F.expr("filter(found, x -> x.is_live)").alias("__live"))
    c = c.dropDuplicates(["__at", "__id"])
    # ids are compared too: two documents whose keys collide keep their own spans
    same = (F.col("__key") == F.col("__at")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    d = some.withColumn("__key", row_key("doc_id", "source", "text")).join(c, same, "left")
    d = d.withColumn("text", F.expr(f"if(size(__live) > 0, {_cut_out('text', 'transform(__live, x -> struct(x.from as f, x.end as e))', mark)}, text)"))
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.when(F.size("__live") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return docs.where(~may).unionByName(d.select(*docs.columns))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document of the whole table."""
    c = classified(load(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    names = "', '".join(BASE)
    span = "x -> concat(x.kind, ':', x.start, ':', x.end)"
    count = lambda k: F.expr(f"cast(size(filter(found, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}")
    judged = lambda v: F.expr(f"cast(size(filter(found, x -> x.{v})) as bigint)")
    most = lambda v: F.coalesce(F.array_max(F.expr(f"transform(found, x -> x.{v})")), F.lit(0)).cast("long").alias(f"max_{v[2:]}")
    return c.select(
        "doc_id", *[count(k) for k in BASE],
        F.sha2(F.expr(f"array_join(transform(filter(found, x -> x.kind in ('{names}')), {span}), ',')"), 256).alias("base_sha256"),
        F.expr(f"array_join(transform(found, {span}), ',')").alias("spans"),
        judged("is_live").alias("n_live"), judged("is_example").alias("n_example"), most("n_repos"), most("n_owners"),
    )


def _oracle() -> str:
    """DuckDB SQL: spans by splitting at the matches, frequencies by distinct counts."""
    parts = []
    # DuckDB's patterns lack lookaheads: the SQL knows a key by its header alone and agrees on tables without keys
    kinds = {**KINDS, "pem": (r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 20)}
    for k, (kind, (pattern, group, least)) in enumerate(kinds.items()):
        p = pattern.replace("'", "''")
        parts.append(
            f"SELECT r, doc_id, source, {k} AS rank, '{kind}' AS kind, unnest(regexp_extract_all(t, '{p}', 0)) AS hit,"
            f" unnest(regexp_extract_all(t, '{p}', {group})) AS value, unnest(regexp_split_to_array(t, '{p}')[:-2]) AS gap,"
            f" unnest(range(len(regexp_extract_all(t, '{p}', 0)))) AS i, {least} AS least FROM t WHERE regexp_matches(t, '{p}')")
    union = " UNION ALL ".join(parts)
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
m AS ({union}),
s AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY r, kind ORDER BY i) - length(hit) AS start FROM m),
f AS (SELECT r, doc_id, source, rank, kind, value, start::BIGINT AS s, (start + length(hit))::BIGINT AS e FROM s WHERE length(value) >= least),
o AS (SELECT value, count(DISTINCT source) AS owners, count(DISTINCT coalesce(doc_id::VARCHAR, chr(0))) AS repos, owners >= {EXAMPLE_OWNERS} OR (owners > 1 AND repos >= {EXAMPLE_REPOS}) AS ex,
  NOT ex AND NOT regexp_matches(value, '{STAND_IN}') AND length(replace(value, value[1], '')) > 0 AS live FROM f GROUP BY value),
a AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3), '') AS base,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans,
  count(*) FILTER (live) AS n_live, count(*) FILTER (ex) AS n_example, max(repos) AS max_repos, max(owners) AS max_owners FROM f JOIN o USING (value) GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example,
  coalesce(max_repos, 0)::BIGINT AS max_repos, coalesce(max_owners, 0)::BIGINT AS max_owners
FROM t LEFT JOIN a USING (r)"""


ORACLE = _oracle()
