"""Operator 5: licence scans by ordered signature rules. DataFrame functions only.

A text is normalised to lower-case words; a keyword prefilter decides which
rules look at it at all, so a text without licence words costs one pass. Each
rule that is let in yields intervals of words. A detection is suppressed if the
interval of one with a higher priority (ties: the longer one, then the earlier
rule) contains it, which one sweep over the sorted detections decides. Everything
happens within a row: no shuffle, no skew, and time in proportion to the text and
to its detections.

Defined results: a null or empty text has no words, no labels and score 0;
repeated rows get a row each; other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import BLOCK, ascii_lower, load, starts
from docloom.llm.license_rules import BY_NAME, named, rules

#: fixed values of the base labels
BASE: dict[str, str] = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

NOT_WORD = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
KIND = "struct<s:int,e:int,p:int,i:int,label:string,score:double>"
ORDERED = "struct<s:int,ne:int,np:int,i:int,e:int,p:int,k:int,label:string,score:double>"
NONE = f"cast(array() as array<{KIND}>)"


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _words(text: str) -> str:
    """Words of a piece of normalised text: each is led by one space."""
    return f"(length({text}) - length(replace({text}, ' ', '')))"


def _either(words: list[str]) -> str:
    """A pattern of any of the words, by first letters: a text's word is held against few of them."""
    if len(words) < 4:
        return f"(?:{'|'.join(words)})"
    heads = sorted({w[:1] for w in words})
    return "(?:" + "|".join(h + (_either([w[1:] for w in words if w[:1] == h]) if h else "") for h in heads) + ")"


def _places(hits: str, gaps: str, item: str) -> str:
    """SQL of an array of ``item`` over (s, e, h): word intervals of the hits, which alternate with the gaps."""
    at = starts(hits, _words(f"{gaps}[i]"), _words(f"{hits}[i]"))
    hit = f"{hits}[o]"
    return f"transform({at}, (v, o) -> {item.format(s='v', e=f'v + {_words(hit)}', h=hit)})"


def _surviving(found: str, levels: int) -> str:
    """SQL of the detections that none of higher priority contains (ties: the longer one, then the earlier rule).

    One sweep in order of start, longest and best first: whatever contains a
    detection and beats it came before, so it is enough to know, for each
    level k of priority (0 the highest), how far those of it or above have reached.
    """
    further = "transform({}, (v, k) -> if(k >= x.k, greatest(v, x.e), v))"
    none = f"array_repeat(-1, {levels})"
    # blocks of detections: how far each reaches, what reaches into each, and what it keeps; an array is copied when it grows
    reach = f"transform(bs, b -> aggregate(b, {none}, (a, x) -> {further.format('a')}))"
    into = f"aggregate({reach}, struct({none} as at, cast(array() as array<array<int>>) as s), (a, r) -> struct(zip_with(a.at, r, (v, w) -> greatest(v, w)) as at, array_append(a.s, a.at) as s)).s"
    kept = (
        f"aggregate(b, struct(y.i[j] as reach, cast(array() as array<{ORDERED}>) as out), (a, x) -> struct({further.format('a.reach')} as reach,"
        " if(a.reach[x.k] < x.e, array_append(a.out, x), a.out) as out)).out")
    swept = f"transform(array(struct(bs as bs, {into} as i)), y -> flatten(transform(y.bs, (b, j) -> {kept})))[0]"
    blocks = f"transform(sequence(0, size(xs) - 1, {BLOCK}), b -> slice(xs, b + 1, {BLOCK}))"
    whole = f"transform(array(array_sort({found})), xs -> if(size(xs) = 0, cast(array() as array<{ORDERED}>), transform(array({blocks}), bs -> {swept})[0]))[0]"
    return f"transform({whole}, x -> struct(x.s as s, x.e as e, x.p as p, x.i as i, x.label as label, x.score as score))"


def scan(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, n_words, ``base`` places (s, label) and surviving detections ``found`` for every row."""
    book = rules()
    keywords = sorted({r.keyword for r in book})
    levels = sorted({r.priority for r in book}, reverse=True)
    groups = ", ".join(f"struct({_sql(k)} as k, array(" + ", ".join(
        f"struct({i} as i, {r.priority} as p, {levels.index(r.priority)} as k, {r.confidence}D as c, {_sql(r.label)} as label, {_sql(f' {r.pattern}(?= )')} as re)"
        for i, r in enumerate(book) if r.keyword == k) + ") as rules)" for k in keywords)
    base_at = _sql(" (?:" + "|".join(BASE) + ")(?= )")
    labels = "case " + " ".join(f"when {{h}} = ' {p}' then '{label}'" for p, label in BASE.items()) + " end"
    d = docs.select(*keep, ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("__l"))
    d = d.withColumn("__n", F.expr(f"concat(' ', trim(BOTH ' ' FROM regexp_replace(__l, '{NOT_WORD}', ' ')), ' ')")).drop("__l")
    d = d.select(
        *keep, "__n", F.expr(f"cast(if(__n = '  ', 0, {_words('__n')} - 1) as bigint)").alias("n_words"),
        F.expr(f"__n rlike {_sql(f' {_either(keywords)} ')}").alias("__gated"),
        F.expr(" or ".join(f"contains(__n, ' {p} ')" for p in BASE)).alias("__based"),
    )
    d = d.withColumn("__hits", F.expr(f"if(__based, regexp_extract_all(__n, {base_at}, 0), cast(array() as array<string>))"))
    d = d.withColumn("__gaps", F.expr(f"if(__based, split(__n, {base_at}, -1), null)"))
    d = d.withColumn("base", F.expr(_places("__hits", "__gaps", f"struct({{s}} as s, {labels} as label)")))
    d = d.drop("__hits", "__gaps", "__based")
    d = d.withColumn("__let", F.expr(
        f"if(__gated, flatten(transform(filter(array({groups}), g -> contains(__n, concat(' ', g.k, ' '))), g -> g.rules)), null)"))
    # a rule that is let in is tried once; its hits and the gaps between them follow only where it matches
    d = d.withColumn("__tried", F.expr(
        "if(__let is null, null, transform(filter(__let, r -> regexp_like(__n, r.re)), r ->"
        " struct(r as r, regexp_extract_all(__n, r.re, 0) as hits, split(__n, r.re, -1) as gaps)))")).drop("__let", "__n", "__gated")
    # in the order of the sweep: start, longest, highest priority, earliest rule
    item = "struct({s} as s, -({e}) as ne, -t.r.p as np, t.r.i as i, {e} as e, t.r.p as p, t.r.k as k, if(t.r.label = '{by_name}', {named}, t.r.label) as label, t.r.c as score)".replace("{by_name}", BY_NAME).replace("{named}", named("{h}"))
    d = d.withColumn("__all", F.expr(f"if(__tried is null, null, flatten(transform(__tried, t -> {_places('t.hits', 't.gaps', item)})))")).drop("__tried")
    return d.withColumn("found", F.expr(f"if(__all is null, {NONE}, {_surviving('__all', len(levels))})")).drop("__all")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document of the whole table."""
    d = scan(load(spark, sf_dir, "documents"))
    starts = "transform(base, x -> x.s)"
    return d.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.expr(f"cast(array_min({starts}) as bigint)").alias("first_word"), F.expr(f"cast(array_max({starts}) as bigint)").alias("last_word"),
        F.expr("array_join(array_sort(array_distinct(transform(base, x -> x.label))), ',')").alias("base_labels"),
        F.expr("array_join(array_sort(array_distinct(concat(transform(base, x -> x.label), transform(found, x -> x.label)))), ',')").alias("labels"),
        # the confidence of the best surviving detection; a bare base phrase counts half
        F.expr("greatest(if(size(base) > 0, 0.5D, 0D), coalesce(array_max(transform(found, x -> x.score)), 0D))").alias("score"),
    )
