"""Fixers of tagged records: which rows each takes up, what it proposes, what of that is accepted, and the records after it.

A fixer is a row of a table. A tagger (a model, or rules) is asked once for each
record that any fixer takes up; what it says is held against the fixer's own
condition. A dry run gives the proposals; to apply them is one join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.mentions import mentioned
from docloom.operators.taggers import Tagger, tag_records
from docloom.sources.html import page_text

CLASSES = ("operative", "declarative")
GARBAGE = r"just a moment|access denied|captcha"
PROPOSAL = ["fixer", "field", "old", "new"]


class Packs(NamedTuple):
    """What fixers know of the domain: the fallback tag, tags that are suspicious alone, keywords by tag, words by body, words and first year by special category."""

    fallback: str
    suspicious: tuple[str, ...]
    keywords: dict[str, tuple[str, ...]]
    bodies: dict[str, tuple[str, ...]]
    special: dict[str, tuple[tuple[str, ...], int]]


class Fixer(NamedTuple):
    """A fixer's name, the field it rewrites, the rows it takes up, and which new values it accepts."""

    name: str
    field: str
    takes: Column
    accepts: Callable[[Column, Column], Column]


def _said(words: Iterable[str], text: str = "content") -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lit(w))
    return out


def garbage(content: str = "content") -> Column:
    """A page that was not served: no text to speak of, or the words of a gate."""
    return (F.length(F.coalesce(content, F.lit(""))) < 40) | F.lower(F.coalesce(content, F.lit(""))).rlike(GARBAGE)


def fixers(p: Packs) -> list[Fixer]:
    """The fixers in the order they are applied; a later one has the last word on its field."""
    differs = lambda old, new: new.isNotNull() & (new != "") & ~new.eqNullSafe(old)
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    tags, summary, text = F.coalesce("policy", F.lit("")), F.coalesce("summary", F.lit("")), ~garbage()
    keyword = F.lit(False)
    for t in p.suspicious:
        keyword = keyword | ((F.trim(tags) == t) & ~_said(p.keywords.get(t, ())))
    body = F.lit(False)
    for b, ws in p.bodies.items():
        body = body | (F.array_contains(F.transform(F.split(F.coalesce("bodies", F.lit("")), ";"), F.trim), b) & ~_said(ws))
    return [
        Fixer("operativity", "operativity", text & ~F.coalesce(F.trim("operativity").isin(*CLASSES), F.lit(False)), lambda old, new: differs(old, new) & new.isin(*CLASSES)),
        Fixer("policy-tags", "policy", text & (F.trim(tags) == p.fallback), lambda old, new: differs(old, new) & (new != p.fallback)),
        Fixer("policy-tags-defaults", "policy", text & keyword, differs),
        Fixer("summaries", "summary", text & ((F.length(summary) < 20) | (F.length(summary) > 800) | (F.trim(summary) == F.trim(F.coalesce("title", F.lit(""))))), lambda old, new: differs(old, new) & F.length(new).between(20, 500)),
        Fixer("government-bodies", "bodies", text & (blank(F.col("bodies")) | body), differs),
        Fixer("special-category", "special", text, differs),
    ]


def proposals(df: DataFrame, key: str, packs: Packs, tagger: Tagger, fallback: Tagger | None = None, names: Iterable[str] | None = None, year: str = "yr") -> DataFrame:
    """key, fixer, field, old, new: what the named fixers (all by default, unknown names are skipped) would write.

    ``df`` has title, content, summary, operativity, policy, bodies, special and a
    year. A tagger that fails leaves its row to ``fallback``, or without proposals.
    """
    chosen = [f for f in fixers(packs) if names is None or f.name in set(names)]
    none = df.select(key, *[F.lit(None).cast("string").alias(c) for c in PROPOSAL]).where(F.lit(False))
    if not chosen:
        return none
    olds = ("summary", "operativity", "policy", "bodies", "special")
    taken = df.select(key, "title", "content", F.col(year).alias("__year"), *[F.col(c).alias(f"old_{c}") for c in olds],
                      F.array_compact(F.array(*[F.when(f.takes, F.lit(f.name)) for f in chosen])).alias("__fixers")).where("size(__fixers) > 0")
    asked = [f for f in chosen if f.field in ("summary", "operativity", "policy")]
    listed = tuple(packs.keywords) + (packs.fallback,)
    known = taken.where(F.exists("__fixers", lambda x: x.isin(*[f.name for f in asked]))) if asked else taken.limit(0)
    told = tag_records(known, tagger, fallback, listed).select(key, "old_summary", "old_operativity", "old_policy", "__fixers", F.col("summary").alias("new_summary"), F.col("operativity").alias("new_operativity"), F.col("tags").alias("new_policy"))

    rows = none
    if asked:
        rows = told.select(key, F.explode(F.array_compact(F.array(*[
            F.when(F.array_contains("__fixers", f.name) & f.accepts(F.col(f"old_{f.field}"), F.col(f"new_{f.field}")),
                   F.struct(F.lit(f.name).alias("fixer"), F.lit(f.field).alias("field"), F.col(f"old_{f.field}").alias("old"), F.col(f"new_{f.field}").alias("new"))) for f in asked]))).alias("x")).select(key, "x.*")
    own = [f for f in chosen if f not in asked]
    if own:
        bodies, special = list(packs.bodies), list(packs.special)
        words = [(i, w) for i, b in enumerate(bodies) for w in packs.bodies[b]] + [(len(bodies) + i, w) for i, s in enumerate(special) for w in packs.special[s][0]]
        m = taken.withColumn("__m", F.transform(mentioned(df.sparkSession, F.concat_ws(" ", "title", "content"), words), lambda x: x["rule"]))
        found = F.array_join(F.array_compact(F.array(*[F.when(F.array_contains("__m", i), F.lit(b)) for i, b in enumerate(bodies)])), "; ")
        had = F.filter(F.transform(F.split(F.coalesce("old_special", F.lit("")), ";"), F.trim), lambda x: x != "")
        more = F.array_compact(F.array(*[F.when(F.array_contains("__m", len(bodies) + i) & (F.col("__year") >= packs.special[s][1]), F.lit(s)) for i, s in enumerate(special)]))
        value = {"bodies": found, "special": F.array_join(F.array_union(had, more), "; ")}
        rows = rows.unionByName(m.select(key, F.explode(F.array_compact(F.array(*[
            F.when(F.array_contains("__fixers", f.name) & f.accepts(F.col(f"old_{f.field}"), value[f.field]),
                   F.struct(F.lit(f.name).alias("fixer"), F.lit(f.field).alias("field"), F.col(f"old_{f.field}").alias("old"), value[f.field].alias("new"))) for f in own]))).alias("x")).select(key, "x.*"))
    return rows


def applied(df: DataFrame, found: DataFrame, key: str, packs: Packs) -> DataFrame:
    """The records with the proposals written; of two for one field that of the later fixer."""
    place = F.create_map(*[x for i, f in enumerate(fixers(packs)) for x in (F.lit(f.name), F.lit(i))])[F.col("fixer")]
    fields = [c for c in df.columns if c in {f.field for f in fixers(packs)}]
    new = found.groupBy(F.col(key).alias("__k")).agg(*[F.max_by(F.when(F.col("field") == c, F.col("new")), F.when(F.col("field") == c, place)).alias(f"__{c}") for c in fields])
    return df.join(new, F.col(key) == F.col("__k"), "left").select(*[F.coalesce(f"__{c}", c).alias(c) if c in fields else F.col(c) for c in df.columns])


def refetched(df: DataFrame, key: str, fetch: Callable[[str], str | None], url: str = "url", content: str = "content", dry_run: bool = True) -> DataFrame:
    """Records whose content is garbage, read again by ``fetch`` (address to HTML): key, url, old, new, status.

    In a dry run they are listed only. New content that is missing, garbage or the
    same leaves the record as it is; ``fetch`` may raise, row by row.
    """
    bad = df.where(garbage(content)).select(key, url, F.col(content).alias("old"))
    if dry_run:
        return bad.select("*", F.lit(None).cast("string").alias("new"), F.lit("listed").alias("status"))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def one(address: str | None) -> tuple[str | None, str]:
            if not address:
                return None, "no address"
            try:
                return page_text(fetch(address)).main or None, "fetched"
            except Exception as e:  # noqa: BLE001 - whatever a client raises, its row stays
                return None, f"failed: {type(e).__name__}"

        for addresses in batches:
            yield pd.DataFrame([one(a) for a in addresses], columns=["new", "status"])

    get = F.pandas_udf(run, "new string, status string").asNondeterministic()
    out = bad.withColumn("__x", get(F.col(url))).select(key, url, "old", "__x.new", "__x.status")
    poor = (F.col("status") == "fetched") & (garbage("new") | F.col("new").eqNullSafe(F.col("old")))
    return out.select(key, url, "old", F.when(~poor, F.col("new")).alias("new"), F.when(poor, "no better").otherwise(F.col("status")).alias("status"))
