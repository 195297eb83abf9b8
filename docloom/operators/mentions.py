"""Which words of a dictionary a text mentions, in one pass a text whatever the size of the dictionary."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.affixes import Affixes

MOST_FORMS = 2_000_000  # of a dictionary that one automaton holds; a larger one is parted and its parts are scanned one after the other
SLICE = 256  # texts that are strings at a time
FOUND = "array<struct<rule:int,tier:int>>"


def forms(words: Iterable[tuple[int, str]], affixes: Affixes | None) -> list[tuple[str, int, int]]:
    """(form, rule, tier) of a dictionary of (rule, word), lower-cased."""
    return [(f, rule, t) for rule, w in words for t, f in (affixes.forms(w.lower()) if affixes else [(1, w.lower())]) if f]


class Scanner:
    """An automaton over all forms: for a text, the best tier of each rule that it mentions."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        at: dict[str, dict[int, int]] = {}
        for form, rule, tier in rows:
            of = at.setdefault(form, {})
            of[rule] = min(tier, of.get(rule, tier))
        self.automaton = ahocorasick.Automaton()
        for form, of in at.items():
            self.automaton.add_word(form, (form, tuple(of.items())))
        if at:
            self.automaton.make_automaton()
        self.empty = not at

    def found(self, text: str) -> dict[int, int]:
        best: dict[int, int] = {}
        if self.empty or not text:
            return best
        seen = set()
        for _, (form, of) in self.automaton.iter(text):
            if form in seen:
                continue
            seen.add(form)
            for rule, tier in of:
                if tier < best.get(rule, 99):
                    best[rule] = tier
        return best


def mentioned(spark: SparkSession, text: Column, words: Iterable[tuple[int, str]], affixes: Affixes | None = None, most: int = MOST_FORMS) -> Column:
    """An array of (rule, tier), by rule, of the dictionary's words that stand in a text (lower-cased, anywhere in it); none for a null text.

    The dictionary is given by the caller, so its size is known; it is sent to the executors once.
    """
    rows = forms(words, affixes)
    parts = [rows[k : k + most] for k in range(0, len(rows), most)] or [[]]
    shared = spark.sparkContext.broadcast(parts)
    cached: list[Scanner] = []

    @F.arrow_udf(FOUND)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if len(shared.value) == 1 and not cached:
            cached.append(Scanner(shared.value[0]))
        kind = pa.list_(pa.struct([("rule", pa.int32()), ("tier", pa.int32())]))
        for texts in batches:
            out: list[dict[int, int]] = [{} for _ in range(len(texts))]
            for part in shared.value:
                scanner = cached[0] if cached else Scanner(part)
                for k in range(0, len(texts), SLICE):
                    for i, t in enumerate(texts.slice(k, SLICE).to_pylist(), k):
                        for rule, tier in scanner.found((t or "").lower()).items():
                            out[i][rule] = min(tier, out[i].get(rule, tier))
            yield pa.array([[{"rule": r, "tier": t} for r, t in sorted(o.items())] for o in out], kind)

    return scan.asNondeterministic()(text)


def mentions(df: DataFrame, text_col: str, key: list[str], words: Iterable[tuple[int, str]], affixes: Affixes | None = None) -> DataFrame:
    """``key``, rule, tier: a row for each word of the dictionary that a text mentions."""
    return df.select(*key, F.explode(mentioned(df.sparkSession, F.col(text_col), words, affixes)).alias("__m")).select(*key, "__m.rule", "__m.tier")
