"""Operator 7: language identification by cross-parsing entropy.

For each language a suffix automaton is built over labelled text. A text is
parsed against it greedily: the longest match from here is one phrase, and the
next phrase starts after it (a character the automaton has never seen is a
phrase of its own). The fewer phrases a text needs, the closer it is to the
language; counts are normalised by the number of characters, and the language
with the fewest wins, ties by name. Both sides are running text: lower-case
words one space apart, and a phrase may run over many words.

The score is 1 - best / second best, with phrases per character: 0 for a tie.

Labelled texts are read as pieces of ``PIECE`` characters, and the sample is
bounded in pieces: ``sample`` a language, those with the smallest hashes of
document and place, and ``CHARACTERS`` in all. So what reaches the driver, and
the automata, are bounded whatever the length of the texts. Every label is
learned: many languages share the characters, with fewer pieces each and, beyond
CHARACTERS / PIECE of them, shorter ones of ``SHORTEST`` at least. Every text is
parsed whole.

Defined results: ``und`` with score 0 where a text is null or has no letter, or
no labelled text exists; repeated rows get a row each; a null lang teaches
nothing; other columns are not touched, but ``identify`` replaces columns of the
names it adds.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import cut, load

SAMPLE = 128  # pieces a language
PIECE = 1024  # characters
CHARACTERS = 1 << 21  # of the sample of all languages: up to 16 have theirs in full
SHORTEST = 64
BROADCAST_ROWS = 100_000
FOLDS, HELD_OUT = 4, 2
LETTERS = re.compile(r"[^\W\d_]+")
BREAK = "\x02"  # between pieces of labelled text: no phrase crosses it
SLICE = 6_000_000  # characters that are strings at a time
LONG = 1 << 20  # characters of one text that are a list at a time
DENSE = 1 << 27  # cells of a table that is an array
FEW = 40  # texts a step is worth while for


class SuffixAutomaton:
    """The suffix automaton of one text, as arrays of transitions: from, letter, to."""

    def __init__(self, text: str):
        link, length, nxt = [-1], [0], [{}]
        last = 0
        for c in text:
            cur = len(nxt)
            length.append(length[last] + 1)
            link.append(0)
            nxt.append({})
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    nxt.append(nxt[q].copy())
                    while p != -1 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        self.size = len(nxt)
        self.source = np.array([s for s, out in enumerate(nxt) for _ in out], dtype=np.int32)
        self.letter = "".join(c for out in nxt for c in out)
        self.target = np.array([t for out in nxt for t in out.values()], dtype=np.int32)


class Parser:
    """Greedy parses of many texts at once against the automata of several languages.

    All automata share one table of transitions, state by letter; a step of the
    parse moves every text in every language by one character.
    """

    def __init__(self, automata: list[SuffixAutomaton]):
        self.n = n = len(automata)
        letters = sorted({c for a in automata for c in a.letter})
        self.width = len(letters) + 1  # letter 0: one that no text of the sample has
        self.code = np.zeros(sys.maxunicode + 1, np.uint16)
        self.code[[ord(c) for c in letters]] = np.arange(1, self.width)
        # a state is the place of its row in the table
        self.roots = np.cumsum([0, *[a.size for a in automata]])[:-1].astype(np.int64) * self.width
        cells = [a.source.astype(np.int64) * self.width + at + self.code[np.frombuffer(a.letter.encode("utf-32-le"), np.uint32)] for a, at in zip(automata, self.roots)]
        targets = [a.target.astype(np.int64) * self.width + at for a, at in zip(automata, self.roots)]
        size = sum(a.size for a in automata) * self.width
        self.dense = size <= DENSE
        if self.dense:
            self.table = np.full(size, -1, np.int32)
            for c, t in zip(cells, targets):
                self.table[c] = t
        else:  # an alphabet of thousands: cells in order, found by bisection
            cells, targets = np.concatenate(cells), np.concatenate(targets)
            order = np.argsort(cells)
            self.cells, self.table = cells[order], targets[order]
        self.first = np.stack([self.after(r + np.arange(self.width)) for r in self.roots]) if n else np.empty((0, self.width), np.int64)

    def after(self, cell: np.ndarray) -> np.ndarray:
        """The states that cells (state plus letter) hold, -1 for none."""
        if self.dense:
            return self.table.take(cell)
        at = np.minimum(np.searchsorted(self.cells, cell), len(self.cells) - 1)
        return np.where(self.cells[at] == cell, self.table[at], -1)

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        n, sizes = self.n, np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        codes = self.code[np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)]
        starts, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
        longest = int(sizes[0]) if len(sizes) else 0
        live = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")  # texts longer than each step
        home = np.tile(self.roots, len(texts)).astype(self.table.dtype)
        state, count, step = home.copy(), np.zeros(len(texts) * n, np.int64), 0
        while step < longest and live[step] > FEW:
            k = int(live[step])
            letter = np.repeat(codes[starts[:k] + step], n)
            now = state[: k * n]
            nxt = self.after(now + letter)
            miss = np.flatnonzero(nxt < 0)
            again = self.first[miss % n, letter[miss]]
            count[miss] += (now[miss] != home[miss]).astype(np.int64) + (again < 0)
            nxt[miss] = np.where(again < 0, home[miss], again)
            state[: k * n] = nxt
            step += 1
        for j in range(int(live[step]) if step < longest else 0):  # the last long ones: one by one
            rest = codes[starts[j] + step : starts[j] + sizes[j]]
            for lang in range(n):
                more, state[j * n + lang] = self._one(rest, lang, int(state[j * n + lang]))
                count[j * n + lang] += more
        out = np.empty((len(texts), n), np.int64)
        out[order] = (count + (state != home)).reshape(-1, n)
        return out

    def _one(self, letters: np.ndarray, lang: int, state: int) -> tuple[int, int]:
        """The phrases that end within the letters, and the state after them."""
        root, first, count = int(self.roots[lang]), self.first[lang].tolist(), 0
        table = memoryview(self.table) if self.dense else None
        for at in range(0, len(letters), LONG):
            for c in letters[at : at + LONG].tolist():
                nxt = table[state + c] if table is not None else int(self.after(np.array([state + c]))[0])
                if nxt < 0:
                    count += state != root
                    nxt = first[c]
                    if nxt < 0:
                        count += 1
                        nxt = root
                state = nxt
        return count, state


def running(text: str | None) -> str:
    """Lower-case words of letters, one space apart and one at either end; empty where there is no letter."""
    found = LETTERS.findall(text.lower()) if text else ()
    if not any(c.isalpha() for w in found for c in w):  # superscripts and the like are no letters
        return ""
    return f" {' '.join(found)} "


class Model:
    """Languages and their automata; states are built on first use in a worker."""

    def __init__(self, samples: dict[str, list[str]]):
        samples = {lang: text for lang, pieces in samples.items() if (text := BREAK.join(filter(None, map(running, pieces))))}
        self.langs = sorted(samples)
        self.automata = [SuffixAutomaton(samples[x]) for x in self.langs]
        self.parser = None

    def __getstate__(self):
        return {"langs": self.langs, "automata": self.automata, "parser": None}

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        if self.parser is None:
            self.parser = Parser(self.automata)
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        clean = [running(t) for t in texts] if self.langs else []
        known = [k for k, t in enumerate(clean) if t]
        if not known:
            return names, scores
        counts = self.parser.phrases([clean[k] for k in known])
        for j, k in enumerate(known):
            rates = sorted(zip((counts[j] / len(clean[k])).tolist(), self.langs))
            names[k] = rates[0][1]
            scores[k] = 1.0 if len(rates) == 1 else 1.0 - rates[0][0] / rates[1][0]
        return names, scores


def held_out(id_col: Column) -> Column:
    """crc32(doc_id as text) mod 4 is 2; a null id is read as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_OUT


def train(docs: DataFrame, sample: int = SAMPLE, piece: int = PIECE) -> Model:
    """Learn from text and lang of the rows given.

    A first pass counts languages and pieces; a second one takes, for each
    language, a hash range that should hold twice its sample, and its smallest hash
    in any case; the driver keeps those with the smallest hashes, so what it gets
    is bounded.
    """
    labelled = docs.where("lang IS NOT NULL AND length(text) > 0").select("doc_id", "lang", "text")

    def places(piece: int) -> str:
        return f"transform(sequence(0L, ceil(length(text) / {piece}) - 1), i -> struct(pmod(xxhash64(doc_id, i, 'lid'), 1099511627776L) / 1099511627776D AS u, i AS i))"

    def counted(piece: int) -> DataFrame:
        low = F.array_min(F.transform(F.expr(places(piece)), lambda x: x["u"]))
        return cut(labelled.groupBy("lang").agg(F.sum(F.ceil(F.length("text") / F.lit(piece))).alias("__n"), F.min(low).alias("__low")))

    sizes = counted(piece)
    langs = sizes.count()
    if not langs:
        return Model({})
    if langs * piece > CHARACTERS:
        piece = max(SHORTEST, CHARACTERS // langs)
        sizes = counted(piece)
    sample = max(1, min(sample, CHARACTERS // (langs * piece)))
    share = sizes.select("lang", F.greatest("__low", F.lit(2.0 * sample) / F.col("__n")).alias("__share"))
    drawn = labelled.join(F.broadcast(share) if langs <= BROADCAST_ROWS else share, "lang").select(
        "lang", "text", F.explode(F.expr(f"filter({places(piece)}, x -> x.u <= __share)")).alias("x"))
    rows = drawn.select("lang", "x.u", F.expr(f"substring(text, cast(x.i * {piece} + 1 as int), {piece})").alias("t")).toPandas()
    return Model({lang: g.sort_values(["u", "t"], kind="stable")["t"].head(sample).tolist() for lang, g in rows.groupby("lang")})


def _predicted(spark: SparkSession, docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with __p, a struct of lang_pred and score."""
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample's parameters

    @F.arrow_udf("lang_pred string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in batches:
            names, scores, at = [], [], 0
            ends = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            while at < len(texts):  # few texts at a time are strings beside the batch that holds them
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, side="right")))
                some = model.predict(texts.slice(at, to - at).to_pylist())
                names += some[0]
                scores += some[1]
                at = to
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    # declared so that a filter on the prediction isn't pushed below it, which would parse every text twice
    return docs.withColumn("__p", predict.asNondeterministic()(F.col(text_col)))


def identify(spark: SparkSession, docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return _predicted(spark, docs, model, text_col).select(*kept, "__p.lang_pred", "__p.score")


def accept(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with a language; ``und`` goes. lang becomes the prediction."""
    model = train(docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id"))))
    found = _predicted(spark, docs, model).where("__p.lang_pred != 'und'")
    return found.select(*[F.col("__p.lang_pred").alias("lang") if c == "lang" else F.col(c) for c in docs.columns])


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document of the whole table."""
    docs = load(spark, sf_dir, "documents")
    model = train(docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id"))))
    return identify(spark, docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
