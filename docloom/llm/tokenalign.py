"""Operator 12: alignment of two tokenizers' tokens by byte ranges.

Every text is encoded by a byte-level BPE (A) and a piece BPE (B). Per Arrow
batch, DuckDB gets the tokens as interval tables over the running bytes of the
batch: two ASOF joins find, for each token's start, the token of the other
tokenizer that holds it. Every overlapping pair is found once, at the later of
its two starts, and the range condition leaves out what only touches. A window
sum over the places where both end numbers the groups. DuckDB also counts the
pairs of each document and, as partial counts, the documents of each pair in
the batch; Spark merges these into corpus-wide counts.

Texts are encoded once: documents' pairs and partial counts go to one table in
the shared folder. Pair counts are joined back to the documents' pairs; while
they are at most ``BROADCAST_PAIRS`` rows they are broadcast, beyond that only
pairs with over a ten-thousandth of all links are, at most ten thousand of
them, and the others join by a shuffle. The highest count of an A id is a table
of at most the vocabulary's size.

Token offsets of A come from the same vocabulary through its rank form, which
is several times faster; tests hold it against the vocabulary file's own
library. A pair is counted once a row, so repeated rows count each. Null and
empty texts, and those that a tokenizer changes (B's normalisation), have no
tokens; doc_id may be null or repeated; other columns are not read; an empty
table gives an empty table. A single text is held with its tokens in one task.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import load, remove, written

FOLDER = "/opt/tokenizers"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
BATCH = 250_000  # characters whose tokens DuckDB joins at a time; a longer text is a batch of its own
BROADCAST_PAIRS = 1_000_000
HOT = 10_000  # pairs with over 1/HOT of all links are broadcast when there are more pairs than that

# fixed values: the pattern that splits text before the merges of the byte-level vocabulary
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_letter() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 letters stand for themselves, the other bytes for letters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


@lru_cache(maxsize=2)
def tokenizers(folder: str):
    """Both encoders and the bytes of their tokens, once a process."""
    import sentencepiece
    import tiktoken

    with open(os.path.join(folder, BYTE_LEVEL), encoding="utf-8") as f:
        spec = json.load(f)
    letters, special = byte_of_letter(), {t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if i not in special}
    a = tiktoken.Encoding("byte_level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
    a_bytes = [b""] * (max(ranks.values()) + 1)
    for t, i in ranks.items():
        a_bytes[i] = t
    b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, PIECES))
    b_bytes = [
        bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in range(b.get_piece_size())]
    return a, a_bytes, b, b_bytes


def encode(texts: list[str], folder: str = FOLDER) -> list[tuple[list[int], list[int]]]:
    """A's and B's ids of each text; no ids where the joined bytes of either are not those of a space and the text."""
    a, a_bytes, b, b_bytes = tokenizers(folder)
    out = []
    for text, ib in zip(texts, b.encode(texts, num_threads=1)):
        raw = (" " + text).encode()
        if not text or b"".join(map(b_bytes.__getitem__, ib)) != raw:
            out.append(([], []))
            continue
        ia = a.encode_ordinary(" " + text)
        out.append((ia, ib) if b"".join(map(a_bytes.__getitem__, ia)) == raw else ([], []))
    return out


LINKS = """
CREATE OR REPLACE TEMP TABLE links AS
SELECT a.d, a.id AS a, b.id AS b, a.s AS x, true AS opens_a, a.s = b.s AS opens_b, a.e = b.e AS both_end FROM a ASOF JOIN b ON a.s >= b.s
UNION ALL
SELECT b.d, a.id, b.id, b.s, false, true, a.e = b.e FROM b ASOF JOIN a ON b.s > a.s WHERE b.s < a.e
"""
# the second branch meets a B token that starts where an A token starts at that A token's predecessor, which ends there: WHERE drops it
GROUPS = """
SELECT x, d, a, b, opens_a, opens_b, both_end,
  coalesce(sum(both_end::INT) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS g
FROM links
"""
PAIRS = "CREATE OR REPLACE TEMP TABLE pairs AS SELECT d, a, b, count(*)::INT AS n FROM links GROUP BY ALL"


def _digests(links: dict[str, np.ndarray], docs: int, names: list[np.ndarray]) -> list[str]:
    """SHA-256 of each document's groups, from its links in the order of their places."""
    a, b = links["opens_a"], links["opens_b"]
    key = np.concatenate([links["g"][a] * 2, links["g"][b] * 2 + 1])
    order = np.argsort(key, kind="stable")
    key = key[order]
    ids = np.concatenate([links["a"][a], links["b"][b]])[order]
    doc = np.concatenate([links["d"][a], links["d"][b]])[order]
    after = np.zeros(len(key), np.int64)  # 0: the next token is of the same half of a group
    after[:-1] = np.where(key[1:] == key[:-1], 0, 1 + key[:-1] % 2)
    size = len(names[0])
    parts = np.concatenate(names)[after * size + ids].tolist()
    at = np.searchsorted(doc, np.arange(docs + 1)).tolist()
    return [hashlib.sha256("".join(parts[i:j])[:-1].encode()).hexdigest() if i < j else "" for i, j in zip(at, at[1:])]


def align(con, tokens: list[tuple[list[int], list[int]]], a_len: np.ndarray, b_len: np.ndarray, names: list[np.ndarray]) -> tuple[list[tuple], pa.Table, pa.Table]:
    """Of one batch: (n_groups, n_links, groups_sha256) a document, (d, a[], b[], n[]) of documents with tokens, and (a, b, documents)."""
    def intervals(side: int, lengths: np.ndarray) -> pa.Table:
        ids = np.fromiter((i for t in tokens for i in t[side]), np.int32)
        end = np.cumsum(lengths[ids])
        end = end.astype(np.int32) if not len(end) or end[-1] < 2**31 else end  # half the width, a third less time
        doc = np.repeat(np.arange(len(tokens), dtype=np.int32), [len(t[side]) for t in tokens])
        return pa.table({"d": doc, "id": ids, "s": end - lengths[ids].astype(end.dtype), "e": end})

    con.register("a", intervals(0, a_len))
    con.register("b", intervals(1, b_len))
    con.execute(LINKS)
    con.execute(PAIRS)
    links = con.execute(GROUPS).fetchnumpy()
    order = np.argsort(links["x"], kind="stable")  # nearly sorted as it comes
    links = {c: v[order] for c, v in links.items()}
    n_links = np.bincount(links["d"], minlength=len(tokens)).tolist()
    n_groups = np.bincount(links["d"], weights=links["both_end"], minlength=len(tokens)).astype(int).tolist()
    of_docs = con.sql("SELECT d, list(a) AS a, list(b) AS b, list(n) AS n FROM pairs GROUP BY d").to_arrow_table()
    partial = con.sql("SELECT a, b, count(*)::INT AS n FROM pairs GROUP BY ALL").to_arrow_table()
    return list(zip(n_groups, n_links, _digests(links, len(tokens), names))), of_docs, partial


# rows with a row number are documents with their pairs; the others are partial counts of a batch: n documents hold the pair (a, b)
TABLE = "row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a array<int>, b array<int>, n array<int>"


def token_links(docs: DataFrame, folder: str = FOLDER, batch: int = BATCH) -> DataFrame:
    """The rows of ``TABLE`` for the documents, encoded and joined batch by batch."""
    kind = dict(docs.dtypes)["doc_id"]
    ints = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        _, a_bytes, _, b_bytes = tokenizers(folder)
        a_len, b_len = (np.array(list(map(len, x)), np.int64) for x in (a_bytes, b_bytes))
        names = [np.array([f"{i}{end}" for i in range(max(len(a_bytes), len(b_bytes)))], object) for end in ",|;"]
        row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40

        def rows(ids: pa.Array, texts: list[str], row: int) -> pa.RecordBatch:
            tokens = encode(texts, folder)
            facts, of_docs, partial = align(con, tokens, a_len, b_len, names)
            pairs = {d: i for i, d in enumerate(of_docs["d"].to_pylist())}
            at = pa.array([pairs.get(i) for i in range(len(texts))], pa.int64())
            lists = [of_docs[c].combine_chunks().cast(ints).take(at) for c in "abn"]
            some = partial.num_rows > 0
            whole = [pa.ListArray.from_arrays(pa.array([0, partial.num_rows], pa.int32()), partial[c].combine_chunks().cast(pa.int32())) for c in "abn"] if some else []
            facts_of = lambda i: pa.array([f[i] for f in facts] + [None] * some, pa.string() if i == 2 else pa.int64())
            sizes = lambda side: pa.array([len(t[side]) for t in tokens] + [None] * some, pa.int64())
            both = [pa.concat_arrays([x, y]) for x, y in zip(lists, whole)] if some else lists
            return pa.RecordBatch.from_arrays(
                [pa.array([row + i for i in range(len(texts))] + [None] * some, pa.int64()), pa.concat_arrays([ids, pa.nulls(int(some), ids.type)]),
                 sizes(0), sizes(1), facts_of(0), facts_of(1), facts_of(2), *both],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "n"])

        for data in batches:
            texts = data["text"].to_pylist()
            start = size = 0
            for i, text in enumerate(texts):
                size += len(text or "")
                if size >= batch or i + 1 == len(texts):
                    yield rows(data["doc_id"].slice(start, i + 1 - start), [t or "" for t in texts[start : i + 1]], row)
                    row, start, size = row + i + 1 - start, i + 1, 0

    return docs.select("doc_id", "text").mapInArrow(run, TABLE.format(kind=kind))


def alignments(docs: DataFrame, folder: str = FOLDER, broadcast_pairs: int = BROADCAST_PAIRS, batch: int = BATCH) -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    table, path = written(token_links(docs, folder, batch), "links")
    pair = lambda d: d.withColumn("__x", F.explode_outer(F.arrays_zip("a", "b", "n"))).drop("a", "b", "n").select("*", "__x.*").drop("__x")
    counts = pair(table.where("row is null").select("a", "b", "n")).groupBy("a", "b").agg(F.sum("n").alias("count"))
    counts, count_path = written(counts, "counts")
    best = counts.groupBy("a").agg(F.max("count").alias("most"))  # a row an id of A: never more than the vocabulary
    counts = counts.join(F.broadcast(best), "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))
    links = pair(table.where("row is not null"))
    facts = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    if counts.count() <= broadcast_pairs:
        joined = links.join(F.broadcast(counts), ["a", "b"], "left")
    else:
        most = counts.agg(F.sum("count")).first()[0] // HOT
        hot = counts.where(F.col("count") > most).select("a", "b", F.col("count").alias("hot_count"), F.col("best").alias("hot_best"))
        seen = links.join(F.broadcast(hot), ["a", "b"], "left")
        done = seen.where("hot_count is not null or a is null").select(*facts, "n", F.col("hot_count").alias("count"), F.col("hot_best").alias("best"))
        rest = seen.where("hot_count is null and a is not null").join(counts.where(F.col("count") <= most), ["a", "b"]).select(*facts, "n", "count", "best")
        joined = done.unionByName(rest)
    result = joined.groupBy(*facts).agg(
        F.coalesce(F.sum(F.when(F.col("best"), F.col("n"))), F.lit(0)).cast("long").alias("n_best"),
        F.coalesce(F.sum(F.col("n") * F.col("count")), F.lit(0)).cast("long").alias("count_sum"))
    result, _ = written(result.drop("row"), "alignment")
    remove(spark, path)
    remove(spark, count_path)
    return result.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignment of every document of the whole table."""
    return alignments(load(spark, sf_dir, "documents"))
