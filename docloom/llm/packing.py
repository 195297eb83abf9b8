"""Operator 1: conflict-constrained best-fit packing.

Documents are cut into pieces of at most ``capacity`` words (a full piece is a
bin of its own) and the pieces packed into bins of that capacity. Two pieces
conflict if they share a duplicate cluster, or if the bin already holds
``per_source`` pieces of the piece's source. Bins are ordered by residual
capacity and carry bitmaps of their clusters and sources; the search starts at
the smallest residual that fits and goes on to the next larger one until it
meets a compatible bin, which is then the tightest there is.

Packing is sequential, so documents are dealt by hash into shards of about
``shard`` rows, packed independently: longest piece first, ties by doc_id. A
shard never grows with the data, whatever its sources or clusters; the price is
a few bins at the end of each shard that are not full. Only ids, word counts,
sources and cluster hashes are shuffled, never texts. Identical rows (a mixture
repeats documents) are one row with a count until each of them is dealt to a
shard by its number, so they never meet in one.

Defined results: a text without words is a piece of zero words and gets a place
like any other; null doc_ids, sources and texts are values like others; a null
cluster conflicts with nothing; repeated rows are packed each; an empty table
gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import load, row_key

CAPACITY = 2048
PER_SOURCE = 4
SHARD = 4096
CHUNK = 65_536  # copies of a row that one array holds while they are dealt


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int, per_source: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece, in the order given; source and cluster are bit numbers, cluster -1 conflicts with nothing."""
    residuals: list[tuple[int, int]] = []  # (residual, bin), ascending
    cluster_bits: list[int] = []
    source_bits: list[list[int]] = []  # one bitmap a level: at level k, sources with more than k pieces
    bins, offsets = [], []
    for size, s, c in zip(sizes, sources, clusters):
        sbit, cbit = 1 << s, (1 << c if c >= 0 else 0)
        at = bisect_left(residuals, (size, -1))
        while at < len(residuals):
            b = residuals[at][1]
            if not cluster_bits[b] & cbit and not source_bits[b][-1] & sbit:
                break
            at += 1
        if at < len(residuals):
            left, b = residuals.pop(at)
        else:
            left, b = capacity, len(cluster_bits)
            cluster_bits.append(0)
            source_bits.append([0] * per_source)
        bins.append(b)
        offsets.append(capacity - left)
        cluster_bits[b] |= cbit
        for k, level in enumerate(source_bits[b]):
            if not level & sbit:
                source_bits[b][k] = level | sbit
                break
        insort(residuals, (left - size, b))
    return bins, offsets


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard: int = SHARD, cluster_col: str | None = None) -> DataFrame:
    """One row a piece: doc_id, source, piece, first_word, n_words, shard, bin, bin_offset.

    ``docs`` has doc_id, text, source; ``cluster_col`` names a long with the
    duplicate cluster, else documents with the same words are one cluster.
    """
    shards = max(1, -(-docs.count() // shard))
    words = F.expr(r"btrim(coalesce(text, ''), ' \t\n\u000B\f\r')")
    d = docs.select(
        "doc_id", "source", words.alias("__w"), row_key("doc_id", "source", "text").alias("__key"),
        (F.col(cluster_col) if cluster_col else F.lit(None)).cast("long").alias("__c"),
    ).select(
        "doc_id", "source", "__key",
        F.expr(r"regexp_count(__w, '[^\\x20\\x09-\\x0D]+')").cast("long").alias("words"),
        (F.col("__c") if cluster_col else F.xxhash64(F.expr(r"regexp_replace(lower(__w), '\\s+', ' ')"))).alias("cluster"),
    ).groupBy("doc_id", "source", "__key", "words", "cluster").agg(F.count("*").alias("__n"))
    zero, chunk = F.lit(0).cast("long"), F.lit(CHUNK).cast("long")
    d = d.withColumn("__from", F.explode(F.sequence(zero, F.col("__n") - 1, chunk)))
    d = d.withColumn("__copy", F.explode(F.sequence(F.col("__from"), F.least(F.col("__n"), F.col("__from") + chunk) - 1))).drop("__n", "__from")
    d = d.withColumn("shard", F.pmod(F.xxhash64("__key", "__copy", F.lit("shard")), F.lit(shards))).drop("__copy")

    def run(rows: pa.Table) -> pa.Table:
        # Arrow columns all the way: a 64-bit id beside a null stays exact
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("doc_id", "ascending"), ("__key", "ascending")], null_placement="at_start"))
        words = rows["words"].to_numpy()
        pieces = np.maximum(1, -(-words // capacity))
        row = np.repeat(np.arange(len(words)), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.where(piece < pieces[row] - 1, capacity, words[row] - capacity * (pieces[row] - 1))
        order = np.argsort(-size, kind="stable")
        source = _numbered(rows["source"])[row[order]]
        cluster = np.where(rows["cluster"].is_valid().to_numpy(), _numbered(rows["cluster"]), -1)[row[order]]
        bins, offsets = best_fit(size[order].tolist(), source.tolist(), cluster.tolist(), capacity, per_source)
        out = rows.take(pa.array(row[order]))
        return pa.table({
            "doc_id": out["doc_id"], "source": out["source"], "piece": piece[order], "first_word": piece[order] * capacity,
            "n_words": size[order], "shard": out["shard"], "bin": pa.array(bins, pa.int64()), "bin_offset": pa.array(offsets, pa.int64()),
        })

    return d.groupBy("shard").applyInArrow(
        run, "doc_id long, source string, piece long, first_word long, n_words long, shard long, bin long, bin_offset long")


def _numbered(column: pa.ChunkedArray) -> np.ndarray:
    """A number from 0 on for each distinct value, null included."""
    return column.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document of the whole table and its place."""
    return pack(load(spark, sf_dir, "documents"))
