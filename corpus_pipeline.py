"""Corpus pipeline: documents through five operators of subpackage llm.

language ID (texts without a language go), SimHash near-dedup (one document of
each group stays), secret scans (live-looking credentials are replaced, every
document stays), mixing (documents are repeated to equal source weights),
best-fit packing (every piece gets a place in a training sequence).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.llm import langid, mixing, packing, secretscan, simhash
from docloom.llm.common import load, remove, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language stay; lang becomes the prediction. Null and letterless texts go; a repeated row stays repeated; other columns stay."""
    return langid.accept(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: that with the smallest doc_id. Rows without an id count, and one stays of a component of such rows; repeated rows are one document."""
    return simhash.keep_one(spark, docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; owner-specific, live-looking credentials in their texts are replaced, and n_chars follows. A null text or source is left as it is."""
    return secretscan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that sources weigh the same; shuffled globally. A null source is a source; columns with the names of added ones stay."""
    return mixing.mix(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document; a document without words has one piece of no words."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack),
]

#: Suffix automata, SimHash components and best-fit packing are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written as Parquet in the shared folder and read again.

    A stage's table goes once the next one is written; that of the last but one
    stays, since the result is read from it. An empty table gives an empty result.
    """
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, path = written(stage(spark, docs, sf_dir), name)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
