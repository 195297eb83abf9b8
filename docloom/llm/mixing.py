"""Operator 8: mixing sources to target weights by Poisson replication.

A source that should make up ``weight`` of a mixture of the corpus's size, and
holds n of its N rows, is repeated weight * N / n times on average. A document
takes a uniform number from a hash of the seed and its identity (id, source and
text), inverts the Poisson distribution with that mean, and is exploded by the
count it gets. The copies are then shuffled globally: range-partitioned and
sorted by a hash of seed, document and copy, which no two copies share. Nothing
depends on partitioning or order of the input, so a lost executor recomputes
the same rows.

Rows of one identity are found by a narrow count first. Those that are alike in
all columns become one row with a mean as many times as high, map side first, so
that neither one draw decides on all of them nor one task gets them; those that
differ in other columns draw with these added to their identity.

The rate table has a row a source. It is broadcast only while it is known to
have at most ``BROADCAST_ROWS`` rows; beyond that the join shuffles, and AQE
splits the partition of a source that holds a third of all rows. Source counts
are pre-aggregated; the driver sees their number, sum and largest rate only. A
rare source at a high rate is drawn in pieces and its copies are made in chunks.

Defined results: a null source is a source of its own; n identical rows are one
document that is repeated n times as often, with one n_copies; documents that
share an id, or have none, draw each for themselves; a text column may be
missing; documents whose count is zero go, which is what the weights ask
for; an empty table gives an empty table; other columns stay, whatever their
names: where one is called like a column this adds, the added one's name ends
in an underscore.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import cut, load

SEED = 17
BROADCAST_ROWS = 100_000
PIECE = 256  # the largest mean that is inverted in one go
CHUNK = 65_536  # copies of a document that one row is exploded into


def uniform(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) from the first 13 hex digits of an MD5."""
    text = F.concat_ws("\x1f", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def identity(id_col: str, source_col: str, text_col: str | None) -> Column:
    """Id, source and the digest of the text of a row in one string."""
    parts = [F.col(id_col).cast("string"), F.col(source_col).cast("string"), *([F.md5(text_col)] if text_col else [])]
    return F.concat_ws("\x1f", *[F.coalesce(c, F.lit("\x00")) for c in parts])


def together(docs: DataFrame, rest: list[str]) -> tuple[DataFrame, int]:
    """``docs`` with __who made unique: rows alike in __who and in ``rest`` are one, with their number __n; and the largest such number."""
    key = F.unhex(F.md5("__who"))
    again = cut(docs.groupBy(key.alias("__key")).agg(F.count("*").alias("__times")).where("__times > 1"))
    rows, most = again.agg(F.count("*"), F.coalesce(F.max("__times"), F.lit(1))).first()
    docs = docs.withColumn("__n", F.lit(1).cast("long"))
    if not rows:
        return docs, 1
    again = again.select("__key", F.lit(True).alias("__again"))
    found = docs.withColumn("__key", key).join(F.broadcast(again) if rows <= BROADCAST_ROWS else again, "__key", "left")
    others = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest])) if rest else F.lit("")
    alike = found.where("__again").withColumn("__others", F.md5(others)).groupBy("__key", "__others").agg(
        F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("__row"), F.count("*").alias("__m"))
    alike = alike.select("__row.*", "__others", "__m").withColumn("__who", F.concat_ws("\x1f", "__who", "__others")).withColumn("__n", F.col("__m")).drop("__others", "__m")
    return found.where("__again IS NULL").select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(alike), most


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, source_col: str = "source", size: float = 1.0) -> tuple[DataFrame, int, float]:
    """A table of __src, __rate (mean repetitions of each source), the number of its rows, and the largest rate.

    Without ``weights`` all sources weigh the same; sources that ``weights``
    does not name get weight 0. ``size`` is the mixture's size over the corpus's.
    """
    n = cut(docs.groupBy(F.col(source_col).alias("__src")).agg(F.count("*").alias("__n")))
    total, sources = n.agg(F.coalesce(F.sum("__n"), F.lit(0)), F.count("*")).first()
    if weights is None:
        share = F.lit(1.0 / max(1, sources))
    else:
        all_w = float(sum(weights.values()))
        share = F.lit(0.0)
        for name, w in weights.items():
            share = F.when(F.col("__src").eqNullSafe(F.lit(name)), w / all_w).otherwise(share)
    r = n.select("__src", (share * F.lit(float(total)) * F.lit(float(size)) / F.col("__n")).alias("__rate"))
    return r, sources, r.agg(F.coalesce(F.max("__rate"), F.lit(0.0))).first()[0]


def poisson(rate: Column, u: Column) -> Column:
    """The smallest k whose cumulative probability exceeds u; the search ends ``_reach`` past the mean."""
    return F.aggregate(
        F.sequence(F.lit(0), F.ceil(_reach(rate, F.sqrt(rate))).cast("int")),
        F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.lit(0).alias("k")),
        lambda a, i: F.when(u < a["c"], a).otherwise(
            F.struct((a["p"] * rate / (i + 1)).alias("p"), (a["c"] + a["p"] * rate / (i + 1)).alias("c"), (a["k"] + 1).alias("k"))),
        lambda a: a["k"],
    )


def _reach(rate, deviation):
    return rate + 12 * deviation + 20


def count_of(rate: Column, seed: int, *cols: Column) -> Column:
    """Repetitions of a row: a sum of Poisson numbers whose means are at most ``PIECE``, so that exp(-mean) is never zero."""
    pieces = F.greatest(F.lit(1), F.ceil(rate / F.lit(float(PIECE))).cast("int"))
    draws = F.transform(F.sequence(F.lit(0), pieces - 1), lambda i: F.when(i == 0, uniform(seed, *cols)).otherwise(uniform(seed, *cols, i)))
    return F.aggregate(draws, F.lit(0).cast("long"), lambda n, u: n + poisson(rate / pieces, u))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, size: float = 1.0, seed: int = SEED,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", partitions: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """The columns of ``docs`` and copy, n_copies, mix_key, in the mixture's order."""
    have, added = {c.lower() for c in docs.columns}, {}
    for name in ("copy", "n_copies", "mix_key"):
        added[name] = name
        while added[name] in have:
            added[name] += "_"
    r, sources, most = rates(docs, weights, source_col, size)
    if sources <= BROADCAST_ROWS:
        r = F.broadcast(r)
    text_col = text_col if text_col.lower() in have else None
    rest = [c for c in docs.columns if c.lower() not in {x.lower() for x in (id_col, source_col, text_col) if x}]
    d, times = together(docs.withColumn("__who", identity(id_col, source_col, text_col)), rest)
    d = d.join(r, d[source_col].eqNullSafe(F.col("__src"))).drop("__src")
    d = d.withColumn("__n_copies", count_of(F.col("__rate") * F.col("__n"), seed, F.col("__who"))).drop("__rate", "__n").where("__n_copies > 0")
    most *= times
    if _reach(most, math.sqrt(most)) * 2 <= chunk:
        d = d.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n_copies") - 1)))
    else:
        # a rare source repeats a document very often: its copies are dealt over tasks in chunks, before they are made
        few = d.where(F.col("__n_copies") <= chunk).withColumn("__from", F.lit(0).cast("long"))
        many = d.where(F.col("__n_copies") > chunk).withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n_copies") - 1, F.lit(chunk).cast("long"))))
        many = many.repartition(F.xxhash64("__who", "__from"))
        last = F.least(F.col("__n_copies"), F.col("__from") + chunk) - 1
        d = few.unionByName(many).withColumn("__copy", F.explode(F.sequence(F.col("__from"), last))).drop("__from")
    key = F.md5(F.concat_ws("\x1f", F.lit(f"order {seed}"), "__who", F.col("__copy").cast("string")))
    d = d.withColumn("__mix_key", F.substring(key, 1, 16))
    return d.repartitionByRange(*([partitions] if partitions else []), "__mix_key").sortWithinPartitions("__mix_key").select(*docs.columns, *[F.col(f"__{n}").alias(x) for n, x in added.items()])


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table mixed so that all sources weigh the same, with texts."""
    return mix(load(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "text", "copy", "n_copies", "mix_key")


ORACLE = f"""
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, 1.0::DOUBLE / (SELECT count(*) FROM n) * (SELECT sum(n) FROM n)::DOUBLE * 1.0::DOUBLE / n AS rate FROM n),
w AS (SELECT *, coalesce(doc_id::VARCHAR, chr(0)) || chr(31) || coalesce(source, chr(0)) || chr(31) || coalesce(md5(text), chr(0)) AS who FROM documents),
u AS (SELECT d.*, rate, ('0x' || substr(md5('{SEED}' || chr(31) || who), 1, 13))::BIGINT / {float(1 << 52)}::DOUBLE AS u
      FROM w d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
cdf AS (SELECT source, k, sum(pk) OVER (PARTITION BY source ORDER BY k) AS below
  FROM (SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS pk FROM r, range(0, ceil(rate + 12 * sqrt(rate) + 20)::BIGINT) AS t(k))),
c AS (SELECT u.*, (SELECT count(*) FROM cdf x WHERE x.source IS NOT DISTINCT FROM u.source AND x.below <= u.u) AS n_copies FROM u),
e AS (SELECT *, unnest(range(n_copies)) AS copy FROM c)
SELECT doc_id, source, lang, text, copy, n_copies, substr(md5('order {SEED}' || chr(31) || who || chr(31) || copy), 1, 16) AS mix_key FROM e
"""
