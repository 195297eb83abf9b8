"""Exact percentiles and greedy cooldowns of groups that no task can hold."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators.records import cut

WHOLE = 2_000_000  # rows of a group whose percentiles are computed by one aggregate
LEAST_ACCURACY = 1000


def percentiles(df: DataFrame, by: list[str], value: str, ps: tuple[float, ...], whole: int = WHOLE) -> DataFrame:
    """``by`` and q0, q1, ...: interpolated percentiles of the values that are not null; a group without any has none.

    Groups are counted first. Where all have at most ``whole`` rows one aggregate
    does. Beyond that, percentiles are selected in two passes: a mergeable sketch
    gives, for each group and percentile, two values that the wanted ranks lie
    between, a few parts in ``accuracy`` of all rows apart, however the values are
    spread; what is below is counted, and only what is between is ranked, equal
    values as one row. With ``accuracy`` the root of the largest group, sketch and
    ranked rows stay in proportion to that root.
    """
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("__v"))
    most = rows.groupBy(*by).agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    if most <= whole:
        q = rows.groupBy(*by).agg(F.percentile("__v", F.array(*map(F.lit, ps))).alias("__q"))
        return q.select(*by, *[F.col("__q")[i].alias(f"q{i}") for i in range(len(ps))])
    accuracy = max(LEAST_ACCURACY, math.isqrt(most))
    margin = 3 / accuracy
    ends = [max(0.0, p - margin) for p in ps] + [min(1.0, p + margin) for p in ps]
    s = rows.groupBy(*by).agg(F.count("*").alias("__n"), F.percentile_approx("__v", ends, accuracy).alias("__e"))
    s = cut(s.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(by)], "__n", "__e"))
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    k = len(ps)
    # a null value stands for all rows below a percentile's range; in a group of few rows the range is all of it
    few = F.col("__n") <= 10 * accuracy
    places = F.array(*[
        F.when(few | (F.col("__v") <= F.col("__e")[k + i]), F.struct(F.lit(i).alias("i"), F.when(few | (F.col("__v") >= F.col("__e")[i]), F.col("__v")).alias("v"))) for i in range(k)])
    counts = rows.join(s, same).select(*by, "__n", F.explode(F.array_compact(places)).alias("x")).groupBy(*by, "__n", "x.i", "x.v").agg(F.count("*").alias("c"))
    keys = ", ".join(f"`{c}`" for c in by)
    cum = counts.withColumn("cum", F.expr(f"sum(c) OVER (PARTITION BY {keys}, i ORDER BY v NULLS FIRST)"))
    table = F.array(*map(F.lit, ps))
    rank = table[F.col("i")] * (F.col("__n") - 1)
    q = cum.withColumn("__r", rank).groupBy(*by, "i").agg(
        F.min(F.when(F.col("cum") > F.floor("__r"), F.struct("cum", "v"))).alias("a"), F.min(F.when(F.col("cum") > F.ceil("__r"), F.struct("cum", "v"))).alias("b"), F.max("__r").alias("r"))
    held = F.assert_true(F.col("a.v").isNotNull() & F.col("b.v").isNotNull(), "a percentile lies outside of its sketch's range")
    q = q.withColumn("q", F.coalesce(held.cast("double"), F.when(F.floor("r") == F.col("r"), F.col("a.v")).otherwise(F.col("a.v") * (F.ceil("r") - F.col("r")) + F.col("b.v") * (F.col("r") - F.floor("r")))))
    return q.groupBy(*by).agg(*[F.max(F.when(F.col("i") == i, F.col("q"))).alias(f"q{i}") for i in range(k)])


def next_after(points: DataFrame, by: list[str], at: str, wait: str, block: int) -> DataFrame:
    """``by``, at, next: for each point (a long) the first one of its group at ``at + wait`` or later.

    Points and what they ask for meet in blocks of ``block`` units; a block's
    first point stands for it where an earlier block asks beyond its own.
    """
    keys = ", ".join(f"`{c}`" for c in by)
    both = points.select(*by, F.col(at).alias("x"), F.lit(None).cast("long").alias("asks")).unionByName(
        points.select(*by, (F.col(at) + F.col(wait)).alias("x"), F.col(at).alias("asks"))).withColumn("block", F.expr(f"floor(x / {block})"))
    point = "CASE WHEN asks IS NULL THEN x END"
    near = both.withColumn("near", F.expr(f"min({point}) OVER (PARTITION BY {keys}, block ORDER BY x DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")).where("asks IS NOT NULL")
    # one row a block: the first point of the blocks behind it
    blocks = both.groupBy(*by, "block").agg(F.min(F.expr(point)).alias("first"))
    blocks = blocks.withColumn("far", F.expr(f"min(first) OVER (PARTITION BY {keys} ORDER BY block ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"))
    b = blocks.select(*[F.col(c).alias(f"__b{i}") for i, c in enumerate(by)], F.col("block").alias("__block"), "far")
    same = near["block"] == F.col("__block")
    for i, c in enumerate(by):
        same = same & near[c].eqNullSafe(F.col(f"__b{i}"))
    return near.join(b, same).select(*by, F.col("asks").alias(at), F.coalesce("near", "far").alias("next"))


def greedy(points: DataFrame, by: list[str], at: str, wait: str, block: int, whole: int = WHOLE) -> DataFrame:
    """``by`` and at of the points that are taken: a group's first one, then always the first one at least ``wait`` after the last taken.

    What is taken depends on what was taken before, which no window frame says.
    While every group has at most ``whole`` points a task folds each. Beyond that,
    each point knows the next one that would be taken after it; pointers double
    each round, and the taken ones with them: after k rounds the first 2**k of
    each group. So the rounds grow with the logarithm of the longest chain, and a
    group with all points is spread like any other: rows meet by group and time.
    """
    points = points.select(*by, at, wait).distinct()
    most = points.groupBy(*by).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    if most <= whole:
        kinds = dict(points.dtypes)

        def fold(rows: pa.Table) -> pa.Table:
            order = np.argsort(rows[at].to_numpy(), kind="stable")
            times, i, kept = rows[at].to_numpy()[order], 0, []
            pause = rows[wait][0].as_py()
            while i < len(times):
                kept.append(order[i])
                i = int(np.searchsorted(times, times[i] + pause))
            return rows.select([*by, at]).take(pa.array(kept, pa.int64()))

        return points.groupBy(*by).applyInArrow(fold, ", ".join(f"`{c}` {kinds[c]}" for c in (*by, at)))
    jump = cut(next_after(points, by, at, wait, block).where("next IS NOT NULL"))
    taken = cut(points.groupBy(*by).agg(F.min(at).alias(at)))
    n = taken.count()

    def joined(a: DataFrame, column: str) -> DataFrame:
        b = jump.select(*[F.col(c).alias(f"__j{i}") for i, c in enumerate(by)], F.col(at).alias("__at"), F.col("next").alias("__next"))
        same = a[column] == F.col("__at")
        for i, c in enumerate(by):
            same = same & a[c].eqNullSafe(F.col(f"__j{i}"))
        return a.join(b, same)

    while True:
        taken = cut(taken.unionByName(joined(taken, at).select(*by, F.col("__next").alias(at))))
        now = taken.count()
        if now == n:
            return taken
        n = now
        jump = cut(joined(jump, "next").select(*by, at, F.col("__next").alias("next")))
