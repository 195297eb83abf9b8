"""Helpers shared by the operators: row identity, cutting lineage, link graphs."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def row_key(*cols: str) -> Column:
    """A 64-bit identity of a row's content; it survives recomputation on another executor."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols])


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines of the cluster share: that of ``spark.checkpoint.dir``, or of the context.

    A local session that names none (tests, laptops) gets a temporary folder
    once; on a cluster the absence of the setting is an error, since executors
    would write to their own disks.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="docloom-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


_left: dict[str, SparkSession] = {}  # tables that results still read


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows from a Parquet table written to the shared folder once, and its path: smaller than a checkpoint, and read by column.

    Whoever is done with it calls ``remove``; tables that results still read go
    when the driver's process ends.
    """
    path = f"{shared_folder(df.sparkSession)}/docloom-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path, compression="zstd")
    _left[path] = df.sparkSession
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``written`` made, on whatever file system it is."""
    _left.pop(path, None)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at.getParent(), True)


@atexit.register
def _remove_left() -> None:
    for path, spark in list(_left.items()):
        with contextlib.suppress(Exception):  # the session may be stopped, and its folder gone
            if spark.sparkContext._jsc is not None:
                remove(spark, path)


BLOCK = 128


def starts(hits: str, gap: str, hit: str) -> str:
    """SQL of an array of int: where each of ``hits`` starts, in units of the SQL ``gap`` and ``hit``.

    ``gap`` and ``hit`` give the length of what stands before hit i and of the
    hit itself. An array is copied when it grows, so sums are kept in blocks of
    ``BLOCK`` and the blocks put together: linear in the number of hits.
    """
    n = f"size({hits})"
    block = (
        f"aggregate(sequence(b, least(b + {BLOCK}, {n}) - 1), struct(0 as at, cast(array() as array<int>) as s),"
        f" (a, i) -> struct(a.at + {gap} + {hit} as at, array_append(a.s, a.at + {gap}) as s))")
    offsets = "aggregate(bs, struct(0 as at, cast(array() as array<int>) as s), (a, x) -> struct(a.at + x.at as at, array_append(a.s, a.at) as s)).s"
    joined = f"transform(array(struct(bs as bs, {offsets} as os)), y -> flatten(transform(y.bs, (x, k) -> transform(x.s, v -> v + y.os[k]))))[0]"
    return (
        f"if({hits} is null or {n} = 0, cast(array() as array<int>),"
        f" transform(array(transform(sequence(0, {n} - 1, {BLOCK}), b -> {block})), bs -> {joined})[0])")


def reached(ends: str) -> str:
    """SQL of an array of int: for each of ``ends`` the greatest of those before it, 0 for the first; in blocks like ``starts``."""
    block = f"aggregate(slice(es, b + 1, {BLOCK}), struct(0 as at, cast(array() as array<int>) as s), (a, e) -> struct(greatest(a.at, e) as at, array_append(a.s, a.at) as s))"
    offsets = "aggregate(bs, struct(0 as at, cast(array() as array<int>) as s), (a, x) -> struct(greatest(a.at, x.at) as at, array_append(a.s, a.at) as s)).s"
    joined = f"transform(array(struct(bs as bs, {offsets} as os)), y -> flatten(transform(y.bs, (x, k) -> transform(x.s, v -> greatest(v, y.os[k])))))[0]"
    return (
        f"transform(array({ends}), es -> if(size(es) = 0, cast(array() as array<int>),"
        f" transform(array(transform(sequence(0, size(es) - 1, {BLOCK}), b -> {block})), bs -> {joined})[0]))[0]")


def forest(n: int, u: np.ndarray, v: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Union the links (u, v) over nodes 0..n-1 that ``label`` may join already: label[i] becomes the smallest node joined to i."""
    label = np.arange(n) if label is None else label
    while True:
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            return label
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            nxt = label[label]
            if (nxt == label).all():
                break
            label = nxt


def spanning(label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One link for each node that is not the smallest of its group: fewer links than nodes."""
    i = np.flatnonzero(label != np.arange(len(label)))
    return label[i], i


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    Returns (node, root) for every node with a link to another; root is the
    smallest node of the component. Nothing is gathered on the driver but two
    numbers a round. A star centre with very many leaves meets its minimum by
    partial aggregation, and the join that follows can be split by AQE.
    """
    e = cut(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    mark = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = cut(small.select("x.u", "x.v").where("u != v").distinct())
        now = tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
        if now == mark or now[0] == 0:
            break
        mark = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of an input directory, by a path that only Spark may be able to read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
