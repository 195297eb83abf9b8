"""Operator 11: vector code compression by filtering Lloyd iterations.

Vectors become integers floor(4096 x) and are cut into eight parts; every part
position has a codebook of 16 entries. Each Spark partition builds kd-trees over
its parts once, a block of vectors at a time, with cached boxes, sums and
counts, and writes them to the shared folder. A Lloyd round walks the trees
level by level: at a node the entry nearest to the middle of the box stays, and
every entry that it beats at all corners of the box goes; where one entry is
left the whole subtree is assigned by its cached sum and count, and only leaves
that several entries reach look at points. All arithmetic is in whole numbers,
so ties and floors are exact and do not depend on partitioning.

The driver holds the codebooks (16 numbers a component) and no rows. A round
returns at most 128 sums a task, added up by Spark. The error of a label comes
back to its rows by a join; labels with over a thousandth of all rows, at most
a thousand of them, are broadcast, so that no task gets a hot label's rows.

Defined results: rows whose vector is null or holds null or non-finite
components go; a null vec_id is encoded, and sorts behind all others for the
start; equal vec_ids sort by their vectors; repeated rows count each; fewer
than 16 vectors make smaller codebooks; equal entries leave the later ones
unused; vectors of unequal or indivisible length are filled up with zeros at
the end; integers are held within 2**62 and errors within 2**63 - 1; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import load, remove, written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LEAF = 8  # points of a leaf at most
BLOCK = 16_384  # vectors of a set of trees at most
BLOCK_NUMBERS = 4_000_000  # and their components
MOST = 2**62
LONG = 2**63 - 1
HOT = 1000  # labels with over 1/HOT of all rows are broadcast


def whole(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as int64, held within +-2**62."""
    with np.errstate(over="ignore"):
        y = np.floor(x.astype(np.float64) * scale)
    out = np.clip(y, -float(MOST), float(MOST)).astype(np.int64)
    return out


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as int64 where squared distances fit, else as Python integers."""
    most = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    width = max(a.shape[-1] for a in arrays)
    kind = np.int64 if width * (2 * most + 2) ** 2 < 2**58 else object
    return [a.astype(kind) for a in arrays]


def _narrow(a: np.ndarray) -> np.ndarray:
    """The smallest integer type that holds the values."""
    low, high = (int(a.min()), int(a.max())) if a.size else (0, 0)
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return a.astype(kind)
    return a


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of each point, and its squared distance."""
    points, book = _exact(points, book)
    d = ((points[:, None, :] - book[None]) ** 2).sum(-1)
    at = np.argmin(d, 1)
    return at, d[np.arange(len(at)), at]


class Tree:
    """A balanced kd-tree over integer points: node j of level l has children 2j and 2j + 1 of level l + 1."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        order, bounds = np.arange(n), np.array([0, n])
        self.levels = []
        while True:
            at, starts = points[order], bounds[:-1]
            low, high = np.minimum.reduceat(at, starts), np.maximum.reduceat(at, starts)
            # sums of int64 would wrap for huge components only; they are exact as long as count * 2**62 is not reached
            sums = np.add.reduceat(at.astype(object) if np.abs(at.astype(np.float64)).max() * n >= 2**62 else at.astype(np.int64), starts)
            self.levels.append((bounds, _narrow(low), _narrow(high), sums))
            if np.diff(bounds).min() < 2 * LEAF:
                break
            widest = np.argmax(high - low, 1)
            node = np.repeat(np.arange(len(starts)), np.diff(bounds))
            order = order[np.lexsort((at[np.arange(n), widest[node]], node))]
            middle = (bounds[:-1] + bounds[1:]) // 2
            bounds = np.sort(np.concatenate([bounds, middle]))
        self.order, self.points = order.astype(np.int32), _narrow(points[order])

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """Sum and count of the points of each entry, and whole subtrees as (from, to, entry) where one entry took them.

        Points of mixed leaves are given as subtrees of one point.
        """
        k = len(book)
        big = any(x[3].dtype == object for x in self.levels)
        sums = np.zeros((k, self.points.shape[1]), object if big else np.int64)
        counts, taken = np.zeros(k, np.int64), []
        nodes, alive = np.array([0]), np.ones((1, k), bool)
        for depth, (bounds, low, high, total) in enumerate(self.levels):
            lo, hi, b = _exact(low[nodes], high[nodes], book)
            off = 2 * b[None] - (lo + hi)[:, None]  # twice the way from the middle of the box
            far = (off * off).sum(-1)
            far = np.where(alive, far, far.max() + 1)
            best = np.argmin(far, 1)
            way = b[None] - b[best][:, None]  # from the best entry to each other
            # |z - p|^2 - |best - p|^2 over the box is least at the corner that way points to
            corner = np.where(way > 0, hi[:, None], lo[:, None])
            gain = ((b[None] + b[best][:, None] - 2 * corner) * way).sum(-1)
            beaten = (gain > 0) | ((gain == 0) & (np.arange(k)[None] > best[:, None]))
            alive &= ~beaten
            one = alive.sum(1) == 1
            if one.any():
                entry, done = best[one], nodes[one]
                np.add.at(sums, entry, total[done])
                np.add.at(counts, entry, bounds[done + 1] - bounds[done])
                taken.append((bounds[done], bounds[done + 1], entry))
            nodes, alive = nodes[~one], alive[~one]
            if not len(nodes):
                break
            if depth + 1 == len(self.levels):
                size = bounds[nodes + 1] - bounds[nodes]
                at = np.repeat(bounds[nodes] - np.cumsum(size) + size, size) + np.arange(size.sum())
                entry, _ = nearest(self.points[at], book)
                np.add.at(sums, entry, self.points[at].astype(sums.dtype))
                np.add.at(counts, entry, 1)
                taken.append((at, at + 1, entry))
            else:
                nodes, alive = np.repeat(nodes * 2, 2), np.repeat(alive, 2, 0)
                nodes[1::2] += 1
        return sums, counts, taken

    def codes(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each point, in the order the points were given."""
        n = len(self.points)
        code = np.zeros(n, np.int64)
        for a, b, e in self.assign(book)[2]:
            size = b - a
            code[np.repeat(a - np.cumsum(size) + size, size) + np.arange(size.sum())] = np.repeat(e, size)
        p, bk = _exact(self.points, book)
        error = ((p - bk[code]) ** 2).sum(-1)
        out, err = np.empty(n, np.int64), np.empty(n, error.dtype)
        out[self.order], err[self.order] = code, error
        return out, err


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a list column as a matrix filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), flat.dtype)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _joined(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of ``rows`` rows, the last one of what is left."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            held.append(part)
            n += part.num_rows
            batch = batch.slice(part.num_rows)
            if n == rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def compress(vectors: DataFrame, vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row a kept vector: vec_id, code, error, label_error, codebooks_sha256; ``vectors`` has vec_id, label and the vectors."""
    spark = vectors.sparkSession
    v = F.col(vector_col)
    kept = vectors.where(v.isNotNull()).select("vec_id", "label", v.cast("array<double>").alias("__v"))
    kept = kept.where(F.forall("__v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    longest = kept.agg(F.max(F.size("__v"))).first()[0]
    width = max(1, -(-(longest or 0) // parts)) * parts
    sub = width // parts
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "__v").limit(entries).select("__v").collect()
    books = np.zeros((parts, len(first), sub), np.int64)
    for i, r in enumerate(first):
        books[:, i] = whole(np.array(list(r[0]) + [0.0] * (width - len(r[0])))).reshape(parts, sub)

    def grow(batches):
        for t in _joined(batches, max(1, min(BLOCK, BLOCK_NUMBERS // width))):
            m = whole(_matrix(t["__v"].chunk(0), width))
            trees = [Tree(m[:, p * sub : (p + 1) * sub]) for p in range(parts)]
            one = lambda c: pa.ListArray.from_arrays(pa.array([0, t.num_rows], pa.int32()), t[c].chunk(0))
            yield pa.RecordBatch.from_arrays([one("vec_id"), one("label"), pa.array([pickle.dumps(trees)], pa.binary())], ["ids", "labels", "trees"])

    kind = dict(kept.dtypes)
    trees, tree_path = written(kept.mapInArrow(grow, f"ids array<{kind['vec_id']}>, labels array<{kind['label']}>, trees binary"), "trees")

    def sums_of(books):
        def run(batches):
            total = [[[0] * sub for _ in range(books.shape[1])] for _ in range(parts)]
            count = np.zeros((parts, books.shape[1]), np.int64)
            for batch in batches:
                for blob in batch.column(0):
                    for p, tree in enumerate(pickle.loads(blob.as_py())):
                        s, c, _ = tree.assign(books[p])
                        count[p] += c
                        for e in np.flatnonzero(c):
                            total[p][e] = [x + y for x, y in zip(total[p][e], s[e].tolist())]
            at = [(p, e) for p in range(parts) for e in range(books.shape[1]) if count[p, e]]
            yield pa.RecordBatch.from_pydict({
                "p": pa.array([p for p, _ in at], pa.int32()), "e": pa.array([e for _, e in at], pa.int32()), "n": pa.array([int(count[x]) for x in at], pa.int64()),
                "s": pa.array([list(map(str, total[p][e])) for p, e in at], pa.list_(pa.string()))})
        return run

    for _ in range(rounds if len(first) else 0):
        part = trees.select("trees").mapInArrow(sums_of(books), "p int, e int, n long, s array<string>")
        part = part.select("p", "e", "n", F.posexplode("s").alias("i", "x"))
        books = books.copy()
        for r in part.groupBy("p", "e", "i").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("s")).collect():
            books[r.p, r.e, r.i] = int(r.s) // r.n

    def encode(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                code, error = zip(*(tree.codes(books[p]) for p, tree in enumerate(pickle.loads(batch["trees"][i].as_py()))))
                text = np.array([f"{c:02x}" for c in range(max(1, books.shape[1]))], object)[np.array(code)]
                yield pa.RecordBatch.from_arrays([
                    batch["ids"][i].values, batch["labels"][i].values, pa.array(list(map("".join, text.T)), pa.string()),
                    pa.array([min(LONG, int(sum(e))) for e in zip(*(x.tolist() for x in error))], pa.int64())], ["vec_id", "label", "code", "error"])

    coded, _ = written(trees.mapInArrow(encode, f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long"), "codes")
    remove(spark, tree_path)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return _with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _with_label_errors(coded: DataFrame) -> DataFrame:
    """Add the error summed over equal labels, hot labels by broadcast and the others by a shuffle."""
    sums = coded.groupBy(F.col("label").alias("__l")).agg(F.count("*").alias("__n"), F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    most = max(1, coded.count() // HOT)
    hot = sums.where(F.col("__n") > most).select("__l", "label_error", F.lit(True).alias("__hot"))
    d = coded.join(F.broadcast(hot), coded["label"].eqNullSafe(hot["__l"]), "left").drop("__l")
    cold = sums.where(F.col("__n") <= most).drop("__n")
    rest = d.where("__hot is null").drop("label_error", "__hot")
    rest = rest.join(cold, rest["label"].eqNullSafe(cold["__l"])).drop("__l")
    return d.where("__hot").drop("__hot").unionByName(rest)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of every vector of the whole table."""
    return compress(load(spark, sf_dir, "embeddings"))
