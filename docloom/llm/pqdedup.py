"""Operator 6: embedding near-dedup by product quantisation.

Distinct vectors of one label and dimension are unit-normalised and cut in two
halves. Each half has its own coarse centroids, and a vector is filed under the
nearest one of either half (inverted lists, two a vector); what its centroids
leave of it, the residual, is coded in subspaces. Two vectors within the radius
of the threshold are within radius / sqrt(2) in one of the halves, so a query
probes, in each half, the lists that can hold a vector within that smaller
radius: a list is skipped only if the bisector between its centroid and the
query's lies farther away, or all that it holds is too close to its centre. So
the probes are sufficient, not sampled. In a list the asymmetric distance (query
exact, stored vector coded) comes from lookup tables; a stored vector passes if
that distance is at most the radius plus its own coding error, which loses
nothing by the triangle inequality. What passes is ranked again by exact cosine
in double precision.

Of two lists of a half only the later one is probed from the earlier, and a pair
counts in the first half it is close in: each pair is met once. Lists are in
proportion to the vectors, so the comparisons a vector needs don't grow with
their number while there are at most ``LISTS`` lists.

Centroids and codebooks are fitted on at most ``sample`` distinct vectors and
``SAMPLE_VALUES`` numbers, those with the smallest content hashes; every vector
is indexed. Lists over ``block`` vectors are dealt over several tasks, so a label
or a cluster that holds a third of all rows lands in no single task. Links leave
a task as counts and as a spanning forest, never as pairs. Vectors are shuffled
in the type of their column.

Defined results: a vector that is null, empty, zero or holds null or non-finite
components, or whose label is null, links with nothing and is its own component;
copies of a vector count as links; repeated rows are vectors of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import components, cut, forest, load, spanning

COSINE = 0.98
SAMPLE = 20_000
BLOCK = 4096
SUBSPACES = 8
CODEWORDS = 64
SAMPLE_VALUES = 1 << 22
LIST = 128  # vectors of a label that a list should hold
LISTS = 4096
SLACK = 1e-5  # float32 rounding of tables and distances


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced rows; an empty centre keeps its place."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)
        total, count = np.zeros_like(c), np.bincount(near, minlength=len(c))
        np.add.at(total, near, x)
        c[count > 0] = total[count > 0] / count[count > 0, None]
    return c


def unit(rows: list, dim: int) -> np.ndarray:
    x = np.asarray(rows, dtype=np.float64).reshape(len(rows), dim)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])  # by a power of two: exact, and squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Codec:
    """Coarse centroids of the halves and residual codebooks of one dimension."""

    def __init__(self, x: np.ndarray, lists: int):
        self.dim = x.shape[1]
        cut = -(-self.dim // 2)
        self.halves = [(0, cut), (cut, self.dim)] if self.dim > 1 else [(0, 1)]
        self.m = min(SUBSPACES, self.dim)
        self.width = -(-self.dim // self.m)
        x = x.astype(np.float32)
        self.coarse = [kmeans(x[:, a:b], lists) for a, b in self.halves]
        homes = [self.distances(x, h).argmin(1) for h in range(len(self.halves))]
        rest = self.pad(x - self.centres(homes))
        self.books = [kmeans(rest[:, s], CODEWORDS) for s in range(self.m)]
        self.gaps = None

    def pad(self, r: np.ndarray) -> np.ndarray:
        out = np.zeros((len(r), self.m * self.width), dtype=np.float32)
        out[:, : self.dim] = r
        return out.reshape(len(r), self.m, self.width)

    def distances(self, x: np.ndarray, half: int) -> np.ndarray:
        """Squared distances to the coarse centroids of a half."""
        (a, b), c = self.halves[half], self.coarse[half]
        y = x[:, a:b]
        return np.maximum(0, (y * y).sum(1)[:, None] + (c * c).sum(1) - 2 * y @ c.T)

    def centres(self, homes: list[np.ndarray]) -> np.ndarray:
        return np.concatenate([c[h] for c, h in zip(self.coarse, homes)], axis=1)

    def encode(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the length of the error each leaves."""
        r = self.pad(rest)
        codes, err = np.zeros((len(r), self.m), dtype=np.uint8), np.zeros(len(r))
        for s, book in enumerate(self.books):
            codes[:, s] = np.argmin((book * book).sum(1) - 2 * r[:, s] @ book.T, axis=1)
            err += ((r[:, s] - book[codes[:, s]]) ** 2).sum(1)
        return codes, np.sqrt(err)

    def probes(self, d: np.ndarray, home: np.ndarray, half: int, radius: float) -> np.ndarray:
        """Mask of the lists of a half, from a vector's own on, that can hold a vector within the radius."""
        if self.gaps is None:  # on first use in a worker
            self.gaps = []
            for c in self.coarse:
                c = c.astype(np.float64)
                s = (c * c).sum(1)
                self.gaps.append(np.sqrt(np.maximum(0, s[:, None] + s - 2 * c @ c.T)))
        near = d - d[np.arange(len(d)), home][:, None] <= 2 * (radius + SLACK) * self.gaps[half][home] + SLACK
        return near & (np.arange(d.shape[1]) >= home[:, None])


def usable() -> str:
    return (
        "label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0"
        " AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
        " AND exists(embedding, x -> x <> 0)"
    )


def link_vectors(spark: SparkSession, vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, block: int = BLOCK, lists: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors(vec_id, embedding, label)``."""
    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    key = F.xxhash64("label", "embedding")
    rows = vectors.select("vec_id", "label", "embedding", F.expr(usable()).alias("ok"))
    number = np.float32 if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else np.float64
    typed = "array<float>" if number is np.float32 else "array<double>"
    good = rows.where("ok").withColumn("cid", key)
    classes = cut(
        good.groupBy("cid", "label", F.col("embedding").cast(typed).alias("embedding"))
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("mult"))
        .withColumn("dim", F.size("embedding"))
    )
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    most, widest = sizes.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.max("dim"), F.lit(1))).first()
    bound = max(1, min(sample, SAMPLE_VALUES // widest))
    train = classes.select("dim", "embedding").orderBy("cid").limit(bound).toPandas() if most else pd.DataFrame({"dim": []})
    lists = int(np.clip(most // LIST, 1, LISTS)) if lists is None else lists
    codecs = {int(d): Codec(unit(list(g["embedding"]), int(d)), lists) for d, g in train.groupby("dim")}
    # a dimension too rare for the sample has one list and a one-word codebook
    for d in [r[0] for r in classes.select("dim").distinct().collect()]:
        codecs.setdefault(int(d), Codec(np.eye(1, int(d)), 1))
    shared = spark.sparkContext.broadcast(codecs)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = max(1, (1 << 20) // lists)
        for pdf in (b[k : k + step] for b in batches for k in range(0, len(b), step)):
            for (dim, ), g in pdf.groupby(["dim"]):
                codec = shared.value[int(dim)]
                x = unit(list(g["embedding"]), int(dim)).astype(np.float32)
                far = [codec.distances(x, h) for h in range(len(codec.halves))]
                homes = [d.argmin(1) for d in far]
                codes, err = codec.encode(x - codec.centres(homes))
                base = dict(cid=g["cid"].to_numpy(), label=g["label"].to_numpy(), dim=int(dim), mult=g["mult"].to_numpy())
                vec = pd.Series([np.asarray(v, dtype=number).tobytes() for v in g["embedding"]], dtype=object)
                code = [h.tobytes() + c.tobytes() for h, c in zip(np.stack(homes, 1).astype(np.int32), codes)]
                for h, d in enumerate(far):
                    yield pd.DataFrame(base | dict(half=h, list=homes[h], stored=True, own=True, err=err, code=code, vec=vec))
                    q, c = np.nonzero(codec.probes(d, homes[h], h, radius / np.sqrt(len(codec.halves))))
                    yield pd.DataFrame({k: (v[q] if isinstance(v, np.ndarray) else v) for k, v in base.items()} | dict(
                        half=h, list=c, stored=False, own=c == homes[h][q], err=0.0, code=None, vec=vec.to_numpy()[q]))

    routed = classes.select("cid", "label", "dim", "mult", "embedding").mapInPandas(
        route, "cid long, label int, dim int, mult long, half int, list int, stored boolean, own boolean, err double, code binary, vec binary")
    routed = cut(routed)
    place = ["label", "dim", "half", "list"]
    blocks = routed.groupBy(*place).agg(
        F.greatest(F.lit(1), F.ceil(F.count_if("stored") / F.lit(block))).cast("int").alias("s_blocks"),
        F.greatest(F.lit(1), F.ceil(F.count_if(~F.col("stored")) / F.lit(block))).cast("int").alias("q_blocks"),
        F.count_if("stored").alias("held"),
    ).where("held > 0").drop("held")
    dealt = (
        routed.join(blocks, place)
        .withColumn("at", F.pmod(F.xxhash64("cid"), F.when(F.col("stored"), F.col("s_blocks")).otherwise(F.col("q_blocks"))).cast("int"))
        .withColumn("facing", F.explode(F.sequence(F.lit(0), F.when(F.col("stored"), F.col("q_blocks")).otherwise(F.col("s_blocks")) - 1)))
        .withColumn("sb", F.when(F.col("stored"), F.col("at")).otherwise(F.col("facing")))
        .withColumn("qb", F.when(F.col("stored"), F.col("facing")).otherwise(F.col("at")))
    )

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        dim, half = int(pdf["dim"].iat[0]), int(pdf["half"].iat[0])
        codec, s, q = shared.value[dim], pdf[pdf["stored"]], pdf[~pdf["stored"]]
        empty = pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64), "n": np.empty(0, np.int64)})
        if s.empty or q.empty:
            return empty
        near2 = (radius * radius + 1e-9) / len(codec.halves)  # a pair within the radius is that close in a half
        g = len(codec.halves)
        packed = np.frombuffer(b"".join(s["code"]), np.uint8).reshape(len(s), 4 * g + codec.m)
        homes, codes = np.ascontiguousarray(packed[:, : 4 * g]).view(np.int32), packed[:, 4 * g :]
        y, x = (unit([np.frombuffer(v, number) for v in z["vec"]], dim) for z in (s, q))
        sid, qid, own = s["cid"].to_numpy(), q["cid"].to_numpy(), q["own"].to_numpy()
        smult, qmult = s["mult"].to_numpy(), q["mult"].to_numpy()
        ids, inv = np.unique(np.concatenate((qid, sid)), return_inverse=True)
        qi, si = inv[: len(qid)], inv[len(qid) :]
        bound = ((radius + s["err"].to_numpy() + SLACK) ** 2).astype(np.float32) + SLACK
        # distance = coarse parts + code parts that depend on the query + what the stored vector has alone
        used = [np.unique(homes[:, h], return_inverse=True) for h in range(g)]
        words = codec.pad(codec.centres([homes[:, h] for h in range(g)]))
        alone = sum((2 * words[:, m] * book[codes[:, m]] + book[codes[:, m]] ** 2).sum(1) for m, book in enumerate(codec.books))
        counts, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        step = max(1, (1 << 19) // len(s))
        for k in range(0, len(q), step):
            z = x[k : k + step].astype(np.float32)
            split = codec.pad(z)
            adc = np.broadcast_to(alone, (len(z), len(s))).astype(np.float32)
            for h, (some, where) in enumerate(used):
                (a, b), c = codec.halves[h], codec.coarse[h][some]
                part = z[:, a:b]
                adc += ((part * part).sum(1)[:, None] + (c * c).sum(1) - 2 * part @ c.T)[:, where]
            for m, book in enumerate(codec.books):
                adc += (-2 * split[:, m] @ book.T)[:, codes[:, m]]
            i, j = np.nonzero(adc <= bound)
            ok = qid[k + i] != sid[j]
            i, j = i[ok] + k, j[ok]
            hit = np.zeros(len(i), bool)
            for p in range(0, len(i), 65536):
                u, v = x[i[p : p + 65536]], y[j[p : p + 65536]]
                ok = np.einsum("ij,ij->i", u, v) >= cosine
                apart = [((u[:, a:b] - v[:, a:b]) ** 2).sum(1) for a, b in codec.halves]
                for h in range(half):
                    ok &= apart[h] > near2  # else the pair is met in that half
                hit[p : p + 65536] = ok & (apart[half] <= near2)
            i, j = i[hit], j[hit]
            np.add.at(counts, qi[i], smult[j])
            back = ~own[i]  # within a list both vectors ask; across lists one does, for both
            np.add.at(counts, si[j[back]], qmult[i[back]])
            label = forest(len(ids), qi[i], si[j], label)
        u, v = (ids[x] for x in spanning(label))
        some = counts > 0
        return pd.concat([
            pd.DataFrame({"a": ids[some], "b": ids[some], "n": counts[some]}),
            pd.DataFrame({"a": u, "b": v, "n": np.zeros(len(u), np.int64)}),
        ])

    found = cut(dealt.groupBy(*place, "sb", "qb").applyInPandas(search, "a long, b long, n long"))
    counts = found.where("n > 0").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("others"))
    stars = components(found.where("a != b"), "a", "b")
    rooted = (
        classes.select("cid", "first_id", "mult").join(counts, "cid", "left")
        .join(stars.withColumnRenamed("node", "cid"), "cid", "left")
        .withColumn("root", F.coalesce("root", "cid"))
    )
    named = rooted.join(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select(
        "cid", "component_id", (F.coalesce("others", F.lit(0)) + F.col("mult") - 1).alias("n_links"))
    done = rows.withColumn("cid", F.when(F.col("ok"), key)).join(named, "cid", "left")
    component = F.coalesce("component_id", "vec_id")
    return done.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every vector of the whole table."""
    return link_vectors(spark, load(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
