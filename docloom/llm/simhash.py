"""Operator 9: SimHash near-dedup by a binary trie self-join.

Fingerprints are 64 bits wide and link at ``budget`` or fewer differing bits.
The bits are cut into more blocks than the budget has errors, so of two
fingerprints that link some blocks agree whole. For each choice of such blocks
a trie holds the distinct fingerprints with those blocks first; every pair that
links meets in one of the tries with no error in its first levels. A trie is
walked by pairs of nodes together; a pair is dropped once its differing bits
exceed what its level allows.

The top ``depth`` levels are walked by Spark: they allow no error, so a
fingerprint goes to one node in each trie and is copied 5 times (budget 4) up
to 2**12 leaves of input, 15 times up to 2**20, 35 times beyond. A node with
more than ``4 * leaf`` fingerprints is dealt over several tasks by hash, so no
task grows with the data. Each task walks its subtree in numpy and returns
links that span what it has joined; components of those links are found with
DataFrame joins.

Defined results: a null or wordless text has fingerprint zero and links like
any other; repeated rows keep their own rows; a null doc_id takes part by its
text and is never a component's id while any document has one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import components, cut, forest, load, row_key, spanning

BUDGET = 4
SHINGLE = 4
LEAF = 32768
PAIRS = 1 << 20


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of one UTF-8 text: a bit is set if over half the shingles set it."""
    words = (text or b"").lower().split()  # on bytes: A-Z only, and exactly the six ASCII white spaces
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    total, step = np.zeros(64, dtype=np.int64), 1 << 16
    for k in range(0, n, step):  # very long texts: in blocks
        h = np.array([digest(joined[s:e], 42) for s, e in zip(starts[k : k + step], ends[k : k + step])], dtype=">u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n).view(">i8")[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keep`` and fp (long) for every row."""

    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([fingerprint_of(t, shingle) for t in s], dtype="int64")

    return docs.select(*keep, fp(F.col(text_col).cast("binary")).alias("fp"))


def _split(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """For each node keys[lo:hi], where its child with the bit set begins."""
    if not len(lo):
        return lo
    first = (keys[lo] & ~(bit | (bit - np.uint64(1)))) | bit
    return np.clip(np.searchsorted(keys, first), lo, hi)


def trie_links(a: np.ndarray, b: np.ndarray | None, depth: int, budget: int, head: tuple[int, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of links between sorted distinct keys a and b (b None: within a).

    Node pairs start at ``depth``, where all of a share one prefix and all of b
    another. ``head`` is a number of first levels and the errors they admit; by
    default half the budget in the first 32. What is returned spans the groups
    that the links join: fewer pairs than keys.
    """
    top, few = head or (32, budget // 2)
    own, b = b is None, a if b is None else b
    if not len(a) or not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    shift = 0 if own else len(a)
    err0 = 0 if own else int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(64 - depth))) if depth else 0
    label = np.arange(shift + len(b))

    def take(al, ah, bl, bh):
        """Compare all keys of small node pairs, in blocks."""
        nonlocal label
        if not len(al):
            return
        many = (ah - al) * (bh - bl)
        cuts = np.searchsorted(np.cumsum(many), np.arange(PAIRS, many.sum() + PAIRS, PAIRS))
        for s, e in zip(np.concatenate(([0], cuts[:-1] + 1)), cuts + 1):
            s, e = int(s), int(min(e, len(al)))
            if s >= e:
                continue
            m = many[s:e]
            who = np.repeat(np.arange(s, e), m)
            at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            wide = (bh - bl)[who]
            i, j = al[who] + at // wide, bl[who] + at % wide
            ok = np.bitwise_count(a[i] ^ b[j]) <= budget
            if own:
                ok &= i < j
            i, j = i[ok], j[ok] + shift
            label = forest(len(label), i, j, label)

    stack = [(depth, np.array([0]), np.array([len(a)]), np.array([0]), np.array([len(b)]), np.array([err0]))]
    while stack:
        level, al, ah, bl, bh, err = stack.pop()
        small = ((ah - al) * (bh - bl) <= 64) | (level >= 60)
        take(al[small], ah[small], bl[small], bh[small])
        al, ah, bl, bh, err = (x[~small] for x in (al, ah, bl, bh, err))
        if not len(al):
            continue
        bit = np.uint64(1) << np.uint64(63 - level)
        am, bm = _split(a, al, ah, bit), _split(b, bl, bh, bit)
        same = (al == bl) & (ah == bh) & own
        admit = few if level < top else budget
        parts = [
            (al, am, bl, bm, err, True),
            (am, ah, bm, bh, err, True),
            (al, am, bm, bh, err + 1, True),
            (am, ah, bl, bm, err + 1, ~same),
        ]
        nxt = []
        for p, q, r, s, x, keep in parts:
            ok = (p < q) & (r < s) & (x <= admit) & keep
            nxt.append([y[ok] for y in (p, q, r, s, x)])
        nxt = [np.concatenate(x) for x in zip(*nxt)]
        for k in range(0, len(nxt[0]), PAIRS):  # depth first by blocks: the frontier stays bounded
            stack.append((level + 1, *[x[k : k + PAIRS] for x in nxt]))
    return spanning(label)


def tries(budget: int, depth: int) -> list[list[tuple[int, int]]]:
    """For each trie its blocks, (lowest bit, width), those without errors first.

    The fewest blocks are taken whose choices are ``depth`` or more bits wide,
    but never more than three over the budget.
    """
    for free in (1, 2, 3):
        n = budget + free
        at = [64 * k // n for k in range(n + 1)]
        blocks = [(lo, hi - lo) for lo, hi in zip(at, at[1:])]
        made = [[*first, *(x for x in blocks if x not in first)] for first in combinations(blocks, free)]
        if head_width(made, free) >= depth:
            break
    return made


def head_width(made: list[list[tuple[int, int]]], free: int) -> int:
    """The fewest bits that the error-free blocks of a trie have."""
    return min(sum(width for _, width in blocks[:free]) for blocks in made)


def _key(fp: Column, blocks: list[tuple[int, int]]) -> Column:
    """The bits of fp, block after block."""
    key, left = F.lit(0).cast("long"), 64
    for lo, width in blocks:
        left -= width
        key = key.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1)), left))
    return key


def _fp(key: np.ndarray, blocks: list[tuple[int, int]]) -> np.ndarray:
    """The fingerprints of keys."""
    fp, left = np.zeros_like(key), 64
    for lo, width in blocks:
        left -= width
        fp |= (key >> np.uint64(left) & np.uint64((1 << width) - 1)) << np.uint64(lo)
    return fp


def links(spark: SparkSession, fps: DataFrame, budget: int = BUDGET, leaf: int = LEAF) -> DataFrame:
    """(u, v): links between the distinct fingerprints ``fps(fp)`` that together connect all that link."""
    n = fps.count()
    depth = max(3, int(np.ceil(np.log2(max(1, n) / leaf))))
    made = tries(budget, depth)
    exact = head_width(made, len(made[0]) - budget)
    depth = min(depth, exact)
    keyed = fps.select(F.explode(F.array(*[F.struct(F.lit(k).alias("trie"), _key(F.col("fp"), blocks).alias("key")) for k, blocks in enumerate(made)])).alias("x"))
    keyed = keyed.select("x.trie", "x.key", F.shiftrightunsigned("x.key", 64 - depth).alias("node"))
    # few nodes are far over the mean; they are dealt over several tasks, each part against each
    parts = keyed.groupBy("trie", "node").agg(F.count("*").alias("n")).where(F.col("n") > 4 * leaf).select(
        "trie", "node", F.ceil(F.col("n") / F.lit(leaf)).cast("int").alias("parts"))
    mine = keyed.join(parts, ["trie", "node"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    routed = mine.withColumn("part", F.pmod(F.xxhash64("key"), "parts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    routed = routed.select("trie", "node", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), (F.col("part") > F.col("other")).alias("second"), "key")

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        blocks, own = made[pdf["trie"].iat[0]], pdf["p"].iat[0] == pdf["q"].iat[0]
        key, second = pdf["key"].to_numpy().view(np.uint64), pdf["second"].to_numpy()
        a, b = np.unique(key[~second]), None if own else np.unique(key[second])
        i, j = trie_links(a, b, depth, budget, (exact, 0))
        both = a if own else np.concatenate((a, b))
        return pd.DataFrame({"u": _fp(both[i], blocks).view(np.int64), "v": _fp(both[j], blocks).view(np.int64)})

    return routed.groupBy("trie", "node", "p", "q").applyInPandas(walk, "u long, v long")


def grouped(spark: SparkSession, docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), budget: int = BUDGET, shingle: int = SHINGLE, leaf: int = LEAF) -> DataFrame:
    """``keep``, fp, root (the smallest fingerprint of the component) and component_id for every row."""
    fp = cut(fingerprints(docs, keep, shingle=shingle))
    classes = cut(fp.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    stars = cut(components(links(spark, classes.select("fp"), budget, leaf), "u", "v"))
    rooted = classes.join(stars, classes["fp"] == stars["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first_id")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return fp.join(rooted.join(ids, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs(doc_id, text)``."""
    return grouped(spark, docs, **how).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """One document of each component, with all its columns: that with the smallest doc_id.

    A component none of whose rows has a doc_id keeps one of them; rows of one
    doc_id and text count as one document.
    """
    keyed = docs.withColumn("__key", row_key("doc_id", "text"))
    found = grouped(spark, keyed, ("doc_id", "__key"), **how)
    first = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("__key").alias("key"))
    stay = found.groupBy("root").agg(F.min(first).alias("x")).select(F.col("x.key").alias("__stay"), F.col("x.b").alias("__id"))
    # ids are compared too: two documents whose keys collide stay apart. Not as a key of the join: rows of one key are then
    # in one partition for dropDuplicates as well, and texts are shuffled once
    same = F.expr("if(doc_id IS NULL, __id IS NULL, coalesce(doc_id = __id, false))")
    return keyed.join(stay, (F.col("__key") == F.col("__stay")) & same, "left_semi").dropDuplicates(["__key", "doc_id"]).drop("__key")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document of the whole table."""
    return near_duplicates(spark, load(spark, sf_dir, "documents"))
