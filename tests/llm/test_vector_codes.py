"""Operator 11 against plain Lloyd iterations in Python integers."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from docloom.llm import codecompress

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long"


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max([1] + [-(-len(v) // parts) for _, v, _ in kept])
    vec = [[math.floor(4096 * float(np.float32(x))) for x in v] + [0] * (width * parts - len(v)) for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, vec[i]))
    codes, errors, final = [[] for _ in kept], [0] * len(kept), []
    for p in range(parts):
        part = [v[p * width : (p + 1) * width] for v in vec]
        book = [part[i] for i in order[:entries]]

        def nearest(x):
            return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

        for _ in range(rounds):
            of = defaultdict(list)
            for x in part:
                of[nearest(x)[1]].append(x)
            book = [[sum(c) // len(of[k]) for c in zip(*of[k])] if of[k] else e for k, e in enumerate(book)]
        for i, x in enumerate(part):
            d, k = nearest(x)
            codes[i].append(f"{k:02x}")
            errors[i] += d
        final += [c for e in book for c in e]
    by_label = defaultdict(int)
    for (_, _, lab), e in zip(kept, errors):
        by_label[lab] += e
    digest = hashlib.sha256(",".join(map(str, final)).encode()).hexdigest()
    return sorted(((i, "".join(c), e, by_label[lab], digest) for (i, _, lab), c, e in zip(kept, codes, errors)), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, lab, "c", 1) for i, v, lab in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in codecompress.compress(df, **kw).collect()), key=str)


def sample(n, width, spread, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, width))
    return [[float(np.float32(x)) for x in centre[rng.integers(12)] + spread * rng.normal(size=width)] for _ in range(n)]


def test_codes_equal_plain_iterations(spark):
    vectors = sample(400, 16, 0.3, 1)
    rows = [(i, v, [None, 1, 2][min(2, i % 5)]) for i, v in enumerate(vectors)]
    rows += [(1000, None, 1), (1001, [None] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [float("inf")] * 16, 2), (None, vectors[5], 2), rows[7], rows[7]]
    assert run(spark, rows) == brute(rows)


def test_ties_and_equal_vectors(spark):
    grid = [(i, [float(i % 3), float(i % 2)] * 8, i % 2) for i in range(200)]
    assert run(spark, grid) == brute(grid)
    same = [(i, [0.5] * 16, None) for i in range(40)]
    assert run(spark, same) == brute(same)


def test_small_blocks_and_hot_labels_give_the_same(spark, monkeypatch):
    rows = [(i, v, 0 if i % 3 else i) for i, v in enumerate(sample(150, 24, 0.2, 2))]
    monkeypatch.setattr(codecompress, "BLOCK", 16)
    monkeypatch.setattr(codecompress, "HOT", 10)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("scale", [1e3, 3e5, 3e6])
def test_large_components_stay_exact(spark, scale):
    rows = [(i, [scale * x for x in v], 1) for i, v in enumerate(sample(40, 8, 0.3, 3))]
    want = [(i, c, min(e, 2**63 - 1), min(t, 2**63 - 1), d) for i, c, e, t, d in brute(rows)]
    assert run(spark, rows) == sorted(want, key=str)


def test_components_beyond_the_range_are_held(spark):
    got = run(spark, [(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1), (3, [0.0] * 8, 1)])
    assert [r[0] for r in got] == [1, 2, 3] and all(r[2] == 0 for r in got)


def test_few_rows_unequal_lengths_and_no_rows(spark):
    rows = [(1, [1.0, 2.0, 3.0], 1), (2, [1.0] * 9, 1), (3, [], None)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_a_tree_assigns_whole_subtrees():
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.integers(-50, 50, (500, 4)) + c for c in (0, 1000, 5000)])
    book = np.array([[0] * 4, [1000] * 4, [5000] * 4, [9000] * 4])
    tree = codecompress.Tree(points)
    sums, counts, taken = tree.assign(book)
    at, _ = codecompress.nearest(points, book)
    assert (counts == np.bincount(at, minlength=4)).all() and (sums[:3] == [points[at == k].sum(0) for k in range(3)]).all()
    assert sum(len(e) for _, _, e in taken) < 100
    assert (tree.codes(book)[0] == at).all()
