"""op6 with many lists, several blocks and both halves against brute force."""

import numpy as np
import pytest
from docloom.llm import common, pqdedup


def brute(ids, x, label):
    y = np.asarray(x, np.float64)
    y = y / np.linalg.norm(y, axis=1, keepdims=True)
    near = (y @ y.T >= pqdedup.COSINE) & (np.asarray(label)[:, None] == np.asarray(label)[None])
    np.fill_diagonal(near, False)
    group = common.forest(len(ids), *np.nonzero(near))
    least = {}
    for g, i in zip(group.tolist(), ids):
        least[g] = min(least.get(g, i), i)
    return {i: (int(n), least[g]) for i, n, g in zip(ids, near.sum(1), group.tolist())}


@pytest.mark.parametrize("dim, lists, block, kind", [(16, 40, 64, "float"), (5, 12, 32, "double"), (1, 1, 50, "float"), (16, 1, 40, "float"), (7, None, 4096, "float")])
def test_links_equal_brute_force(spark, dim, lists, block, kind):
    rng = np.random.default_rng(dim)
    centre = rng.normal(size=(60, dim))
    x = np.concatenate([centre, *[centre[rng.integers(0, 60, 80)] * rng.uniform(0.5, 2, (80, 1)) + rng.normal(size=(80, dim)) * s for s in (0.0, 0.02, 0.08, 0.12)]]).astype(np.float32 if kind == "float" else np.float64)
    label = rng.integers(0, 2, len(x)).tolist()
    ids = [(1 << 60) + int(i) for i in rng.permutation(len(x))]
    frame = spark.createDataFrame([(i, v.tolist(), k) for i, v, k in zip(ids, x, label)], f"vec_id long, embedding array<{kind}>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in pqdedup.link_vectors(spark, frame, block=block, lists=lists).collect()}
    assert got == brute(ids, x, label)
