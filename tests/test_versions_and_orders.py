"""Versioned merges under concurrent writers, and orders over dependencies."""

import random

import pytest
from pyspark.sql import functions as F

from docloom.operators import graph
from docloom.sources.versioned import VersionedTable


@pytest.fixture
def stored(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "k")
    t.create(spark.createDataFrame([(i, f"a{i}", "" if i % 2 else "b") for i in range(6)], "k int, x string, y string"))
    return t


def rows(t):
    return {r.k: (r.x, r.y, r.row_version) for r in t.read().collect()}


def updates(spark, us):
    return spark.createDataFrame(us, "k int, x string, y string, seen long")


def test_updates_apply_by_field_and_errors_are_named(spark, stored):
    m = stored.merge(updates(spark, [(0, "new", None, None), (1, "", "filled", 1), (9, "z", "z", None), (3, "p", "p", None), (3, "q", "q", None)]), ["x", "y"], expected="seen")
    assert (m.processed, m.ok, m.failed, m.conflicts, m.version) == (4, 2, 2, 0, 2)
    assert sorted(map(tuple, m.errors.collect())) == [(3, "several updates"), (9, "not found")]
    got = rows(stored)
    assert got[0] == ("new", "b", 2) and got[1] == ("a1", "filled", 2) and got[3] == ("a3", "", 1) and len(got) == 6
    assert {r.k: r.x for r in stored.read(1).collect()}[0] == "a0"  # older versions stay readable


@pytest.mark.parametrize("mode,want", [("skip", ("first", "b", 2)), ("merge", ("first", "b", 3)), ("overwrite", ("late", "late", 3))])
def test_a_stale_writer_gets_its_mode(spark, stored, mode, want):
    stored.merge(updates(spark, [(2, "first", None, 1), (1, "first", None, 1)]), ["x", "y"], expected="seen")
    m = stored.merge(updates(spark, [(2, "late", "late", 1), (1, None, "late", 1), (4, "fresh", None, 1)]), ["x", "y"], mode, expected="seen")
    got = rows(stored)
    assert got[2] == want and got[4][0] == "fresh" and m.conflicts == 2
    assert got[1][1] == ("" if mode == "skip" else "late")  # a blank field is filled by merge too
    assert sorted(map(tuple, m.errors.collect())) == ([(1, "conflict"), (2, "conflict")] if mode == "skip" else [])


def test_two_writers_both_apply(spark, stored):
    other = VersionedTable(spark, stored.path, "k")
    calls = []

    def meanwhile():
        if not calls:
            calls.append(other.merge(updates(spark, [(0, "theirs", None, None), (5, "theirs", None, None)]), ["x", "y"]))

    m = stored.merge(updates(spark, [(1, "ours", None, 1), (5, "ours", None, 1)]), ["x", "y"], "skip", expected="seen", before_commit=meanwhile)
    got = rows(stored)
    assert got[0][0] == "theirs" and got[1][0] == "ours" and got[5][0] == "theirs"
    assert (m.ok, m.conflicts, m.version) == (1, 1, 3) and stored.version() == 3


def test_a_taken_version_is_never_made_again(spark, stored):
    assert stored.commit(stored.read(), 0) is None and stored.version() == 1
    with pytest.raises(ValueError):
        stored.merge(updates(spark, []), ["x"], "other")
    with pytest.raises(RuntimeError):
        stored.merge(updates(spark, [(1, "x", None, None)]), ["x"], retries=0, before_commit=lambda: stored.commit(stored.read(), stored.version()))


def brute_levels(nodes, edges):
    on = {n: {a for a, b in edges if b == n and a in nodes} for n in nodes}
    level, rest = {}, set(nodes)
    k = 0
    while free := {n for n in rest if not on[n] & rest}:
        level |= dict.fromkeys(free, k)
        rest -= free
        k += 1
    while rest and (last := {n for n in rest if not any(n in on[m] for m in rest)}):
        level |= dict.fromkeys(last, -2)
        rest -= last
    return level | dict.fromkeys(rest, -1)


@pytest.mark.parametrize("seed", range(4))
def test_levels_equal_peeling_by_hand(spark, seed):
    rng = random.Random(seed)
    n = 40
    edges = [(a, b) for a, b in ((rng.randrange(n), rng.randrange(n)) for _ in range(rng.choice([20, 45, 80]))) if seed == 3 or a < b or rng.random() < 0.05] + [(3, 3)] * (seed == 1) + [(99, 1)]
    nodes = spark.createDataFrame([(i,) for i in range(n)], "id int")
    got = graph.ordered(nodes, spark.createDataFrame(edges + edges[:3], "on int, id int")).collect()
    assert {r.id: r.level for r in got} == brute_levels(set(range(n)), edges)
    at = {r.id: r.position for r in got}
    assert sorted(at.values()) == list(range(1, n + 1))
    level = {r.id: r.level for r in got}
    assert all(at[a] < at[b] for a, b in edges if a in at and level[a] >= 0)


def test_edges_of_changes(spark):
    c = spark.createDataFrame([(1, "r", 10, ["tags"]), (2, "r", 20, ["class"]), (3, "r", 30, ["text"]), (4, "r", 40, ["tags", "class"]), (5, "q", 50, ["tags"])], "id int, k string, ts int, changed array<string>")
    has = lambda f: F.array_contains("changed", f)
    e = graph.dependency_edges(c, "k", "id", "ts", has("tags"), (has("class"), has("tags")))
    assert {(r.on, r.id) for r in e.collect()} == {(1, 2), (1, 3), (1, 4), (2, 1), (2, 4), (4, 1)}
    got = {r.id: r.level for r in graph.levels(c, e).collect()}
    assert got == {5: 0, 1: -1, 2: -1, 4: -1, 3: -2}
