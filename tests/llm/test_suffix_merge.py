"""Operator 13 against a plain count of all strings."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from docloom.llm import suffixmerge as sm

SCHEMA = "doc_id long, text string, spans int, kept string, k1 long"


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    n = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if n[r[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[:-1]
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        out.append((len(r), int(gone.sum()), int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(r) else 0, hashlib.sha256(kept).hexdigest()))
    return out


def result(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, 1, "k", 2) for i, t in rows], SCHEMA).repartition(5)
    d = sm.remove_repeats(df, **kw)
    assert d.columns == ["doc_id", "text", "spans", "kept", "k1", "spans_", "kept_"]
    return sorted(((r.doc_id, len((r.text or "").encode()), sum(e - s for s, e in r.spans_), len(r.spans_), hashlib.sha256(r.kept_).hexdigest()) for r in d.collect()), key=str)


def corpus(rng, docs, words=400):
    vocab = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(words)] + ["été", "\x00", "数据"]
    say = lambda n: " ".join(vocab[i] for i in rng.integers(0, len(vocab), n))
    passages = [say(n) for n in (10, 30, 31, 40, 60, 200)]
    texts = [None, "", "short", "a" * 700, "ab" * 300, "line of words\n" * 60]
    for _ in range(docs):
        t = say(rng.integers(5, 120))
        if rng.random() < 0.6:
            p = passages[rng.integers(len(passages))]
            cut = rng.integers(0, 40)
            t = t + " " + p[cut:] + " " + say(rng.integers(1, 40))
        if rng.random() < 0.2:
            w = t.split(" ")
            w[rng.integers(len(w))] = "changed"
            texts.append(" ".join(w))
        texts.append(t)
    return texts


@pytest.mark.parametrize("seed,block,most,sample", [(1, 100_000, 20_000, 1 / 16), (2, 40, 20_000, 1 / 16), (3, 60, 2, 1), (4, 100_000, 4, 0.5), (5, 50, 0, 1)])
def test_removal_equals_brute_force(spark, monkeypatch, seed, block, most, sample):
    monkeypatch.setattr(sm, "BLOCK", block)
    texts = corpus(np.random.default_rng(seed), 60)
    got = result(spark, list(enumerate(texts)), most=most, sample=sample)
    assert got == sorted(((i, *b) for i, b in enumerate(brute(texts, 200))), key=str)
    assert 0 < sum(g[2] for g in got) < sum(g[1] for g in got)


def blocks(texts, ranges, length, gram, hot_list):
    """All stages without Spark."""
    out, hot = [[] for _ in texts], []
    runs = {}
    rows = []
    for i in range(0, len(texts), 4):
        raw = [(t or "").encode() for t in texts[i : i + 4]]
        end = np.cumsum([len(r) for r in raw])
        keys = np.array([[i + k, 0] for k in range(len(raw))])
        rows += sm.sorted_runs(b"".join(raw), end - [len(r) for r in raw], end, keys, ranges, hot_list, length, gram)
    for r in rows:
        if r["kind"] == 1:
            runs.setdefault(r["range"], []).append(r["runs"])
    rows += [x for k, v in runs.items() for x in sm.merged(v, k, length, gram)]
    for r in rows:
        if r["kind"] == 0:
            for d, s, e in zip(r["k1"], r["starts"], r["ends"]):
                out[d].append((s, e))
        if r["kind"] == 2:
            hot += zip(r["h1"], r["h2"], r["k1"], r["starts"], r["ends"])
    n = Counter()
    for a, b, _, _, e in hot:
        n[a, b] += 1 + (e == 0)
    for a, b, d, s, e in hot:
        if e and n[a, b] > 1:
            out[d].append((s, e))
    return out


@pytest.mark.parametrize("seed", range(12))
def test_runs_and_merges_equal_brute_force_on_few_letters(monkeypatch, seed):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(sm, "BLOCK", int(rng.integers(5, 80)))
    monkeypatch.setattr(sm, "SLICE", int(rng.integers(30, 300)))
    length, gram = int(rng.integers(8, 14)), int(rng.integers(2, 8))
    texts = ["".join("ab"[x] for x in rng.integers(0, 2, rng.integers(0, 90))) for _ in range(30)] + ["a" * 50, "ab" * 20, "", None]
    raw = [(t or "").encode() for t in texts]
    end = np.cumsum([len(r) for r in raw])
    grams = np.unique(sm.anchors(np.frombuffer(b"".join(raw), np.uint8), end - [len(r) for r in raw], end, length, gram)[1])
    got = []
    for t, spans in zip(texts, blocks(texts, 3, length, gram, grams[:: int(rng.integers(1, 5))])):
        gone = np.zeros(len(t or ""), bool)
        for s, e in spans:
            gone[s:e] = True
        got.append(int(gone.sum()))
    assert got == [b[1] for b in brute(texts, length)]


@pytest.mark.parametrize("k", [1, 2, 3, 7, 16])
def test_loser_tree_merges_with_shared_lengths(k):
    rng = np.random.default_rng(k)
    runs = []
    for _ in range(k):
        s = sorted(bytes(rng.integers(97, 99, rng.integers(0, 40)).astype(np.uint8)) for _ in range(rng.integers(0, 60)))
        runs.append((s, [0] + [sm.shared(a, b, 0) for a, b in zip(s, s[1:])] if s else []))
    order, lengths = sm.merge(runs)
    at = [iter(r[0]) for r in runs]
    out = [next(at[r]) for r in order]
    assert out == sorted(x for r in runs for x in r[0])
    assert lengths == [0] * bool(out) + [sm.shared(a, b, 0) for a, b in zip(out, out[1:])]


def test_repeated_rows_null_ids_long_texts_and_no_rows(spark):
    rng = np.random.default_rng(9)
    long = "".join(chr(97 + c) for c in rng.integers(0, 26, 300_000))
    rows = [(1, long), (2, long[1000:1300]), (3, "x" + long[:150]), (None, "y" * 500), (None, "y" * 500), (7, long[250_000:250_400])] + [(8, "z" + long[5000:5199] + "q")] * 2
    want = [(1, 300_000, 700, 2), (2, 300, 300, 1), (3, 151, 0, 0), (None, 500, 500, 1), (None, 500, 500, 1), (7, 400, 400, 1), (8, 201, 201, 1), (8, 201, 201, 1)]
    assert [r[:4] for r in result(spark, rows)] == sorted(want, key=str)
    assert result(spark, []) == []


def test_strings_of_hot_grams_meet_in_many_ranges():
    """All of them went to the range that a block names first: one task, which grew with the table."""
    rng = np.random.default_rng(13)
    line = bytes(rng.integers(97, 123, 150).astype(np.uint8))
    texts = [bytes(rng.integers(97, 123, 180).astype(np.uint8)) + line + bytes(rng.integers(97, 123, 180).astype(np.uint8)) for _ in range(400)]
    data, end = b"".join(texts), np.cumsum(list(map(len, texts)))
    start, keys = end - 510, np.stack([np.arange(400), np.zeros(400, np.int64)], 1)
    h = sm.anchors(np.frombuffer(data, np.uint8), start, end, 200, 32)[1]
    grams, n = np.unique(h, return_counts=True)
    got = Counter()
    for row in sm.sorted_runs(data, start, end, keys, 50, grams[n > 20]):
        if row["kind"] == 2:
            got[row["range"]] += len(row["h1"])
    assert sum(got.values()) > 5000 and len(got) == 50 and max(got.values()) < 3 * sum(got.values()) / 50
