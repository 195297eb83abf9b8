"""run() as a whole against a brute-force version of each stage, and on an empty table."""

import os
import re
from collections import Counter

import corpus_pipeline
import numpy as np
from docloom.llm import langid, mixing, packing, secretscan, simhash
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = np.random.default_rng(9)
    words = {"en": "the of and house river tree walk with that stone".split(), "de": "der die und haus fluss baum gehen mit dass stein".split()}
    rows = []
    for i in range(120):
        lang = "en" if i % 3 else "de"
        rows.append([(1 << 60) + i, " ".join(rng.choice(words[lang], int(rng.integers(20, 60)))), lang, f"s{i % 3}", 0])
    for i in range(5):
        rows.append([(1 << 60) + 200 + i, rows[i][1], rows[i][2], "s1", 0])  # copies
    rows[7][1] += " password=zq81jsk29dkw9 and on"
    rows[8][1] += " token: 0f1e2d3c4b5a69788796a5b4c3d2e1f0"
    for k in (20, 21, 22):
        rows[k][1] += " secret=sharedvalue99"
    rows += [[None, "123 456", "en", "s0", 7], [5, None, None, None, 0], [6, "", "en", "s2", 0], [None, rows[30][1] + " only here without an id", None, "s2", 0]]
    # documents that share an id or have none, and texts with control characters inside words
    rows += [[77, "\x01".join(str(w) for w in rng.choice(words["en"], 40)) + " " + " ".join(rng.choice(words["en"], 30)), "en", "s1", 0]]
    rows += [[i, " ".join(rng.choice(words["de"], 35)) + f" {mark}\x01{mark} tail", "de", "s2", 0] for i, mark in ((77, "wald"), (None, "wiese"), (None, "berg"), (None, "tal"), (77, "bach"))]
    return [tuple(r) for r in rows]


def test_run_equals_brute_force(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    pred = model.predict([r[1] for r in rows])[0]
    kept = [(i, t, s) for (i, t, _, s, _), p in zip(rows, pred) if p != "und"]
    assert len(kept) == len(rows) - 3
    # one of each component, all fingerprints against all
    fps = np.array([simhash.fingerprint_of(t.encode()) for _, t, _ in kept]).view(np.uint64)
    group = simhash.forest(len(kept), *np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None]) <= 4))
    first = {}
    for g, k in zip(group.tolist(), kept):
        first[g] = min(first.get(g, k), k, key=lambda x: (x[0] is None, x[0] or 0))
    kept = list(first.values())
    # values that fewer than three sources hold
    found = re.compile(r"(?:password|secret|token)(?:=|: )([0-9a-z]{8,})")
    owners = {}
    for _, t, s in kept:
        for m in found.finditer(t):
            owners.setdefault(m.group(1), set()).add(s)
    clean = [(i, found.sub(lambda m: m.group(0) if len(owners[m.group(1)]) > 2 else m.group(0).replace(m.group(1), "[SECRET]"), t), s) for i, t, s in kept]
    assert sum("[SECRET]" in t for _, t, _ in clean) == 2 and sum("sharedvalue99" in t for _, t, _ in clean) == 3
    # repetitions by the mixture's own numbers, sources by count
    n = Counter(s for _, _, s in clean)
    rate = {s: len(clean) / len(n) / c for s, c in n.items()}
    drawn = spark.createDataFrame([(i, t, s, rate[s]) for i, t, s in clean], "doc_id long, text string, source string, rate double").withColumn(
        "n", mixing.count_of(F.col("rate"), mixing.SEED, mixing.identity("doc_id", "source", "text")))
    copies = {(r.doc_id, r.text): r.n for r in drawn.collect()}
    assert len(copies) == len(clean)
    want = Counter()
    for i, t, _ in clean:
        want[i, len(re.findall("[^\x20\x09-\x0d]+", t))] += copies[i, t]
    want = Counter({k: n for k, n in want.items() if n})
    assert Counter((r.doc_id, r.n_words) for r in got) == want
    size = Counter()
    for r in got:
        size[r.shard, r.bin] += r.n_words
    assert max(size.values()) <= packing.CAPACITY and all(r.bin_offset + r.n_words <= packing.CAPACITY for r in got)


def test_run_on_an_empty_table_and_its_folders(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert secretscan.redact(spark.createDataFrame([], SCHEMA)).columns == [c.split()[0] for c in SCHEMA.split(", ")]


def test_pieces_offsets_and_conflicts(spark):
    """pack against its rules: pieces cover each text once, bins never overflow, clusters and sources keep apart."""
    rows = [((1 << 60) + 1, "w " * 250, "en", "a", 0), (None, "x y z", "en", None, 0), ((1 << 60) + 3, "w " * 250, "en", "b", 0), (4, None, "en", "a", 0)]
    rows += [(i, f"t{i} " * (i % 37), "en", f"s{i % 2}", 0) for i in range(10, 200)]
    got = packing.pack(spark.createDataFrame(rows, SCHEMA), capacity=100, per_source=2, shard=64).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows}
    for i, t, *_ in rows:
        mine = sorted((r.first_word, r.n_words, r.piece) for r in got if r.doc_id == i)
        n = len((t or "").split())
        assert mine == [(k * 100, min(100, n - k * 100), k) for k in range(max(1, -(-n // 100)))]
    text = {r[0]: " ".join((r[1] or "").split()) for r in rows}
    bins = {}
    for r in got:
        bins.setdefault((r.shard, r.bin), []).append(r)
    for inside in bins.values():
        inside.sort(key=lambda r: (r.bin_offset, r.n_words))
        ends = np.cumsum([r.n_words for r in inside])
        assert [r.bin_offset for r in inside] == [0, *ends[:-1].tolist()] and ends[-1] <= 100
        assert max(Counter(r.source for r in inside).values()) <= 2 and max(Counter(text[r.doc_id] for r in inside).values()) == 1


def test_without_the_parts_the_rest_stands():
    import subprocess
    import sys

    code = (
        "import sys, importlib.abc\n"
        "class No(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('docloom.llm', 'corpus_pipeline'): raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, No())\n"
        "import __spark_entry__ as e\n"
        "import re\nassert e.queries() and not any(re.match(r'op[0-9]+_|pipeline$', n) for n in e.queries())\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(corpus_pipeline.__file__))
