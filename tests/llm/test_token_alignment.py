"""Operator 12 against the vocabulary file's own library and pairs found one by one."""

import hashlib
import os
from collections import Counter, defaultdict

import pytest

from docloom.llm import tokenalign

pytestmark = pytest.mark.skipif(not os.path.isdir(tokenalign.FOLDER), reason="needs the public vocabularies")
SCHEMA = "doc_id long, text string, row long, a string, n int"
TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "été déjà vu là où", "a\n\n  b\tc   ", "<|endoftext|> </s> <s> <unk>", "数据 und Übermaß 🙂🙂", None, "", " ",
    "don't stop, we'll see 12345 67-89", "x" * 3000, "▁odd piece", " wide space", "é combining ﬁ ligature", "zero\x00byte\x7f", "  leading", "token " * 700,
]


def brute(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{tokenalign.FOLDER}/{tokenalign.BYTE_LEVEL}")
    t.encode_special_tokens = True
    letters = tokenalign.byte_of_letter()
    a_bytes = {i: bytes(letters[c] for c in s) for s, i in t.get_vocab().items() if i != 50256}
    sp = sentencepiece.SentencePieceProcessor(model_file=f"{tokenalign.FOLDER}/{tokenalign.PIECES}")
    b_bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(32000)]
    docs, holds = [], Counter()
    for text in texts:
        a = t.encode(" " + (text or ""), add_special_tokens=False).ids
        b = sp.encode(text or "")
        raw = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in a) != raw or b"".join(b_bytes[i] for i in b) != raw:
            docs.append(([], [], [], ""))
            continue
        spans = []
        for ids, table in ((a, a_bytes), (b, b_bytes)):
            at, s = 0, []
            for i in ids:
                s.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(s)
        links, j = [], 0
        for s, e, i in spans[0]:
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((i, spans[1][k][2]))
                k += 1
        holds.update(set(links))
        groups, cuts = [], sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        low = 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in half if low <= s and e <= cut) for half in spans) if len(text) < 5000 else "")
            low = cut
        docs.append((a, b, links, ";".join(groups)))
    most = defaultdict(int)
    for (i, _), n in holds.items():
        most[i] = max(most[i], n)
    return [
        (k, len(a), len(b), g.count(";") + 1 if g else 0, len(li), sum(holds[p] == most[p[0]] for p in li), sum(holds[p] for p in li), hashlib.sha256(g.encode()).hexdigest() if g else "")
        for k, (a, b, li, g) in enumerate(docs)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    texts = TEXTS + [f"The {w} fox and the {w} dog." for w in "red green blue amber tawny".split()] + ["The quick brown fox jumps over the lazy dog."]
    return texts, spark.createDataFrame([(i, t, 7, "a", 1) for i, t in enumerate(texts)], SCHEMA).repartition(3).cache()


@pytest.mark.parametrize("pairs,batch", [(1_000_000, 250_000), (0, 40)])
def test_alignment_equals_brute_force(docs, pairs, batch, monkeypatch):
    texts, df = docs
    monkeypatch.setattr(tokenalign, "HOT", 20)
    got = tokenalign.alignments(df, broadcast_pairs=pairs, batch=batch)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows_of(got) == sorted(brute(texts), key=str)


def test_repeated_rows_null_ids_and_no_rows(spark):
    text = "some words here"
    got = rows_of(tokenalign.alignments(spark.createDataFrame([(1, text, 0, "", 0), (1, text, 0, "", 0), (None, text, 0, "", 0), (None, None, 0, "", 0)], SCHEMA)))
    want = brute([text] * 3)[0][1:]
    assert got == sorted([(1, *want), (1, *want), (None, *want), (None, 0, 0, 0, 0, 0, 0, "")], key=str)
    assert rows_of(tokenalign.alignments(spark.createDataFrame([], SCHEMA))) == []


def test_long_texts_without_spaces(spark):
    text = "ab" * 200_000
    (row,) = tokenalign.alignments(spark.createDataFrame([(1, text, 0, "", 0)], SCHEMA)).collect()
    assert row.n_a > 1000 and row.n_groups > 0 and row.count_sum == row.n_links
