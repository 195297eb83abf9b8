"""Forms of words and dictionary scans against plain containment."""

import random

import pytest

from docloom.functions.affixes import Affixes
from docloom.operators import mentions


def test_six_tiers_and_two_prefix_rounds():
    a = Affixes("ab", ("ing", "s"))
    assert a.without_prefix("abword") == "word" and a.without_prefix("aabbword") == "bbword" and a.without_prefix("abc") == "abc" and a.without_prefix("abcd") == "bcd"
    assert a.without_suffix("wordings") == "wording" and a.without_suffix("king") == "king" and a.without_suffix("cats") == "cat"
    assert a.forms("akings") == [(1, "akings"), (2, "kings"), (3, "aking"), (4, "king"), (5, "aakings"), (5, "bakings"), (6, "bkings")]
    assert a.forms("") == [(5, "a"), (5, "b")]


@pytest.mark.parametrize("most", [10**6, 7])
def test_the_scan_equals_containment(spark, most):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abs") for _ in range(n))
    a = Affixes("ab", ("s", "ab"))
    words = [(i % 20, word(rng.randint(1, 6))) for i in range(60)] + [(20, "Sab"), (21, "zz")]
    texts = [word(rng.randint(0, 30)).upper() for _ in range(80)] + [None, "", "ZZ sab " * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(3)
    got = {r.k: [(x.rule, x.tier) for x in r.m] for r in df.select("k", mentions.mentioned(spark, df["t"], words, a, most).alias("m")).collect()}
    for k, t in enumerate(texts):
        best = {}
        for rule, w in words:
            for tier, f in a.forms(w.lower()):
                if f in (t or "").lower():
                    best[rule] = min(tier, best.get(rule, 9))
        assert got[k] == sorted(best.items()), t
    assert mentions.mentions(df, "t", ["k"], [], a).count() == 0
