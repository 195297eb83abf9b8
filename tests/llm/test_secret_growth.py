"""op2 on texts with very many secrets, and on overlapping, repeated and stand-in ones."""

import re
import time

import numpy as np
from docloom.llm import secretscan

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_redaction_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    hexes = ["".join(rng.choice(list("0123456789abcdef"), 40)) for _ in range(400)]
    texts = ["é" * int(rng.integers(0, 9000)) + "".join(f" token={h} \U0001f600" if k % 2 else f" {h}," for k, h in enumerate(hexes[40 * i : 40 * i + 40])) for i in range(10)]
    texts += ["password: changeme1234", "secret=aaaaaaaaaaaa", None, "", "token = abc", "no secrets"]
    frame = spark.createDataFrame([(i, t, "en", f"s{i}", 7) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in secretscan.redact(frame).collect()}
    for i in range(10):
        want = re.sub("|".join(hexes), "[SECRET]", texts[i])
        assert (got[i].text, got[i].n_chars) == (want, len(want))
    assert all((got[i].text, got[i].n_chars) == (texts[i], 7) for i in range(10, len(texts)))


def test_ids_beside_nulls_and_repeated_rows(spark):
    big = (1 << 60) + 1
    frame = spark.createDataFrame([(big, "token=abcd1234efgh", "en", "a", 1), (None, "token=abcd1234efgh", "en", None, 1), (big, "token=abcd1234efgh", "en", "a", 1)], SCHEMA)
    got = secretscan.redact(frame).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, "token=[SECRET]"), (big, "token=[SECRET]"), (big, "token=[SECRET]")]
    owned = secretscan.ownership(secretscan.scan(frame)).first()
    assert (owned.n_repos, owned.n_owners, owned.is_live) == (2, 1, True)


def test_time_grows_with_the_hits(spark):
    def seconds(n):
        frame = spark.createDataFrame([(1, "".join(f"token=q{i + 20_000_000}ab c " for i in range(n)), "en", "a", 1)], SCHEMA)
        start = time.perf_counter()
        assert secretscan.redact(frame).first().text.count("[SECRET]") == n
        return time.perf_counter() - start

    seconds(100)
    a, b = seconds(32_000), seconds(64_000)
    assert b < 3 * a + 1
