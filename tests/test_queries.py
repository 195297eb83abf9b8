"""Every catalogue query against its oracle on the smallest tables."""

import os

import duckdb
import pytest

from docloom.plans import catalogue
from docloom.plans.dialect import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _plain(rows):
    return sorted(tuple(f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_matches_oracle(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = _plain([[r[c] for c in cols] for r in df.collect()])
    cur = duck.execute(catalogue.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert got == _plain([[r[names.index(c)] for c in cols] for r in cur.fetchall()])


def test_only_page_texts_have_no_oracle(spark):
    assert set(catalogue.QUERIES) - set(catalogue.ORACLES) == {"html_text"}
    df = catalogue.QUERIES["html_text"](spark, SF)
    rows = df.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count() and all(len(r.main_text) <= r.visible_chars + 1 for r in rows)
