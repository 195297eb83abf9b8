"""Taggers with fallback, and table functions by name."""

from docloom.operators import taggers
from docloom.plans import loading
from docloom.sources import html


def test_tagger_falls_back_row_by_row(spark):
    rules = taggers.rule_tagger({"health": ("hospital",), "law": ("statute",)}, ("shall",), "other")

    def model(title, text):
        if "boom" in text:
            raise RuntimeError("no answer")
        return {"summary": "", "operativity": "x", "tags": "law"} if "blank" in text else {"summary": "s", "operativity": "operative", "tags": "law; strange", "confidence": 7}

    big = (1 << 60) + 1
    rows = [(big, "t", "a statute."), (None, "t", "boom. It shall be the hospital"), (3, "t", "blank"), (4, None, None)]
    d = spark.createDataFrame(rows, "doc_id long, title string, content string")
    got = {r.doc_id: r for r in taggers.tag_records(d, model, rules, ("law", "health", "other")).collect()}
    assert (got[big].tags, got[big].confidence, got[big].tagged_by) == ("law", 1.0, "tagger")
    assert (got[None].tags, got[None].operativity, got[None].summary, got[None].tagged_by) == ("health", "operative", "boom.", "fallback")
    assert got[3].tagged_by == "fallback" and got[3].tags == "other" and got[4].tags == "law"
    assert taggers.tag_records(d.limit(0), model).count() == 0


def test_tag_rows_and_functions(spark):
    d = spark.createDataFrame([(1, "a"), (2, "b")], "k int, t string")
    out = html.tag_rows(d, lambda p: p.assign(u=p["t"].str.upper())[["k", "u"]], "k int, u string")
    assert sorted(map(tuple, out.collect())) == [(1, "A"), (2, "B")]
    loading.register_functions(spark, "/root/testdata/sf0.001")
    assert spark.sql("SELECT * FROM docloom_missing_counts()").count() == 3
    assert spark.sql("SELECT max(len) FROM docloom_short_documents(100)").first()[0] < 100
