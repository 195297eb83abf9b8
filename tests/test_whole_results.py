"""Queries whose results were cut, on tables larger than the cuts."""

import datetime as dt

from docloom.plans import catalogue


def _write(spark, path, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(path / f"{name}.parquet"))


def test_filtered_scan_returns_all_rows(spark, tmp_path):
    days = [dt.datetime(1995, 1, 1) + dt.timedelta(days=i % 1500) for i in range(3000)]
    rows = [(10_000 + i, "F", day) for i, day in enumerate(days)]
    _write(spark, tmp_path, "orders", rows, "o_orderkey long, o_orderstatus string, o_orderdate timestamp_ntz")
    want = sorted(((d, k) for k, _, d in rows if d <= dt.datetime(1997, 12, 31)), key=lambda x: (-x[0].toordinal(), x[1]))
    got = [(r.order_date, r.o_orderkey) for r in catalogue.QUERIES["filtered_scan"](spark, str(tmp_path)).collect()]
    assert len(got) > 1000 and got == [(d.strftime("%Y-%m-%d"), k) for d, k in want]


def test_url_sort_returns_all_pages(spark, tmp_path):
    rows = [(i, f"http://a.org/en/{i}" if i % 7 else "http://a.org/") for i in range(300)]
    _write(spark, tmp_path, "pages", rows, "page_id long, url string")
    want = [i for i in range(299, -1, -1) if i % 7] + [i for i in range(300) if not i % 7]
    assert [r.page_id for r in catalogue.QUERIES["url_sort"](spark, str(tmp_path)).collect()] == want


def test_profile_relevance_reads_the_whole_text(spark, tmp_path):
    rows = [(1, "en", "x " * 3000 + "the and that"), (2, "en", "x " * 3000), (3, "fr", "the and that " + "x " * 3000 + "les des que"), (4, None, None)]
    _write(spark, tmp_path, "documents", rows, "doc_id long, lang string, text string")
    got = {r.doc_id: (round(r.confidence, 6), r.best, r.n_foreign) for r in catalogue.QUERIES["profile_relevance"](spark, str(tmp_path)).collect()}
    # que is a word of two profiles
    assert got[1] == (0.25, "en", 0) and got[2][0] == 0 and got[3] == (0.75, "fr", 2) and got[4][0] == 0


def test_alignment_score_reads_the_whole_text(spark, tmp_path):
    head = " ".join(f"h{i:03d}" for i in range(40)).ljust(200)
    rows = [(1, head + "x " * 1000 + head), (2, head + "x " * 1000), (3, head + " ".join(f"t{i}" for i in range(400)) + " " + head), (4, "short"), (5, None)]
    _write(spark, tmp_path, "documents", rows, "doc_id long, text string")
    got = {r.doc_id: (r.score, r.aligned) for r in catalogue.QUERIES["alignment_score"](spark, str(tmp_path)).collect()}
    assert got[1] == (40 / 41, True) and got[2] == (0, False) and got[3] == (40 / 440, False) and got[4] == got[5] == (0, False)


def test_pending_changes_are_of_any_age(spark, tmp_path):
    first = dt.datetime(2024, 1, 1)
    rows = [(i, first + dt.timedelta(hours=i), "error" if i % 50 == 0 else "view", 1.0) for i in range(1000)]
    _write(spark, tmp_path, "events", rows, "event_id long, ts timestamp_ntz, event_type string, value double")
    want = [i for i in range(1000) if i % 50 == 0] + [i for i in range(1000) if i % 50][:480]
    assert [r.event_id for r in catalogue.QUERIES["pending_changes"](spark, str(tmp_path)).collect()] == want
