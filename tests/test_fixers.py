"""Fixers: what they take up, propose and accept, with a tagger that fails on some rows."""

from docloom.operators import fixers
from docloom.operators.taggers import rule_tagger

PACKS = fixers.Packs("other", ("culture",), {"health": ("hospital",), "law": ("statute",), "culture": ("museum",)}, {"police": ("police",), "treasury": ("treasury", "budget")}, {"north": (("border",), 2023)})
SCHEMA = "k long, title string, content string, summary string, operativity string, policy string, bodies string, special string, yr int, url string, extra string"
GOOD = "a summary of twenty characters or more"
TEXT = "The statute on the hospital was changed by the police. It shall be in force."


def records(spark):
    rows = [
        (1, "t", TEXT, GOOD, "unclear", "law", "police", None, 2020, "u", "x"),
        (2, "t", TEXT, GOOD, "operative", "other", "police", None, 2020, "u", "x"),
        (3, "t", TEXT, "t", "operative", "law", "police", None, 2020, "u", "x"),
        (4, "t", TEXT, GOOD, "operative", "culture", "treasury; police", None, 2020, "u", "x"),
        (5, "t", "Just a moment, please wait", "", "", "other", "", None, 2020, "gone", "x"),
        (6, "t", "boom " + TEXT, GOOD, "", "other", "police", None, 2020, "u", "x"),
        (7, "t", TEXT + " At the border.", GOOD, "operative", "law", "police", "women", 2024, "u", "x"),
        (8, "t", TEXT + " At the border.", GOOD, "operative", "law", "police", "women", 2022, "u", "x"),
        (9, "t", "Nothing that any list knows is said in this text at all, really.", GOOD, "operative", "other", "", None, 2020, "u", "x"),
        (10, None, None, None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def tagger():
    rules = rule_tagger(PACKS.keywords, ("shall",), PACKS.fallback)

    def model(title, text):
        if "boom" in text:
            raise RuntimeError("no answer")
        return rules(title, text)

    return model


def test_proposals_and_their_effect(spark):
    d = records(spark)
    found = fixers.proposals(d, "k", PACKS, tagger()).cache()
    got = {(r.k, r.fixer): (r.old, r.new) for r in found.collect()}
    assert got == {
        (1, "operativity"): ("unclear", "operative"), (2, "policy-tags"): ("other", "health; law"), (3, "summaries"): ("t", "The statute on the hospital was changed by the police."),
        (4, "policy-tags-defaults"): ("culture", "health; law"), (4, "government-bodies"): ("treasury; police", "police"), (7, "special-category"): ("women", "women; north")}
    after = {r.k: r for r in fixers.applied(d, found, "k", PACKS).collect()}
    before = {r.k: r for r in d.collect()}
    assert after[4].policy == "health; law" and after[4].bodies == "police" and after[1].operativity == "operative" and after[7].special == "women; north"
    assert all(after[k] == before[k] for k in (5, 6, 8, 9, 10)) and list(after[1].asDict()) == d.columns


def test_names_fallback_and_empty_tables(spark):
    d = records(spark)
    some = fixers.proposals(d, "k", PACKS, tagger(), names=["summaries", "no-such-fixer"])
    assert {(r.k, r.fixer) for r in some.collect()} == {(3, "summaries")}
    assert fixers.proposals(d, "k", PACKS, tagger(), names=["no-such-fixer"]).count() == 0
    assert fixers.proposals(d.limit(0), "k", PACKS, tagger()).count() == 0
    again = fixers.proposals(d, "k", PACKS, tagger(), fallback=rule_tagger(PACKS.keywords, ("shall",), PACKS.fallback))
    assert (6, "policy-tags", "health; law") in {(r.k, r.fixer, r.new) for r in again.collect()}


def test_garbage_is_read_again(spark):
    rows = [(1, "Just a moment", "good"), (2, "", "gate"), (3, None, "down"), (4, "x" * 100, "good"), (5, "short", None)]
    d = spark.createDataFrame(rows, "k long, content string, url string")

    def fetch(url):
        if url == "down":
            raise OSError("no route")
        return "<main>" + ("Access denied. " if url == "gate" else "Real text. ") * 20 + "</main>"

    listed = fixers.refetched(d, "k", fetch).collect()
    assert sorted(r.k for r in listed) == [1, 2, 3, 5] and {r.status for r in listed} == {"listed"}
    got = {r.k: (r.status, (r.new or "")[:10]) for r in fixers.refetched(d, "k", fetch, dry_run=False).collect()}
    assert got == {1: ("fetched", "Real text."), 2: ("no better", ""), 3: ("failed: OSError", ""), 5: ("no address", "")}
