"""Cases in which rows or texts could be lost: shared and null ids, control characters, chrome names around articles, many labels, long expressions."""

from collections import Counter

import pytest
from docloom.llm import chat, htmltext, langid, licenses, mixing, packing, secretscan

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_documents_without_an_id_draw_each_for_themselves(spark):
    rows = [(None if i % 2 else i, f"text {i}", "en", f"s{i % 2}", i) for i in range(2000)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    n = Counter((r.doc_id, r.text) for r in got)
    lost = sum((i, t) not in n for i, t, *_ in rows if i is None)
    assert 300 < lost < 430 and 900 < sum(c for (i, _), c in n.items() if i is None) < 1100  # of 1000, exp(-1) draw nothing
    assert len({r.mix_key for r in got}) == len(got)


def test_documents_that_share_an_id_draw_each_for_themselves(spark):
    rows = [(7, f"text {i}", "en", "s", i) for i in range(600)]
    n = Counter(r.text for r in mixing.mix(spark.createDataFrame(rows, DOCS)).collect())
    assert 300 < len(n) < 450 and max(n.values()) < 12


def test_identical_rows_are_drawn_together(spark, monkeypatch):
    rows = [(None, "the same", "en", "s", 0)] * 500 + [(1, "other", "en", "s", 0)] * 3 + [(1, "other", "de", "s", 0)] + [(i, f"t{i}", "en", "s", 0) for i in range(10, 110)]
    d = spark.createDataFrame(rows, DOCS).repartition(4)
    a = mixing.mix(d)
    got = a.collect()
    n = Counter((r.doc_id, r.text, r.lang) for r in got)
    assert 400 < n[None, "the same", "en"] < 600
    assert len({r.mix_key for r in got}) == len(got)
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert sorted(map(str, mixing.mix(d).collect())) == sorted(map(str, got))


def test_control_characters_are_letters_of_words(spark):
    rows = [(1, "a\x01b c", "en", "s", 0), (2, "\x01 \x02\x03", "en", "s", 0), (3, "x\x1cy z q w", "en", "s", 0)]
    got = {r.doc_id: r.n_words for r in packing.pack(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: 2, 2: 2, 3: 2}


@pytest.mark.parametrize("around", [
    '<form id="aspnetForm">{}</form>', '<div class="layout has-sidebar">{}</div>', '<div id="page" class="menu-closed">{}</div>', "<nav><ul><li>Home</ul>{}",
    '<div class="header-visible no-ads">{}</div>', "<form><div class='sidebar'>{}</div></form>", '<body class="nav-open cookie-notice">{}</body>', '<div class="widget"><form>{}</form></div>'])
@pytest.mark.parametrize("article", [
    "<article class='post comments-open'><h1>Title</h1><p>Body of the story.</article>", "<main><p>Title</p><p>Body of the story.</p></main>", "<div class='entry-content'><p>Title<p>Body of the story.</div>"])
def test_an_article_stays_whatever_is_around_it(around, article):
    page = "<html><header>Site name</header>" + around.format(f"<nav><a>Menu</a></nav>{article}<footer>Imprint</footer>") + "</html>"
    assert htmltext.split_page(page)[0] == "Title Body of the story."


def test_what_is_chrome_stays_chrome():
    page = (
        "<article><h1>Title</h1><p>Body.</p><form><p>Sign up here</p><input></form><div class='share-buttons'>Share</div><aside>Aside</aside>"
        "<div id='respond'>Leave a reply</div></article><div class='comments'><article class='comment'>First!</article><article>Second!</article></div>"
        "<div class='sidebar'><article class='teaser'>Other story</article></div>")
    assert htmltext.split_page(page)[0] == "Title Body."


def test_pages_without_any_mark_keep_their_text():
    page = "<div class='wrapper has-sidebar'><nav><a>Home</a></nav><div id='content'><p>The story itself.</p></div><div class='site-footer'>Imprint</div></div>"
    text, rest, _ = htmltext.split_page(page)
    assert text == "" and rest == ["The story itself."]
    wrapped = "<form action='/'><div class='sidebar-page'><p>The story itself.</p></div></form>"
    assert htmltext.split_page(wrapped)[1] == ["The story itself."]


def test_every_label_is_learned(spark):
    letters = [chr(0x4E00 + k) for k in range(400)]
    rows = [(k, " ".join([letters[k] * 3] * 5), f"l{k:03d}", "s", 0) for k in range(400)]
    model = langid.train(spark.createDataFrame(rows, DOCS))
    assert len(model.langs) == 400
    names, _ = model.predict([t for _, t, *_ in rows[::37]])
    assert names == [r[2] for r in rows[::37]]


def test_the_sample_stays_bounded_with_many_labels(spark, monkeypatch):
    monkeypatch.setattr(langid, "CHARACTERS", 4000)
    rows = [(k, f"word{k % 50} und noch mehr text " * 60, f"l{k % 50:02d}", "s", 0) for k in range(200)]
    model = langid.train(spark.createDataFrame(rows, DOCS))
    assert len(model.langs) == 50 and sum(a.size for a in model.automata) < 16_000


def test_expressions_of_any_length(spark):
    five = "SPDX-License-Identifier: MIT OR Apache-2.0 OR BSD-3-Clause OR Zlib OR ISC"
    many = "SPDX-License-Identifier: (MIT AND Ruby) OR GPL-2.0-or-later WITH Classpath-exception-2.0 OR Vim OR X11 OR NCSA OR W3C. Or else JSON and curl"
    got = {r.doc_id: sorted({x.label for x in r.found if x.score == 1.0}) for r in licenses.scan(spark.createDataFrame([(1, five), (2, many), (3, f"{five}\n{five}, or not")], "doc_id long, text string")).collect()}
    assert got[1] == got[3] == ["apache-2.0", "bsd-3-clause", "isc", "mit", "zlib"]
    assert set(got[2]) >= {"mit", "ruby", "gpl-2.0", "gpl-2.0-classpath", "vim", "x11", "ncsa", "w3c"}


def test_values_in_many_repositories_are_examples(spark):
    n = secretscan.EXAMPLE_REPOS
    rows = [(i, f"x token=zq81jsk29dkw9 {i}", "en", f"s{i % 2}", 0) for i in range(n)] + [(n + i, f"y token=mm81jsk29dkw9 {i}", "en", "s0", 0) for i in range(n)]
    rows += [(3 * n + i, f"z token=kk81jsk29dkw9 {i}", "en", f"s{i % 2}", 0) for i in range(n - 1)]
    got = {r.value: (r.is_example, r.is_live) for r in secretscan.classified(spark.createDataFrame(rows, DOCS).select("doc_id", "source", "text")).selectExpr("explode(found) AS x").select("x.*").collect()}
    # spread over owners and repositories; one owner's own value in many of its repositories; too few repositories
    assert got == {"zq81jsk29dkw9": (True, False), "mm81jsk29dkw9": (False, True), "kk81jsk29dkw9": (False, True)}


def test_branches_are_read_below_what_they_answer(spark):
    said = ["alpha beta gamma delta epsilon one", "> alpha beta gamma delta epsilon one\nred lorries pass every second night", "> alpha beta gamma delta epsilon one\nblue boats leave some third harbour",
            "> red lorries pass every second night\ngreen trains wait under four bridges", "a new thread with its own words", "> blue boats leave some third harbour\nfifth", "> green trains wait under four bridges\nsixth"]
    rows = [(1, i, "user", t) for i, t in enumerate(said)]
    got = [(r.turn, r.level) for r in chat.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()]
    assert got == [(0, 0), (1, 1), (3, 2), (6, 3), (2, 1), (5, 2), (4, 0)]
