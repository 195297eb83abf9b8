"""Operators, text functions, sources and streams on small frames."""

from pyspark.sql import functions as F

from docloom.functions import text
from docloom.operators import records
from docloom.sources import files, html
from docloom.streaming import metrics as streams


def test_text_functions(spark):
    d = spark.createDataFrame([("a; b;;a ", "The cat sat", "the cat ran")], "t string, x string, y string")
    r = d.select(
        text.join_tags(text.split_tags(F.col("t"))).alias("tags"),
        text.jaccard(text.word_set(F.col("x")), text.word_set(F.col("y"))).alias("j"),
        text.strip_prefixes(F.lit("bbword"), "b").alias("p"),
        text.strip_suffix(F.lit("walked"), ("ed", "d")).alias("s"),
        text.excerpt(F.lit("x" * 50), 10).alias("e"),
        text.clean(F.lit("a​  b c")).alias("c"),
    ).first()
    assert (r.tags, r.p, r.s, r.c) == ("a; b", "word", "walk", "a b c")
    assert r.j == 0.5 and r.e == "x" * 7 + " [...] " + "x" * 3


def test_records(spark):
    d = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, v int, s string")
    newest = records.keep_newest(d, ["k"], [F.col("v")])
    assert sorted(map(tuple, newest.collect())) == [(1, 2, "b"), (2, 1, "c")]
    up = spark.createDataFrame([(1, "z"), (2, ""), (3, "q")], "k int, s string")
    merged = records.merge_update(newest, up, "k", ["s"])
    assert sorted(map(tuple, merged.collect())) == [(1, 2, "z"), (2, 1, "c")]
    diff = records.snapshot_diff(newest.select("k", "s"), up, "k", ["s"])
    assert sorted((r.k, r.op) for r in diff.collect()) == [(1, "update"), (2, "update"), (3, "insert")]
    assert [r.k for r in records.anti_join_ingest(up, d, "k").collect()] == [3]
    issues = records.scan(d, "k", {"low": F.when(F.col("v") < 2, "high")}, ["low", "unknown"])
    assert issues.count() == 2
    dry = records.apply_fixes(newest, {"up": lambda x: x.withColumn("s", F.upper("s"))}, ["up"], "k")
    assert dry.count() == 2
    assert records.first_n(d, ["k"], [F.col("v").desc()], 1).count() == 2


def test_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"k": 1, "t": "x"}, {"k": 2, "t": null}]')
    assert files.json_list(spark, str(tmp_path / "a.json"), "k int, t string").count() == 2
    (tmp_path / "w.txt").write_text("Heading:\n# note\n\n  one \n  2→two\n")
    assert sorted(r.entry for r in files.line_list(spark, str(tmp_path / "w.txt")).collect()) == ["one", "two"]
    d = spark.createDataFrame([(1, 'say "hi"\nthere', None)], "k int, t string, u string")
    files.write_csv(d, str(tmp_path / "c"), ["t", "k", "u"])
    back = files.csv_records(spark, str(tmp_path / "c"), "t string, k int, u string").first()
    assert back.t == 'say "hi"\nthere' and back.k == 1
    d.write.parquet(str(tmp_path / "p"))
    out = files.upsert(spark, str(tmp_path / "p"), spark.createDataFrame([(1, "n", "m"), (2, "o", "p")], d.schema), ["k"], str(tmp_path / "q"))
    assert sorted((r.k, r.t) for r in out.collect()) == [(1, "n"), (2, "o")]

    class Stored(files.PagedCatalog):
        def fetch(self, skip, limit):
            return [{"id": i, "url": f"/pages/{i}"} for i in range(skip, min(skip + limit, int(self.options["total"])))]

    spark.dataSource.register(Stored)
    for total in (0, 1, 9, 10, 25, 70, 79):
        got = [r.id for r in spark.read.format("paged_catalog").option("total", total).option("pagesize", 10).load().collect()]
        assert sorted(got) == list(range(total))
    h = spark.createDataFrame([("<title>T</title><h1>A <b>B</b></h1><script>x</script><p>c</p>",)], "h string")
    r = html.with_page_parts(h, "h").select("page.title", "page.text").first()
    assert r.title == "A B" and r.text == "T A B c"


def test_main_content_takes_container_then_block_then_text():
    long, short = "word " * 60, "tiny"
    assert html.main_content(f"<div>{long}</div><div class='x-content'>{short}</div>") == long.strip()
    assert html.main_content(f"<p>{long}{long}</p><main>{long}<script>{long}</script></main>") == long.strip()
    assert html.main_content(f"<p>{long}</p><p>{long}{long}</p>") == (long + long).strip()
    assert html.main_content(f"<i>{long}</i>") == long.strip()
    assert html.main_content(short) == html.main_content(None) == html.main_content("") == ""


def _random_page(rng, depth=0):
    """HTML of a random tree, and its visible text by walking the tree."""
    words = [rng.choice(["alpha", "be&amp;ta", "gam&#109;a", "d&eacute;lta", "a < b", "1 &gt; 0"]) for _ in range(rng.randint(1, 4))]
    plain = {"be&amp;ta": "be&ta", "gam&#109;a": "gamma", "d&eacute;lta": "délta", "a < b": "a < b", "1 &gt; 0": "1 > 0"}
    html, text = " ".join(words), " ".join(plain.get(w, w) for w in words)
    for _ in range(rng.randint(0, 3) if depth < 4 else 0):
        tag = rng.choice(["div", "p", "b", "i", "span", "li", "script", "style", "section", "br", "img", "!--"])
        inner, seen = _random_page(rng, depth + 1)
        if tag == "!--":
            html += "<!-- <p>hidden</p> -->"
        elif tag in ("br", "img"):
            html, text = html + f"<{tag} alt='>'>" + inner, text + ("\n" if tag == "br" else "") + seen
        elif tag in ("script", "style"):
            html += f"<{tag}>if (a) {{ x = 1 }}</{tag}>"
        else:
            attrs = rng.choice(["", " class=\"x > y\"", " data-a='<b>'", " hidden"])
            part = "" if tag in ("b", "i", "span") else "\n"
            html, text = html + f"<{tag.upper() if rng.random() < 0.3 else tag}{attrs}>{inner}</{tag}>", text + part + seen + part
    return html, text


def test_page_text_equals_a_walk_over_the_tree():
    import random

    rng = random.Random(6)
    for _ in range(300):
        page, text = _random_page(rng)
        got = html.page_text(f"<html><body>{page}</body></html>")
        assert got.text == " ".join(text.split()), page
        assert got.title == got.text[:60].strip()
        assert html.page_text(f"<head><title>The title</title></head>{page}").title == "The title"
        assert html.page_text(f"<head><title>The title</title></head>{page}<h1> </h1><h1>A <b>head</b>ing</h1>").title == "A heading"


def test_odd_pages():
    long = "word " * 60
    assert html.page_text(None) == html.page_text("") == (None, "", "")
    assert html.page_text("<p>open <b>never closed <div>x").text == "open never closed x"
    assert html.page_text("<ul><li>one<li>two</ul></div></p>three").text == "one two three"
    assert html.page_text("a<script>if (x < 3) '</p>'</script>b<style>p {}</style>c").text == "abc"
    assert html.page_text(f"<table><tr><td>a</td><td>b</td></tr></table><div class='content'>{long}<br/>end</div>").main == long + "end"
    assert html.page_text("x" * 101).main == "x" * 101 and html.page_text("1" * 300 + "<main>" + "2" * 300 + "</main>").main == "1" * 300 + " " + "2" * 300
    assert html.page_text("&lt;b&gt; &nbsp;&unknown; &#x41;").text == "<b> &unknown; A"


def test_streams_equal_batch(spark, tmp_path):
    src = spark.range(300).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 600 + 86400).alias("ts"), (F.col("id") % 3).alias("user_id"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("event_type"), (F.col("id") % 200 + 0.0).alias("value"), F.lit("{}").alias("props"))
    for i in range(3):
        src.where(f"event_id >= {i * 100} AND event_id < {i * 100 + 100}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run(df, name, mode):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.table(name)

    stream = streams.events(spark, str(tmp_path / "in"), 100)
    got = {(r.event_type, r.window_start): r.n for r in run(streams.tumbling(stream), "tumbling", "complete").collect()}
    want = {(r.event_type, r.w): r.n for r in src.groupBy("event_type", F.date_trunc("hour", "ts").alias("w")).agg(F.count("*").alias("n")).collect()}
    assert got == want
    assert run(streams.dedup(stream), "dedup", "append").count() == 300
    for period, accuracy in (("hour", 10_000), ("day", 10_000), ("week", 10_000), ("week", 20)):
        by = {}
        for r in src.select("event_type", F.unix_seconds("ts").alias("s"), "value").collect():
            at = {"hour": r.s // 3600 * 3600, "day": r.s // 86400 * 86400, "week": (r.s - 3 * 86400) // (7 * 86400) * 7 * 86400 + 3 * 86400}[period]
            by.setdefault((r.event_type, at), []).append(r.value)
        got = run(streams.periods(stream, period, accuracy=accuracy), f"p_{period}_{accuracy}", "complete").select("event_type", F.unix_seconds("window_start").alias("s"), "n", "median", "lo", "hi").collect()
        assert {(r.event_type, r.s): r.n for r in got} == {k: len(v) for k, v in by.items()}
        for r in got:
            values = sorted(by[r.event_type, r.s])
            low, high = sum(v < r.median for v in values), sum(v <= r.median for v in values)
            assert r.median in values and low <= len(values) / 2 + len(values) / accuracy + 1 and high >= len(values) / 2 - len(values) / accuracy - 1
            assert (r.lo, r.hi) == (values[0], values[-1])
    sent = run(streams.cooldown(stream), "cooldown", "append")
    assert 0 < sent.count() < src.where("value > 75").count()
