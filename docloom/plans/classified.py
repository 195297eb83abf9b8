"""Classifications of tagged records by column: issues, suspicion, entities, inline warnings, sort keys, dates, suggestions.

The engine's side is DataFrame functions, the oracles are SQL written apart; they
share only the text that makes records of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import jaccard, word_set
from docloom.plans import tagged
from docloom.plans.dialect import DUCK, Dialect, runner

LAST_DAY = "2027-06-30"  # what counts as today
OLDEST = "1993-01-01"
DOMAIN = "https://www.example.org/"

#: this library's own: thirteen patterns of a class in the order they are tried
CLASS_PATTERNS: tuple[tuple[str, str], ...] = (
    ("operative", r"(^|\W)to appoint\W"), ("operative", r"shall (be|pay|report)"), ("operative", r"is (hereby )?allocated"), ("operative", r"(approve|approves|approved) (the|a)\W"), ("operative", r"term of office"),
    ("operative", r"instructs? the"), ("operative", r"by the (treasury|press office)"), ("declarative", r"takes? note"), ("declarative", r"express(es)? (its )?thanks"), ("declarative", r"it welcomes"),
    ("declarative", r"^congratulat"), ("declarative", r"is (of the )?opinion"), ("declarative", r"welcomes women"))


def _z(d: Dialect) -> str:
    """z: records with a date, an address, a number and a state."""
    day = d("date_add(CAST('1988-03-01' AS DATE), CAST((doc_id * 37) % 15000 AS INT))", "CAST('1988-03-01' AS DATE) + CAST((doc_id * 37) % 15000 AS INTEGER)")
    text = lambda x: f"CAST({x} AS VARCHAR(20))"
    url = f"CASE doc_id % 8 WHEN 0 THEN '' WHEN 1 THEN 'http://other.example/' || {text('doc_id')} WHEN 2 THEN '{DOMAIN}act-' || {text('doc_id % 50')} || 'b-20' || {text('10 + doc_id % 15')} WHEN 3 THEN '{DOMAIN}' || {text('25 + doc_id % 13')} || '_vol' || {text('doc_id % 70')} WHEN 4 THEN '{DOMAIN}2012_vol' || {text('doc_id % 70')} WHEN 5 THEN '{DOMAIN}about' ELSE '{DOMAIN}act-' || {text('doc_id % 50')} || '-20' || {text('10 + doc_id % 15')} || CASE WHEN doc_id % 3 = 0 THEN 'c' ELSE '' END END"
    return f"""{tagged.records(d)}, z AS (SELECT doc_id, record_key, title, low, len, CASE doc_id % 29 WHEN 0 THEN '' WHEN 1 THEN summary WHEN 2 THEN title WHEN 3 THEN content || ' (to be continued)' WHEN 4 THEN 'test ' || content ELSE content END AS content,
  CASE doc_id % 12 WHEN 0 THEN '' WHEN 1 THEN 'short' WHEN 2 THEN title ELSE summary END AS summary, operativity, policy, bodies, places, tags, body_list, place_list, op_hits, decl_hits,
  CAST(25 + doc_id % 13 AS BIGINT) AS gov, CASE WHEN doc_id % 31 = 0 THEN '12345678901' ELSE {text('doc_id % 40')} END AS number, {url} AS url, CASE WHEN doc_id % 17 = 0 THEN NULL ELSE {day} END AS day,
  doc_id % 3 = 0 AS processed FROM a)"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runner(lambda d: f"WITH {_z(d)} SELECT * FROM z")(spark, sf_dir)


def _has(column: str, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(F.col(column), F.lit(w))
    return out


def issue_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven issue columns of each record (content, summary, tags, bodies, address, class, date), null where there is none."""
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "")
    n = lambda c: F.size(F.split(c, ";"))
    r = _records(spark, sf_dir)
    return r.select(
        "doc_id",
        F.when(blank("content"), "missing_content").when(F.col("content").like("%(to be continued)%"), "truncated_content").when(F.length("content") < 50, "short_content").alias("content_issue"),
        F.when(blank("summary"), "missing_summary").when(F.length("summary") < 20, "short_summary").when(F.length("summary") > 500, "long_summary").alias("summary_issue"),
        F.when(blank("policy"), "missing_tags").when(n("policy") > 3, "excessive_tags").alias("tag_issue"), F.when(blank("bodies"), "missing_bodies").when(n("bodies") > 1, "excessive_bodies").alias("body_issue"),
        F.when(blank("url"), "missing_address").when(~F.col("url").like(DOMAIN + "%"), "invalid_domain").alias("url_issue"),
        F.when(F.col("operativity").isNull(), "missing_class").when(~F.col("operativity").isin("operative", "declarative"), "invalid_class").alias("class_issue"),
        F.when(F.col("day").isNull(), "missing_date").when((F.col("day") < OLDEST) | (F.col("day") > F.date_add(F.lit(LAST_DAY).cast("date"), 30)), "invalid_date").alias("date_issue"))


#: flag -> weight, in the order flags are listed
WEIGHTS = {"duplicate_title": 25, "test_content": 40, "content_is_summary": 30, "content_is_title": 35, "future_date": 50, "very_old_date": 20, "wrong_domain": 15, "long_number": 10}


def suspicion_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a suspicion score over 0: eight weighted flags, the risk level, previews."""
    r = _records(spark, sf_dir).withColumn("th", F.md5(F.trim(F.regexp_replace("title", r"\s+", " "))))
    many = r.groupBy("th").agg(F.count("*").alias("n")).where("n > 1").select(F.col("th").alias("mh"))
    r = r.join(many, F.col("th") == F.col("mh"), "left")
    test = {
        "duplicate_title": F.col("mh").isNotNull(), "test_content": F.lower("content").rlike(r"^(test|lorem ipsum|sample).*"), "content_is_summary": (F.col("content") == F.col("summary")) & (F.col("content") != ""),
        "content_is_title": F.col("content") == F.col("title"), "future_date": F.col("day") > LAST_DAY, "very_old_date": F.col("day") < OLDEST, "wrong_domain": ~F.col("url").like(DOMAIN + "%"), "long_number": F.length("number") > 10}
    flags = F.array_compact(F.array(*[F.when(test[f], F.lit(f)) for f in WEIGHTS]))
    score = sum((F.when(test[f], w).otherwise(0) for f, w in WEIGHTS.items()), F.lit(0)).cast("long")
    risk = F.when(F.col("score") >= 70, "CRITICAL").when(F.col("score") >= 50, "HIGH").when(F.col("score") >= 30, "MEDIUM").when(F.col("score") >= 15, "LOW").otherwise("CLEAN")
    return r.select("doc_id", "day", score.alias("score"), flags.alias("f"), F.substring("content", 1, 200).alias("content_preview"), F.substring("summary", 1, 100).alias("summary_preview")).where("score > 0").orderBy(
        F.desc("score"), F.desc("day"), "doc_id").select("doc_id", "score", F.array_join("f", ",").alias("flags"), F.size("f").cast("long").alias("n_flags"), risk.alias("risk"), "content_preview", "summary_preview")


def entity_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each government: counts, first and last day, mean score (50 where a record has none), serious issues and their rate, tag counts, all its tags sorted."""
    r = _records(spark, sf_dir)
    score = F.when(F.col("doc_id") % 7 == 0, None).otherwise(F.least(F.lit(100), F.col("len") / 20))
    serious = (F.col("content") == "") | F.col("day").isNull()
    g = r.groupBy("gov").agg(
        F.count("*").alias("n"), F.date_format(F.min("day"), "yyyy-MM-dd").alias("first_day"), F.date_format(F.max("day"), "yyyy-MM-dd").alias("last_day"), F.round(F.avg(F.coalesce(score, F.lit(50.0))), 6).alias("mean_score"),
        F.count_if(serious).alias("n_serious"), F.round(F.lit(100.0) * F.count_if(serious) / F.count("*"), 1).alias("serious_rate"), F.count_if(F.col("policy") != "").alias("n_tagged"), F.count_if(F.col("bodies") != "").alias("n_bodies"))
    tags = r.select("gov", F.explode("tags").alias("t")).groupBy("gov").agg(F.array_join(F.array_sort(F.collect_set("t")), ",").alias("all_tags")).withColumnRenamed("gov", "g")
    return g.join(tags, F.col("gov") == F.col("g"), "left").drop("g")


def inline_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings of a record before it is stored, in nine groups of rules: class unclear, only the fallback, tags, places and bodies without a word, summary, class against text, default bodies, default tag."""
    kw = F.create_map(*[x for t, ws in tagged.KEYWORDS.items() for x in (F.lit(t), F.array(*map(F.lit, ws)))])
    words = F.create_map(*[x for b, ws in tagged.BODY_WORDS.items() for x in (F.lit(b), F.array(*map(F.lit, ws)))])
    said = lambda xs: F.exists(xs, lambda w: F.contains(F.col("low"), w))
    none = F.array().cast("array<string>")
    named = lambda b: said(F.coalesce(words[b], F.array(b)))
    tags = F.transform(F.filter("tags", lambda t: ~t.isin(tagged.FALLBACK, "admin", "appointments") & ~F.coalesce(said(kw[t]), F.lit(True))), lambda t: F.concat(F.lit("tag without a word: "), t))
    places = F.transform(F.filter("place_list", lambda p: ~F.contains(F.col("low"), p)), lambda p: F.concat(F.lit("place not found: "), p))
    bodies = F.transform(F.filter("body_list", lambda b: ~named(b)), lambda b: F.concat(F.lit("body not mentioned: "), b))
    one = lambda cond, text: F.when(cond, F.array(F.lit(text))).otherwise(none)
    s = F.length("summary")
    cls = F.col("operativity")
    every = F.concat(
        one(cls == "n/a", "class unclear"), one(F.trim("policy") == tagged.FALLBACK, "only the fallback tag"), tags, places, bodies,
        one((s > 0) & (s < 20), "summary too short"), one(s > 800, "summary too long"), one((s > 0) & (F.trim("summary") == F.trim("title")), "summary is the title"),
        one((cls == "operative") & (F.col("decl_hits") > 0) & (F.col("op_hits") == 0), "operative by class only"), one((cls == "declarative") & (F.col("op_hits") > 0) & (F.col("decl_hits") == 0), "declarative by class only"),
        one(F.trim("bodies").isin(*tagged.COMBOS) & ~F.exists("body_list", named), "default bodies"),
        one((F.size("tags") == 1) & F.col("tags")[0].isin(*tagged.SUSPICIOUS) & ~said(kw[F.col("tags")[0]]), "default tag"))
    return _records(spark, sf_dir).where("size(tags) >= 0").select("doc_id", every.alias("w")).select("doc_id", F.array_join("w", "; ").alias("warnings"), F.size("w").cast("long").alias("n_warnings"))


def number_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One issue for each record whose government and number others have as well, with how many they are and the ids of the first hundred; the list is made once a group and joined."""
    r = _records(spark, sf_dir).select("doc_id", "gov", "number")
    ids = r.groupBy("gov", "number").agg(F.count("*").alias("n")).where("n > 1").select(F.col("gov").alias("g"), F.col("number").alias("m"), "n")
    same = (F.col("gov") == F.col("g")) & (F.col("number") == F.col("m"))
    first = r.withColumn("i", F.expr("row_number() OVER (PARTITION BY gov, number ORDER BY doc_id)")).where("i <= 100").groupBy("gov", "number").agg(F.array_join(F.array_sort(F.collect_list("doc_id")).cast("array<string>"), ",").alias("ids")).select(
        F.col("gov").alias("g"), F.col("number").alias("m"), "ids")
    return r.join(ids, same).drop("g", "m").join(first, same).select("doc_id", "gov", "number", "n", "ids")


def scan_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten issues of each column of ``issue_columns`` with the value at fault, cut at 200 characters, and the rate of the issue."""
    r, i = _records(spark, sf_dir), issue_columns(spark, sf_dir)
    fields = {"content_issue": "content", "summary_issue": "summary", "url_issue": "url", "class_issue": "operativity"}
    i = i.join(r.select(F.col("doc_id").alias("d"), *fields.values()), F.col("doc_id") == F.col("d"))
    rows = i.select("doc_id", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("issue"), F.substring(v, 1, 200).alias("value")) for c, v in fields.items()])).alias("x")).select("doc_id", "x.*").where("issue IS NOT NULL")
    total = r.agg(F.count("*").alias("total"))
    n = rows.groupBy("field").agg(F.count("*").alias("n")).crossJoin(total).select(F.col("field").alias("f"), "n", (F.lit(100.0) * F.col("n") / F.col("total")).alias("rate"))  # a row a field, a row in all
    top = rows.withColumn("i", F.expr("row_number() OVER (PARTITION BY field ORDER BY doc_id)")).where("i <= 10").drop("i")
    return top.join(n, F.col("field") == F.col("f")).drop("f")


def change_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes by operation, field, priority and state, with the recommendation each group gets by its size and kind."""
    r = _records(spark, sf_dir)
    op = F.when(F.col("doc_id") % 11 == 0, "insert").when(F.col("doc_id") % 13 == 0, "delete").otherwise("update")
    fields = F.when(op == "update", F.array_compact(F.array(F.when(F.col("doc_id") % 2 == 0, "policy"), F.when(F.col("doc_id") % 3 == 1, "operativity"), F.when(F.col("doc_id") % 5 == 2, "content"), F.lit("updated_at")))).otherwise(F.array(F.lit("all")))
    c = r.select(op.alias("op"), F.when(op == "delete", 3).when(op == "insert", 2).otherwise(1).cast("long").alias("priority"), "processed", F.explode(fields).alias("field"))
    g = c.groupBy("op", "field", "priority", "processed").agg(F.count("*").alias("n"))
    advice = F.when(~F.col("processed") & (F.col("n") > 500), "run the incremental scan now").when((F.col("op") == "insert") & ~F.col("processed"), "run all checks on new records").when(
        F.col("field") == "policy", "check tags against texts").when(F.col("field") == "operativity", "check classes against texts").otherwise("none")
    return g.withColumn("recommendation", advice)


def address_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by address: year down, number down, suffix down, ending down; the older form takes its first number as a year, or as one from 1990 on; unknown forms last. The four parts of the key are columns."""
    new, old = r"/act-([0-9]+)([a-z]?)-([0-9]{4})([a-z]?)", r"/([0-9]+)_vol([0-9]+)"
    part = lambda p, k: F.regexp_extract("url", p, k)
    letter = lambda c: F.when(c == "", 0).otherwise(F.ascii(c)).cast("long")
    first = F.when(part(old, 1) != "", part(old, 1)).cast("long")
    zero = F.lit(0).cast("long")
    is_new, is_old = F.col("url").rlike(new), F.col("url").rlike(old)
    key = F.when(is_new, F.struct((-F.nullif(part(new, 3), F.lit("")).cast("long")).alias("a"), (-F.nullif(part(new, 1), F.lit("")).cast("long")).alias("b"), (-letter(part(new, 2))).alias("c"), (-letter(part(new, 4))).alias("d"))).when(
        is_old, F.struct((-F.when(first >= 1900, first).otherwise(first + 1990)).alias("a"), (-F.nullif(part(old, 2), F.lit("")).cast("long")).alias("b"), zero.alias("c"), zero.alias("d"))).otherwise(
        F.struct(F.lit(1).cast("long").alias("a"), zero.alias("b"), zero.alias("c"), zero.alias("d")))
    k = _records(spark, sf_dir).select("doc_id", "url", key.alias("k"))
    return k.orderBy("k", "url", "doc_id").select("doc_id", "url", F.col("k.a").alias("by_year"), F.col("k.b").alias("by_number"), F.col("k.c").alias("by_suffix"), F.col("k.d").alias("by_ending"))


def text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first DD.MM.YYYY of each text, as ISO: null where the day doesn't exist or lies before 1948 or more than a year ahead. Texts hold the dates of other records, impossible ones, and numbers that only look like dates."""
    found = F.regexp_extract("t", r"\b([0-9]{2}[.][0-9]{2}[.][0-9]{4})\b", 1)
    day = F.try_to_date(F.nullif(found, F.lit("")), "dd.MM.yyyy")
    ok = day.between(F.lit("1948-01-01").cast("date"), F.add_months(F.lit(LAST_DAY).cast("date"), 12))
    r = runner(lambda d: f"WITH {_z(d)} SELECT doc_id, {_dated(d)} AS t FROM z")(spark, sf_dir)
    return r.select("doc_id", F.nullif(found, F.lit("")).alias("found"), F.when(ok, F.date_format(day, "yyyy-MM-dd")).alias("day"))


def _dated(d: Dialect) -> str:
    """A text with a date: another record's, an impossible one, one out of range, or none."""
    other = d("date_format(date_add(CAST('1930-01-01' AS DATE), CAST((doc_id * 91) % 36500 AS INT)), 'dd.MM.yyyy')", "strftime(CAST('1930-01-01' AS DATE) + CAST((doc_id * 91) % 36500 AS INTEGER), '%d.%m.%Y')")
    return f"substring(low, 1, 80) || CASE doc_id % 7 WHEN 0 THEN ' on 31.02.2015 and 01.01.2016' WHEN 1 THEN ' no. 12.345.6789, 112.10.20201' WHEN 2 THEN '' ELSE ' signed ' || {other} || ', not 02.02.2002' END"


def tag_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags that the list doesn't know, with the listed one whose words they share by more than 0.7 (the best, ties the first), else none. Tags are part names with a word added, left out or turned round; the list is the names that are common."""
    p = runner(lambda d: f"SELECT p_partkey, lower(p_name) || ' ' || lower(p_type) || ' part of the ' || lower(p_brand) || ' range' AS name FROM {d.t('part')} WHERE p_name IS NOT NULL AND p_type IS NOT NULL AND p_brand IS NOT NULL")(spark, sf_dir)
    said = F.when(F.col("p_partkey") % 4 == 0, F.concat("name", F.lit(" new"))).when(F.col("p_partkey") % 4 == 1, F.regexp_replace("name", "^([^ ]+) ([^ ]+) ", "$2 $1 ")).when(F.col("p_partkey") % 4 == 2, F.regexp_replace("name", " part of", "")).otherwise(F.col("name"))
    known = p.where("p_partkey % 3 = 0").select("name").distinct().withColumn("e", word_set(F.col("name")))
    tags = p.select(said.alias("tag")).distinct().join(known.select(F.col("name").alias("k")), F.col("tag") == F.col("k"), "left_anti").withColumn("w", word_set(F.col("tag")))
    # sets of that similarity share one of the rarest words of either: those that are left when 0.7 of them are taken away
    every = known.select(F.explode("e").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    rare = lambda df, id_, words: df.select(id_, words, F.explode(words).alias("word")).join(every, "word").groupBy(id_, words).agg(F.sort_array(F.collect_list(F.struct("df", "word"))).alias("s")).select(
        id_, words, F.explode(F.slice("s", F.lit(1), F.size(words) - F.floor(F.size(words) * 0.7).cast("int"))).alias("x")).select(id_, words, F.col("x.word").alias("word"))
    pairs = rare(tags, "tag", "w").join(rare(known, "name", "e"), "word").select("tag", "name", jaccard(F.col("w"), F.col("e"), 1.0).alias("j")).distinct().where("j > 0.7")
    best = pairs.groupBy("tag").agg(F.min_by("name", F.struct(-F.col("j"), "name")).alias("suggestion")).withColumnRenamed("tag", "t")
    return tags.join(best, F.col("tag") == F.col("t"), "left").select("tag", F.coalesce("suggestion", F.lit("")).alias("suggestion"))


def class_by_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each record by thirteen ordered patterns: a class is turned if any pattern of the other one matches, and an unclear one takes that of the first that does."""
    hits = F.array_compact(F.array(*[F.when(F.col("low").rlike(p), F.lit(i)) for i, (_, p) in enumerate(CLASS_PATTERNS)]))
    kinds = F.array(*[F.lit(c) for c, _ in CLASS_PATTERNS])
    r = _records(spark, sf_dir).select("doc_id", F.trim("operativity").alias("given"), hits.alias("h")).withColumn("said", F.transform("h", lambda i: F.element_at(kinds, i + 1)))
    turned = F.when(F.col("given") == "operative", F.when(F.array_contains("said", "declarative"), "declarative").otherwise("operative")).when(
        F.col("given") == "declarative", F.when(F.array_contains("said", "operative"), "operative").otherwise("declarative")).otherwise(F.coalesce(F.try_element_at("said", F.lit(1)), F.col("given")))
    return r.select("doc_id", "given", turned.alias("class"), F.size("h").cast("long").alias("n_patterns"))


FORBIDDEN_PREFIX = "Decision number"


def _loads(d: Dialect) -> str:
    """l: records as they come before a load: a date and a key as text, some of them missing or wrong."""
    text = lambda x: f"CAST({x} AS VARCHAR(20))"
    iso = d("date_format(day, 'yyyy-MM-dd')", "strftime(day, '%Y-%m-%d')")
    return f"""{_z(d)}, l AS (SELECT doc_id, gov, number, content, summary, tags, body_list, policy, bodies, trim(operativity) AS operativity,
  CASE doc_id % 14 WHEN 0 THEN '' WHEN 1 THEN '12.05.2020' WHEN 2 THEN '2021-02-30' WHEN 3 THEN '1890-01-01' WHEN 4 THEN '2044-01-01' ELSE coalesce({iso}, '') END AS day_text,
  CASE doc_id % 9 WHEN 0 THEN '' WHEN 1 THEN {text('gov')} || '-' || number WHEN 2 THEN '99_' || number WHEN 3 THEN {text('gov')} || '_' || number || 'a' ELSE {text('gov')} || '_' || number END AS record_key FROM z)"""


def preload_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record before the load: errors (incomplete, date, key against government and number, class), warnings (length, prefix of the summary, tags and bodies that no list has, no tags), whether it loads, and the key it loads under."""
    r = runner(lambda d: f"WITH {_loads(d)} SELECT * FROM l")(spark, sf_dir)
    day, key, want = F.col("day_text"), F.col("record_key"), F.concat_ws("_", F.col("gov").cast("string"), "number")
    form = day.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    parsed = F.try_to_date(F.when(form, day), "yyyy-MM-dd")
    n = F.length("content")
    when = lambda c, text: F.when(c, F.lit(text))
    errors = F.array_compact(F.array(
        when((day == "") | (n == 0), "incomplete"), when((day != "") & ~form, "date form"), when(form & parsed.isNull(), "no such day"), when(parsed.isNotNull() & ~F.year(parsed).between(1948, 2027), "year out of range"),
        when((key != "") & ~key.rlike("^[0-9]+_[0-9]+[a-z]?$"), "key form"), when(key.rlike("^[0-9]+_[0-9]+[a-z]?$") & (key != want), "key is not government and number"), when(~F.col("operativity").isin("operative", "declarative"), "class")))
    unknown = lambda c, known: F.filter(c, lambda x: ~x.isin(*known))
    warnings = F.array_compact(F.array(
        when((n > 0) & (n < 100), "short content"), when(n > 5000, "long content"), when(F.startswith("summary", F.lit(FORBIDDEN_PREFIX)), "forbidden prefix"),
        F.when(F.size(unknown("tags", tagged.TAG_LIST)) > 0, F.concat(F.lit("unknown tags: "), F.array_join(unknown("tags", tagged.TAG_LIST), ", "))),
        F.when(F.size(unknown("body_list", tuple(tagged.BODY_WORDS))) > 0, F.concat(F.lit("unknown bodies: "), F.array_join(unknown("body_list", tuple(tagged.BODY_WORDS)), ", "))), when(F.size("tags") == 0, "no tags")))
    return r.select("doc_id", F.when(key == "", want).otherwise(key).alias("load_key"), (key == "").alias("key_made"), errors.alias("e"), warnings.alias("w")).select(
        "doc_id", "load_key", "key_made", F.array_join("e", "; ").alias("errors"), F.array_join("w", "; ").alias("warnings"), (F.size("e") == 0).alias("loads"))


def _oracles() -> dict[str, str]:
    z, d = f"WITH {_z(DUCK)}", DUCK
    days = f"day < DATE '{OLDEST}' OR day > DATE '{LAST_DAY}' + 30"
    issues = f"""CASE WHEN coalesce(content, '') = '' THEN 'missing_content' WHEN contains(content, '(to be continued)') THEN 'truncated_content' WHEN length(content) < 50 THEN 'short_content' END AS content_issue,
  CASE WHEN coalesce(summary, '') = '' THEN 'missing_summary' WHEN length(summary) < 20 THEN 'short_summary' WHEN length(summary) > 500 THEN 'long_summary' END AS summary_issue,
  CASE WHEN policy = '' THEN 'missing_tags' WHEN length(policy) - length(replace(policy, ';', '')) >= 3 THEN 'excessive_tags' END AS tag_issue, CASE WHEN bodies = '' THEN 'missing_bodies' WHEN contains(bodies, ';') THEN 'excessive_bodies' END AS body_issue,
  CASE WHEN url = '' THEN 'missing_address' WHEN NOT starts_with(url, '{DOMAIN}') THEN 'invalid_domain' END AS url_issue, CASE WHEN operativity NOT IN ('operative', 'declarative') THEN 'invalid_class' END AS class_issue,
  CASE WHEN day IS NULL THEN 'missing_date' WHEN {days} THEN 'invalid_date' END AS date_issue"""
    flags = [("duplicate_title", "count(*) OVER (PARTITION BY trim(regexp_replace(title, '\\s+', ' ', 'g'))) > 1"), ("test_content", "lower(content) SIMILAR TO '(test|lorem ipsum|sample)(.|\n)*'"), ("content_is_summary", "content = summary AND content <> ''"),
             ("content_is_title", "content = title"), ("future_date", f"day > DATE '{LAST_DAY}'"), ("very_old_date", f"day < DATE '{OLDEST}'"), ("wrong_domain", f"NOT starts_with(url, '{DOMAIN}')"), ("long_number", "length(number) > 10")]
    arr = "[" + ", ".join(f"CASE WHEN {c} THEN '{f}' END" for f, c in flags) + "]"
    weight = "list_sum(list_transform(f, lambda x: CASE x " + " ".join(f"WHEN '{f}' THEN {w}" for f, w in WEIGHTS.items()) + " END))"
    tag_words = " UNION ALL ".join(f"SELECT '{t}' AS tag, '{w}' AS word" for t, ws in tagged.KEYWORDS.items() for w in ws)
    body_words = " UNION ALL ".join(f"SELECT '{b}' AS body, '{w}' AS word" for b, ws in tagged.BODY_WORDS.items() for w in ws)
    body_named = "CASE WHEN EXISTS (SELECT 1 FROM bw WHERE bw.body = u.x) THEN EXISTS (SELECT 1 FROM bw WHERE bw.body = u.x AND contains(u.low, word)) ELSE contains(u.low, u.x) END"
    pats = " UNION ALL ".join(f"SELECT {i} AS i, '{c}' AS c, '{p}' AS p" for i, (c, p) in enumerate(CLASS_PATTERNS))
    num = "regexp_extract(url, '/act-([0-9]+)([a-z]?)-([0-9]{4})([a-z]?)', ['n', 's', 'y', 'e'])"
    fields = {"content_issue": "content", "summary_issue": "summary", "url_issue": "url", "class_issue": "operativity"}
    listed = lambda xs: "[" + ", ".join(map(repr, xs)) + "]"
    off = lambda c, xs: f"list_filter({c}, lambda x: NOT list_contains({listed(xs)}, x))"
    return {
        "preload_validation": f"""WITH {_loads(DUCK)}, p AS (SELECT *, regexp_full_match(day_text, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AS form, try_cast(day_text AS DATE) AS d, regexp_full_match(record_key, '[0-9]+_[0-9]+[a-z]?') AS keyed, gov::VARCHAR || '_' || number AS want FROM l),
m AS (SELECT doc_id, 1 AS g, 'e' AS k, 'incomplete' AS t FROM p WHERE day_text = '' OR content = '' UNION ALL SELECT doc_id, 2, 'e', 'date form' FROM p WHERE day_text <> '' AND NOT form UNION ALL SELECT doc_id, 3, 'e', 'no such day' FROM p WHERE form AND d IS NULL
  UNION ALL SELECT doc_id, 4, 'e', 'year out of range' FROM p WHERE form AND (year(d) < 1948 OR year(d) > 2027) UNION ALL SELECT doc_id, 5, 'e', 'key form' FROM p WHERE record_key <> '' AND NOT keyed
  UNION ALL SELECT doc_id, 6, 'e', 'key is not government and number' FROM p WHERE keyed AND record_key <> want UNION ALL SELECT doc_id, 7, 'e', 'class' FROM p WHERE operativity NOT IN ('operative', 'declarative')
  UNION ALL SELECT doc_id, 1, 'w', 'short content' FROM p WHERE length(content) BETWEEN 1 AND 99 UNION ALL SELECT doc_id, 2, 'w', 'long content' FROM p WHERE length(content) > 5000 UNION ALL SELECT doc_id, 3, 'w', 'forbidden prefix' FROM p WHERE starts_with(summary, '{FORBIDDEN_PREFIX}')
  UNION ALL SELECT doc_id, 4, 'w', 'unknown tags: ' || array_to_string({off('tags', tagged.TAG_LIST)}, ', ') FROM p WHERE len({off('tags', tagged.TAG_LIST)}) > 0
  UNION ALL SELECT doc_id, 5, 'w', 'unknown bodies: ' || array_to_string({off('body_list', tuple(tagged.BODY_WORDS))}, ', ') FROM p WHERE len({off('body_list', tuple(tagged.BODY_WORDS))}) > 0 UNION ALL SELECT doc_id, 6, 'w', 'no tags' FROM p WHERE len(tags) = 0)
SELECT p.doc_id, any_value(CASE WHEN record_key = '' THEN want ELSE record_key END) AS load_key, any_value(record_key = '') AS key_made, coalesce(string_agg(t, '; ' ORDER BY g) FILTER (k = 'e'), '') AS errors, coalesce(string_agg(t, '; ' ORDER BY g) FILTER (k = 'w'), '') AS warnings,
  count(*) FILTER (k = 'e') = 0 AS loads FROM p LEFT JOIN m ON p.doc_id = m.doc_id GROUP BY p.doc_id""",
        "issue_columns": f"{z} SELECT doc_id, {issues} FROM z",
        "suspicion_scores": f"""{z}, s AS (SELECT *, list_filter({arr}, lambda x: x IS NOT NULL) AS f FROM z), k AS (SELECT *, {weight}::BIGINT AS score FROM s WHERE len(f) > 0)
SELECT doc_id, score, array_to_string(f, ',') AS flags, len(f)::BIGINT AS n_flags, CASE WHEN score >= 70 THEN 'CRITICAL' WHEN score >= 50 THEN 'HIGH' WHEN score >= 30 THEN 'MEDIUM' WHEN score >= 15 THEN 'LOW' ELSE 'CLEAN' END AS risk,
  content[1:200] AS content_preview, summary[1:100] AS summary_preview FROM k ORDER BY score DESC, day DESC, doc_id""",
        "entity_profile": f"""{z}, t AS (SELECT gov, string_agg(DISTINCT tag, ',' ORDER BY tag) AS all_tags FROM (SELECT gov, unnest(tags) AS tag FROM z) GROUP BY gov)
SELECT z.gov, count(*) AS n, strftime(min(day), '%Y-%m-%d') AS first_day, strftime(max(day), '%Y-%m-%d') AS last_day, round(avg(coalesce(CASE WHEN doc_id % 7 <> 0 THEN least(100, len / 20) END, 50)), 6) AS mean_score,
  count(*) FILTER (content = '' OR day IS NULL) AS n_serious, round(100.0::DOUBLE * count(*) FILTER (content = '' OR day IS NULL) / count(*), 1) AS serious_rate, count(*) FILTER (policy <> '') AS n_tagged, count(*) FILTER (bodies <> '') AS n_bodies, any_value(all_tags) AS all_tags
FROM z LEFT JOIN t ON z.gov = t.gov GROUP BY z.gov""",
        "inline_validation": f"""{z}, tw AS ({tag_words}), bw AS ({body_words}),
tg AS (SELECT doc_id, low, unnest(tags) AS x, unnest(range(len(tags))) AS i FROM z), pl AS (SELECT doc_id, low, unnest(place_list) AS x, unnest(range(len(place_list))) AS i FROM z), bo AS (SELECT doc_id, low, unnest(body_list) AS x, unnest(range(len(body_list))) AS i FROM z),
bn AS (SELECT doc_id, x, i, {body_named} AS named FROM bo u),
w AS (SELECT doc_id, 1 AS g, 0 AS i, 'class unclear' AS m FROM z WHERE operativity = 'n/a' UNION ALL SELECT doc_id, 2, 0, 'only the fallback tag' FROM z WHERE trim(policy) = '{tagged.FALLBACK}'
  UNION ALL SELECT doc_id, 3, i, 'tag without a word: ' || x FROM tg WHERE x NOT IN ('{tagged.FALLBACK}', 'admin', 'appointments') AND x IN (SELECT tag FROM tw) AND NOT EXISTS (SELECT 1 FROM tw WHERE tag = x AND contains(low, word))
  UNION ALL SELECT doc_id, 4, i, 'place not found: ' || x FROM pl WHERE NOT contains(low, x) UNION ALL SELECT doc_id, 5, i, 'body not mentioned: ' || x FROM bn WHERE NOT named
  UNION ALL SELECT doc_id, 6, 0, 'summary too short' FROM z WHERE length(summary) BETWEEN 1 AND 19 UNION ALL SELECT doc_id, 6, 1, 'summary too long' FROM z WHERE length(summary) > 800 UNION ALL SELECT doc_id, 6, 2, 'summary is the title' FROM z WHERE summary <> '' AND trim(summary) = trim(title)
  UNION ALL SELECT doc_id, 7, 0, 'operative by class only' FROM z WHERE operativity = 'operative' AND decl_hits > 0 AND op_hits = 0 UNION ALL SELECT doc_id, 7, 1, 'declarative by class only' FROM z WHERE operativity = 'declarative' AND op_hits > 0 AND decl_hits = 0
  UNION ALL SELECT doc_id, 8, 0, 'default bodies' FROM z WHERE trim(bodies) IN ({', '.join(map(repr, tagged.COMBOS))}) AND NOT EXISTS (SELECT 1 FROM bn WHERE bn.doc_id = z.doc_id AND named)
  UNION ALL SELECT doc_id, 9, 0, 'default tag' FROM z WHERE len(tags) = 1 AND tags[1] IN ({', '.join(map(repr, tagged.SUSPICIOUS))}) AND NOT EXISTS (SELECT 1 FROM tw WHERE tag = tags[1] AND contains(low, word)))
SELECT z.doc_id, coalesce(string_agg(m, '; ' ORDER BY g, i), '') AS warnings, count(m) AS n_warnings FROM z LEFT JOIN w ON z.doc_id = w.doc_id GROUP BY z.doc_id""",
        "number_duplicates": f"""{z}, g AS (SELECT gov, number, count(*) AS n, list(doc_id ORDER BY doc_id)[1:100] AS ids FROM z GROUP BY gov, number HAVING count(*) > 1)
SELECT doc_id, z.gov, z.number, n, array_to_string(ids, ',') AS ids FROM z JOIN g ON z.gov = g.gov AND z.number = g.number""",
        "scan_samples": f"""{z}, c AS (SELECT *, {issues} FROM z), u AS ({" UNION ALL ".join(f"SELECT doc_id, '{c}' AS field, {c} AS issue, {v}[1:200] AS value FROM c WHERE {c} IS NOT NULL" for c, v in fields.items())}),
n AS (SELECT field, count(*) AS n, 100.0::DOUBLE * count(*) / (SELECT count(*) FROM z) AS rate FROM u GROUP BY field)
SELECT doc_id, u.field, issue, value, n, rate FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY doc_id) AS i FROM u) u JOIN n ON u.field = n.field WHERE i <= 10""",
        "change_summary": f"""{z}, c AS (SELECT doc_id, processed, CASE WHEN doc_id % 11 = 0 THEN 'insert' WHEN doc_id % 13 = 0 THEN 'delete' ELSE 'update' END AS op FROM z),
f AS (SELECT op, processed, 'all' AS field FROM c WHERE op <> 'update' UNION ALL SELECT op, processed, 'updated_at' FROM c WHERE op = 'update' UNION ALL SELECT op, processed, 'policy' FROM c WHERE op = 'update' AND doc_id % 2 = 0
  UNION ALL SELECT op, processed, 'operativity' FROM c WHERE op = 'update' AND doc_id % 3 = 1 UNION ALL SELECT op, processed, 'content' FROM c WHERE op = 'update' AND doc_id % 5 = 2),
g AS (SELECT op, field, processed, count(*) AS n FROM f GROUP BY ALL)
SELECT op, field, CASE op WHEN 'delete' THEN 3 WHEN 'insert' THEN 2 ELSE 1 END::BIGINT AS priority, processed, n, CASE WHEN NOT processed AND n > 500 THEN 'run the incremental scan now' WHEN op = 'insert' AND NOT processed THEN 'run all checks on new records'
  WHEN field = 'policy' THEN 'check tags against texts' WHEN field = 'operativity' THEN 'check classes against texts' ELSE 'none' END AS recommendation FROM g""",
        "address_order": f"""{z}, m AS (SELECT doc_id, url, {num} AS a, regexp_extract(url, '/([0-9]+)_vol([0-9]+)', ['y', 'n']) AS o FROM z),
k AS (SELECT doc_id, url, CASE WHEN a.y <> '' THEN -(try_cast(a.y AS BIGINT)) WHEN o.y <> '' THEN -CASE WHEN try_cast(o.y AS BIGINT) >= 1900 THEN try_cast(o.y AS BIGINT) ELSE try_cast(o.y AS BIGINT) + 1990 END ELSE 1 END AS by_year,
  CASE WHEN a.y <> '' THEN -(try_cast(a.n AS BIGINT)) WHEN o.y <> '' THEN -(try_cast(o.n AS BIGINT)) ELSE 0 END AS by_number, CASE WHEN a.s <> '' THEN -ascii(a.s) ELSE 0 END::BIGINT AS by_suffix, CASE WHEN a.e <> '' THEN -ascii(a.e) ELSE 0 END::BIGINT AS by_ending FROM m)
SELECT * FROM k ORDER BY by_year, by_number, by_suffix, by_ending, url, doc_id""",
        "text_dates": f"""{z}, x AS (SELECT doc_id, nullif(regexp_extract({_dated(DUCK)}, '\\b([0-9]{{2}}[.][0-9]{{2}}[.][0-9]{{4}})\\b', 1), '') AS found FROM z), y AS (SELECT doc_id, found, try_strptime(found, '%d.%m.%Y')::DATE AS day FROM x)
SELECT doc_id, found, CASE WHEN day BETWEEN DATE '1948-01-01' AND DATE '{LAST_DAY}' + INTERVAL 12 MONTH THEN strftime(day, '%Y-%m-%d') END AS day FROM y""",
        "tag_suggestions": f"""WITH p AS (SELECT p_partkey, lower(p_name) || ' ' || lower(p_type) || ' part of the ' || lower(p_brand) || ' range' AS name FROM part WHERE p_name IS NOT NULL AND p_type IS NOT NULL AND p_brand IS NOT NULL),
k AS (SELECT name, {d.words('name')} AS e FROM (SELECT DISTINCT name FROM p WHERE p_partkey % 3 = 0)),
t AS (SELECT tag, {d.words('tag')} AS w FROM (SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN name || ' new' WHEN 1 THEN regexp_replace(name, '^([^ ]+) ([^ ]+) ', '\\2 \\1 ') WHEN 2 THEN replace(name, ' part of', '') ELSE name END AS tag FROM p) WHERE tag NOT IN (SELECT name FROM k)),
j AS (SELECT tag, name, {d.jaccard('w', 'e')} AS j FROM t, k WHERE {d.jaccard('w', 'e')} > 0.7), b AS (SELECT tag, first(name ORDER BY j DESC, name) AS suggestion FROM j GROUP BY tag)
SELECT t.tag, coalesce(suggestion, '') AS suggestion FROM t LEFT JOIN b ON t.tag = b.tag""",
        "class_by_patterns": f"""{z}, p AS ({pats}), h AS (SELECT doc_id, count(*) AS n, bool_or(c = 'operative') AS op, bool_or(c = 'declarative') AS de, first(c ORDER BY i) AS head FROM z JOIN p ON regexp_matches(low, p) GROUP BY doc_id)
SELECT z.doc_id, trim(operativity) AS given, CASE WHEN trim(operativity) = 'operative' THEN CASE WHEN de THEN 'declarative' ELSE 'operative' END WHEN trim(operativity) = 'declarative' THEN CASE WHEN op THEN 'operative' ELSE 'declarative' END ELSE coalesce(head, trim(operativity)) END AS class,
  coalesce(n, 0) AS n_patterns FROM z LEFT JOIN h ON z.doc_id = h.doc_id""",
    }


QUERIES = {f.__name__: f for f in (
    issue_columns, suspicion_scores, entity_profile, inline_validation, number_duplicates, scan_samples, change_summary, address_order, text_dates, tag_suggestions, class_by_patterns, preload_validation)}
ORACLES = _oracles()
