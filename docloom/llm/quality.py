"""Operator 4: quality rules as a bitmask ledger. DataFrame functions only.

Every rule is evaluated once for a document; the ledger keeps its measurements
and one bit for each rule that failed. A policy is a version and a mask of the
rules it enforces: applying one, or another, is a bitwise AND over the ledger.
Ablations (what a policy would keep without one of its rules) come from counts
by failure bits, of which there are at most 2 to the number of rules.

No row leaves its partition: repeated 5-word windows are found by sorting a
document's own window hashes, so a hot source or a group of copies is no skew.

Defined results: a null or empty text has no words, every measurement is zero
and it fails ``few_words``; repeated rows get a row each; other columns of the
input, whatever their names, are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import load

SPACE = r"[\\x20\\x09-\\x0D]"

#: name -> SQL over the measurements that is true where the rule fails; the bit is the position
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeat_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "n_symbols > 10 AND 10 * n_symbols > n_words",
    "dup_lines": "n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines",
    "few_letters": "n_words > 0 AND 2 * n_letters < word_chars",
    "shouting": "n_letters > 50 AND 2 * n_upper > n_letters",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)",
    "stutter": "n_words >= 10 AND 10 * n_stutter > 3 * n_words",
}
BIT = {name: 1 << k for k, name in enumerate(RULES)}

#: version -> rules it enforces
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeat_words"),
    "v1": tuple(RULES),
}
PRODUCTION = "v1"


def mask(policy: str) -> int:
    return sum(BIT[r] for r in POLICIES[policy])


def measure(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and the measurements of every row."""
    d = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text_col), F.lit("")).alias("__t"))
    d = d.withColumn("__trim", F.expr(r"btrim(__t, ' \t\n\u000B\f\r')"))
    d = d.withColumn("__w", F.expr(f"if(__trim = '', cast(array() as array<string>), split(__trim, '{SPACE}+'))")).drop("__trim")
    d = d.select(
        *keep, "__w",
        F.size("__w").cast("long").alias("n_words"),
        F.expr(f"length(regexp_replace(__t, '{SPACE}+', ''))").cast("long").alias("word_chars"),
        F.expr("length(regexp_replace(__t, '[^#*$%&|<>]+', ''))").cast("long").alias("n_symbols"),
        F.expr(r"length(regexp_replace(__t, '[^\\p{L}]+', ''))").cast("long").alias("n_letters"),
        F.expr(r"length(regexp_replace(__t, '[^\\p{Lu}]+', ''))").cast("long").alias("n_upper"),
        F.expr(rf"filter(split(__t, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')").alias("__lines"),
        F.expr("if(size(__w) < 5, cast(array() as array<bigint>),"
               " transform(sequence(0, size(__w) - 5), i -> xxhash64(__w[i], __w[i+1], __w[i+2], __w[i+3], __w[i+4])))").alias("__h"),
    )
    d = d.withColumn("__s", F.expr(
        "if(size(array_distinct(__h)) = size(__h), cast(null as array<struct<x:bigint,i:int>>),"
        " sort_array(transform(__h, (x, i) -> struct(x, i))))"))
    d = d.withColumn("__p", F.expr(
        "if(__s is null, cast(array() as array<int>), array_sort(transform(filter(__s, (e, k) ->"
        " (k > 0 and __s[greatest(k - 1, 0)].x = e.x) or (k < size(__s) - 1 and __s[least(k + 1, size(__s) - 1)].x = e.x)), e -> e.i)))"))
    return d.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_letters", "n_upper",
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.expr("if(size(__p) = 0, 0L, aggregate(transform(__p, (e, k) -> if(k < size(__p) - 1,"
               " least(5, __p[least(k + 1, size(__p) - 1)] - e), 5)), 0L, (a, b) -> a + b))").alias("n_repeat_words"),
        F.expr("if(size(__w) < 2, 0L, cast(size(filter(__w, (x, k) -> k > 0 and x = __w[greatest(k - 1, 0)])) as bigint))").alias("n_stutter"),
    )


def ledger(measured: DataFrame) -> DataFrame:
    """Adds fail_bits: bit k is set where rule k failed."""
    bits: Column = F.lit(0).cast("long")
    for name, failed in RULES.items():
        bits = bits + F.when(F.expr(failed), BIT[name]).otherwise(0).cast("long")
    return measured.withColumn("fail_bits", bits)


def apply_policy(book: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    return book.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0).withColumn("policy", F.lit(policy))


def ablation(book: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """One row a rule of the policy: documents it fails, those it alone fails, and what is kept without it."""
    by = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in POLICIES[policy]]))
    each = by.withColumn("x", rules).select("bits", "n", "x.rule", "x.bit")
    hit, alone = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits") == F.col("bit")
    zero = F.lit(0).cast("long")
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(zero)).alias("n_failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(zero)).alias("n_only_this"),
        F.sum(F.when((F.col("bits") == 0) | alone, F.col("n")).otherwise(zero)).alias("n_kept_without"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger and verdict of every document of the whole table under the production policy."""
    book = apply_policy(ledger(measure(load(spark, sf_dir, "documents"))))
    base = F.col("fail_bits").bitwiseAND(F.lit(mask("base")).cast("long")) != 0
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "fail_bits")


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the production policy fails, fails alone, and what would be kept without it."""
    return ablation(ledger(measure(load(spark, sf_dir, "documents"))))


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT r, i, concat_ws(' ', w[i], w[i+1], w[i+2], w[i+3], w[i+4]) AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
p AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g),
q AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS j FROM p WHERE n > 1),
c AS (SELECT r, sum(least(5, coalesce(j - i, 5)))::BIGINT AS n FROM q GROUP BY r),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(t, '[^\pL]+', '', 'g')) AS n_letters, length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS n_upper,
    len(l) AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i-1])) AS n_stutter
  FROM w LEFT JOIN c USING (r)),
b AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN n_symbols > 10 AND 10 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN n_words > 0 AND 2 * n_letters < word_chars THEN 16 ELSE 0 END
    + CASE WHEN n_letters > 50 AND 2 * n_upper > n_letters THEN 32 ELSE 0 END
    + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words) THEN 64 ELSE 0 END
    + CASE WHEN n_words >= 10 AND 10 * n_stutter > 3 * n_words THEN 128 ELSE 0 END)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b
"""

ABLATION = f"""
WITH q AS ({ORACLE}), p AS (SELECT unnest({list(RULES)}) AS rule, unnest({list(BIT.values())}) AS bit)
SELECT rule, count(*) FILTER (fail_bits & bit <> 0) AS n_failed, count(*) FILTER (fail_bits = bit) AS n_only_this, count(*) FILTER (fail_bits = 0 OR fail_bits = bit) AS n_kept_without FROM q CROSS JOIN p GROUP BY rule
"""
