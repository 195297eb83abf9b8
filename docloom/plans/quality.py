"""Content-quality scoring over documents and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import table


def content_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score 0-100 and tier per document; a document without a label row has no body tags."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("labelled")).distinct()
    d = docs.join(labels, "doc_id", "left")
    content = F.length(F.coalesce("text", F.lit("")))
    d = d.select(
        "doc_id",
        content.cast("long").alias("content_length"),
        F.least(content, F.lit(120)).cast("long").alias("summary_length"),
        F.col("lang").isNotNull().alias("has_policy"),
        (F.col("labelled") & F.col("source").isNotNull()).alias("has_body"),
        F.coalesce("text", F.lit("")).rlike(r"\.\.\.$").alias("has_truncated_content"),
    )
    score = (
        F.lit(50)
        + F.when(F.col("content_length") < 100, -10).when(F.col("content_length") > 500, 20).otherwise(10)
        + F.when(F.col("summary_length").between(50, 200), 15).otherwise(0)
        + F.when(~F.col("has_policy"), -15).otherwise(15)
        + F.when(~F.coalesce("has_body", F.lit(False)), -10).otherwise(15)
        + F.when(F.col("has_truncated_content"), -5).otherwise(0)
    )
    d = d.withColumn("quality_score", F.least(F.greatest(score, F.lit(0)), F.lit(100)).cast("long"))
    tier = (
        F.when(F.col("quality_score") >= 90, "excellent")
        .when(F.col("quality_score") >= 75, "good")
        .when(F.col("quality_score") >= 60, "fair")
        .when(F.col("quality_score") >= 40, "poor")
        .otherwise("critical")
    )
    return d.select("doc_id", "quality_score", tier.alias("quality_tier"), "content_length", "summary_length", "has_truncated_content")


QUERIES = {"content_quality": content_quality}

ORACLES = {
    "content_quality": r"""
WITH l AS (SELECT DISTINCT doc_id, TRUE AS labelled FROM labels),
d AS (
  SELECT d.doc_id, length(coalesce(text,'')) AS cl, least(length(coalesce(text,'')),120) AS sl,
         lang IS NOT NULL AS hp, coalesce(labelled AND source IS NOT NULL, FALSE) AS hb,
         regexp_matches(coalesce(text,''), '\.\.\.$') AS tr
  FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id),
s AS (
  SELECT *, least(greatest(50 + CASE WHEN cl < 100 THEN -10 WHEN cl > 500 THEN 20 ELSE 10 END
      + CASE WHEN sl BETWEEN 50 AND 200 THEN 15 ELSE 0 END
      + CASE WHEN hp THEN 15 ELSE -15 END + CASE WHEN hb THEN 15 ELSE -10 END
      + CASE WHEN tr THEN -5 ELSE 0 END, 0), 100)::BIGINT AS quality_score FROM d)
SELECT doc_id, quality_score,
  CASE WHEN quality_score >= 90 THEN 'excellent' WHEN quality_score >= 75 THEN 'good'
       WHEN quality_score >= 60 THEN 'fair' WHEN quality_score >= 40 THEN 'poor' ELSE 'critical' END AS quality_tier,
  cl::BIGINT AS content_length, sl::BIGINT AS summary_length, tr AS has_truncated_content
FROM s""",
}
