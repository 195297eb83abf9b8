"""Loading: ordered scans, nested items, validation before the load, choices between texts, examples and rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.plans.dialect import Dialect, registry
from docloom.plans.tagged import FALLBACK, records
from docloom.plans.tags import tag_mapping_cascade
from docloom.session import table


def ordered_scan(d: Dialect) -> str:
    """All records by id, without their texts."""
    return f"SELECT doc_id, lang, source, n_chars FROM {d.t('documents')} ORDER BY doc_id"


def catalog_items(d: Dialect) -> str:
    """Nested items of a catalogue as flat entries: the first of each nested list, a date put in order, the title as a fallback for a missing description."""
    doc = """'{"url": "/pages/' || CAST(o_orderkey AS VARCHAR(20)) || '", "title": "Item ' || CAST(o_orderkey AS VARCHAR(20)) || '"' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ', "description": "d"' END
 || ', "tags": {"meta": {"unit": [' || CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '{"title": "' || o_orderpriority || '"}, {"title": "x"}' END || '], "date": [{"title": "07.03.1999"}]}}}'"""
    first = lambda p: f"get_json_object(j, '$.{p}')" if d.spark else f"json_extract_string(j, '$.{p}')"
    date = first("tags.meta.date[0].title")
    return f"""WITH j AS (SELECT o_orderkey, {doc} AS j FROM {d.t('orders')})
SELECT o_orderkey, {first('url')} AS url, {first('title')} AS title, coalesce({first('description')}, {first('title')}) AS description, coalesce({first('tags.meta.unit[0].title')}, '') AS unit,
  substring({date}, 7, 4) || '-' || substring({date}, 4, 2) || '-' || substring({date}, 1, 2) AS day FROM j"""


def load_validation(d: Dialect) -> str:
    """Rows before the load: date form and year, key form, class; a row without key or date is incomplete."""
    day = f"CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN '1995-13-40' WHEN 2 THEN '1890-01-01' ELSE {d.day('o_orderdate')} END"
    key = "CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'x' || CAST(o_custkey AS VARCHAR(20)) ELSE '37_' || CAST(o_custkey AS VARCHAR(20)) END"
    errors = d.compact("CASE WHEN k = '' OR day = '' THEN 'incomplete' END", f"CASE WHEN day <> '' AND NOT {d.like('day', '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')} THEN 'date form' END", "CASE WHEN day <> '' AND try_cast(day AS DATE) IS NULL THEN 'no such day' END",
                       "CASE WHEN day <> '' AND substring(day, 1, 4) NOT BETWEEN '1948' AND '2027' THEN 'year' END", f"CASE WHEN k <> '' AND NOT {d.like('k', '^[0-9]+_[0-9]+$')} THEN 'key form' END", "CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'class' END")
    return f"""WITH r AS (SELECT o_orderkey, o_orderstatus, {day} AS day, {key} AS k FROM {d.t('orders')}), e AS (SELECT o_orderkey, {errors} AS errors FROM r)
SELECT {d.join('errors', '; ')} AS errors, count(*) AS n, min(o_orderkey) AS first_key, {d.size('errors')} = 0 AS loads FROM e GROUP BY errors"""


def newer_rows(d: Dialect) -> str:
    """Rows newer than a baseline (a date, then a number): a number that can't be read stays, a missing one goes."""
    num = "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN CAST(o_orderkey AS VARCHAR(20)) || 'a' ELSE CAST(o_orderkey AS VARCHAR(20)) END"
    return f"""WITH b AS (SELECT max(o_orderdate) AS last_date FROM {d.t('orders')} WHERE o_orderdate < TIMESTAMP '1996-06-01 00:00:00'), r AS (SELECT o_orderkey, o_orderdate, {num} AS num FROM {d.t('orders')})
SELECT o_orderkey, num FROM r CROSS JOIN b WHERE num IS NOT NULL AND (o_orderdate > last_date OR (o_orderdate = last_date AND coalesce(try_cast(num AS BIGINT) > 500, true)))"""


def page_text_choice(d: Dialect) -> str:
    """The text of a page, or where that is under 40 characters another one of it (here its address)."""
    text = f"trim({d.swap(d.swap('html', '<[^>]*>', ' '), '[ \t\r\n]+', ' ')})"
    short = f"CASE WHEN page_id % 7 = 0 THEN substring({text}, 1, 20) ELSE {text} END"
    return f"WITH t AS (SELECT page_id, url, {short} AS t FROM {d.t('pages')} WHERE html IS NOT NULL) SELECT page_id, CASE WHEN length(t) >= 40 THEN 'html' ELSE 'other' END AS taken, md5(CASE WHEN length(t) >= 40 THEN t ELSE url END) AS text_md5 FROM t"


def mapping_examples(d: Dialect) -> str:
    """Up to five examples of each mapping method, and how many parts it mapped."""
    return f"""WITH m AS ({tag_mapping_cascade(d)}), r AS (SELECT method, p_partkey, mapped, row_number() OVER (PARTITION BY method ORDER BY p_partkey) AS rn FROM m), n AS (SELECT method AS nm, count(*) AS n FROM m GROUP BY method)
SELECT method, p_partkey, mapped, n FROM r JOIN n ON method = nm WHERE rn <= 5"""


def fallback_by_year(d: Dialect) -> str:
    """Records and those with the fallback tag alone, by year, newest first."""
    return f"WITH {records(d)} SELECT yr, count(*) AS total, {d.flag(f"policy = '{FALLBACK}'")} AS fallback, {d.double(d.flag(f"policy = '{FALLBACK}'"))} / count(*) * 100 AS rate FROM a GROUP BY yr ORDER BY yr DESC"


def unauthorised_tags(d: Dialect) -> str:
    """Tags outside the list and how often they are used."""
    from docloom.plans.tagged import TAG_LIST

    return f"WITH {records(d)}, x AS (SELECT {d.each('tags')} AS tag FROM a) SELECT tag, count(*) AS n FROM x WHERE tag NOT IN ({', '.join(map(repr, TAG_LIST))}) GROUP BY tag"


def entity_tags(d: Dialect) -> str:
    """Each body's records, tags and share with a valid class; a record without tags counts with none."""
    return f"""WITH {records(d)}, x AS (SELECT doc_id, operativity, tags, {d.each('body_list')} AS body FROM a)
SELECT body, count(*) AS n, {d.long(f'sum({d.size("tags")})')} AS n_tags, {d.double(d.flag("trim(operativity) IN ('operative', 'declarative')"))} / count(*) * 100 AS valid_rate FROM x GROUP BY body"""


def numbers_repeated(d: Dialect) -> str:
    """Records that share government and number: each with its group's size and smallest id."""
    return f"""WITH {records(d)}, k AS (SELECT doc_id, substring(record_key, 1, 2) AS gov, doc_id % 7 AS num FROM a), g AS (SELECT gov AS gg, num AS gn, count(*) AS n, min(doc_id) AS first_id FROM k GROUP BY gov, num HAVING count(*) > 1)
SELECT doc_id, gov, num, n, first_id FROM k JOIN g ON gov = gg AND num = gn"""


QUERIES, ORACLES = registry(ordered_scan, catalog_items, load_validation, newer_rows, page_text_choice, mapping_examples, fallback_by_year, unauthorised_tags, entity_tags, numbers_repeated)

#: table functions: name -> (arguments, columns, body over the views docloom_tf_orders and docloom_tf_documents)
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "orders_since": ("days INT", "o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ", "SELECT o_orderkey, o_orderdate FROM docloom_tf_orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM docloom_tf_orders) - make_dt_interval(days)"),
    "status_counts": ("least BIGINT", "status STRING, n BIGINT", "SELECT o_orderstatus, count(*) FROM docloom_tf_orders GROUP BY o_orderstatus HAVING count(*) >= least"),
    "short_documents": ("most INT", "doc_id BIGINT, len INT", "SELECT doc_id, length(coalesce(text, '')) FROM docloom_tf_documents WHERE length(coalesce(text, '')) < most"),
    "missing_counts": ("", "field STRING, n BIGINT", "SELECT stack(3, 'text', count_if(text IS NULL), 'lang', count_if(lang IS NULL), 'source', count_if(source IS NULL)) FROM docloom_tf_documents"),
    "tag_check": ("allowed ARRAY<STRING>", "lang STRING, n BIGINT, valid BOOLEAN", "SELECT lang, count(*), array_contains(allowed, lang) FROM docloom_tf_documents GROUP BY lang, allowed"),
}


def register_functions(spark: SparkSession, sf_dir: str) -> None:
    """The five table functions over the tables of a directory, for SQL of this session."""
    for name in ("orders", "documents"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"docloom_tf_{name}")
    for name, (args, columns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION docloom_{name}({args}) RETURNS TABLE({columns}) RETURN {body}")


def table_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table function by one call of it."""
    register_functions(spark, sf_dir)
    return spark.sql("""SELECT 'orders_since' AS name, count(*) AS n FROM docloom_orders_since(90) UNION ALL SELECT 'status_counts', sum(n) FROM docloom_status_counts(2)
UNION ALL SELECT 'short_documents', count(*) FROM docloom_short_documents(200) UNION ALL SELECT 'missing_counts', sum(n) FROM docloom_missing_counts() UNION ALL SELECT 'tag_check', sum(n) FROM docloom_tag_check(array('en', 'de')) WHERE valid""")


QUERIES["table_functions"] = table_functions
ORACLES["table_functions"] = """
SELECT 'orders_since' AS name, count(*)::BIGINT AS n FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL 90 DAY
UNION ALL SELECT 'status_counts', sum(n)::BIGINT FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderstatus HAVING count(*) >= 2) x
UNION ALL SELECT 'short_documents', count(*)::BIGINT FROM documents WHERE length(coalesce(text, '')) < 200
UNION ALL SELECT 'missing_counts', (count(*) FILTER (text IS NULL) + count(*) FILTER (lang IS NULL) + count(*) FILTER (source IS NULL))::BIGINT FROM documents
UNION ALL SELECT 'tag_check', count(*)::BIGINT FROM documents WHERE lang IN ('en', 'de')"""
