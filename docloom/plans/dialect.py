"""One query text, two dialects: Spark SQL for the engine, DuckDB SQL for the oracle.

A query is a function of a ``Dialect``; what the engines spell differently goes
through its methods, so that a plan and its oracle cannot drift apart in meaning.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docloom.session import table

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


class Dialect:
    def __init__(self, spark: bool, prefix: str = ""):
        self.spark, self.prefix = spark, prefix

    def __call__(self, spark_text: str, duck_text: str) -> str:
        return spark_text if self.spark else duck_text

    def t(self, name: str) -> str:
        return self.prefix + name

    def lit(self, text: str) -> str:
        text = text.replace("'", "''") if not self.spark else text.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{text}'"

    def like(self, x: str, pattern: str) -> str:
        """A regular expression found anywhere in x."""
        return self(f"({x} RLIKE {self.lit(pattern)})", f"regexp_matches({x}, {self.lit(pattern)})")

    def swap(self, x: str, pattern: str, to: str) -> str:
        return f"regexp_replace({x}, {self.lit(pattern)}, {self.lit(to)}{self('', chr(44) + ' ' + chr(39) + 'g' + chr(39))})"

    def grab(self, x: str, pattern: str, group: int = 1) -> str:
        """A group of the first match, NULL if there is none."""
        return f"nullif(regexp_extract({x}, {self.lit(pattern)}, {group}), '')"

    def size(self, x: str) -> str:
        return self(f"CAST(array_size({x}) AS BIGINT)", f"CAST(len({x}) AS BIGINT)")

    def array(self, *items: str) -> str:
        return self(f"array({', '.join(items)})", f"[{', '.join(items)}]")

    def compact(self, *items: str) -> str:
        """An array of the items that are not NULL."""
        return self(f"array_compact({self.array(*items)})", f"list_filter({self.array(*items)}, lambda x: x IS NOT NULL)")

    def keep(self, x: str, v: str, cond: str) -> str:
        return self(f"filter({x}, {v} -> {cond})", f"list_filter({x}, lambda {v}: {cond})")

    def map(self, x: str, v: str, e: str) -> str:
        return self(f"transform({x}, {v} -> {e})", f"list_transform({x}, lambda {v}: {e})")

    def join(self, x: str, sep: str) -> str:
        return self(f"array_join({x}, {self.lit(sep)})", f"coalesce(array_to_string({x}, {self.lit(sep)}), '')")

    def sort(self, x: str) -> str:
        return self(f"array_sort({x})", f"list_sort({x})")

    def each(self, x: str) -> str:
        return self(f"explode({x})", f"unnest({x})")

    def both(self, a: str, b: str) -> str:
        return self(f"array_intersect({a}, {b})", f"list_intersect({a}, {b})")

    def distinct(self, x: str) -> str:
        return self(f"array_distinct({x})", f"list_distinct({x})")

    def any(self, x: str, v: str, cond: str) -> str:
        return self(f"exists({x}, {v} -> {cond})", f"(len(list_filter({x}, lambda {v}: {cond})) > 0)")

    def has(self, x: str, item: str) -> str:
        return self(f"array_contains({x}, {item})", f"list_contains({x}, {item})")

    def at(self, x: str, n: int) -> str:
        """Item n of an array from 1 on, NULL behind its end."""
        return self(f"try_element_at({x}, {n})", f"({x})[{n}]")

    def uniq(self, x: str) -> str:
        """Items in order of first occurrence; x is a column."""
        return self(f"array_distinct({x})", f"list_filter({x}, lambda v, i: list_position({x}, v) = i)")

    def concat(self, *arrays: str) -> str:
        if self.spark:
            return f"concat({', '.join(arrays)})"
        out = arrays[0]
        for a in arrays[1:]:
            out = f"list_concat({out}, {a})"
        return out

    def none(self) -> str:
        return self("cast(array() as array<string>)", "CAST([] AS VARCHAR[])")

    def items(self, x: str, sep: str = ";") -> str:
        """Trimmed items of a delimited text, blanks dropped."""
        return self.keep(self.map(f"split({x}, '{sep}')", "x", "trim(x)"), "x", "x <> ''")

    def struct(self, **fields: str) -> str:
        return self("named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")", "{" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}")

    def words(self, x: str) -> str:
        """Distinct lower-case words: letters of any script, and digits."""
        pattern = self(r"[^\p{L}\p{N}]+", r"[^\pL\pN]+")
        return self.distinct(self.keep(f"split({self.swap(f'lower({x})', pattern, ' ')}, ' ')", "w", "w <> ''"))

    def jaccard(self, a: str, b: str) -> str:
        """Shared over all words of two arrays of distinct words; 0 where either is empty."""
        both = self.size(self.both(a, b))
        return f"CASE WHEN {self.size(a)} = 0 OR {self.size(b)} = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({both} AS DOUBLE) / ({self.size(a)} + {self.size(b)} - {both}) END"

    def gather(self, x: str, order: str | None = None) -> str:
        """All values of a group as a sorted array."""
        return self(f"array_sort(collect_list({x}))", f"list({x} ORDER BY {x}) FILTER ({x} IS NOT NULL)")

    def gather_set(self, x: str) -> str:
        return self(f"array_sort(collect_set({x}))", f"coalesce(list(DISTINCT {x} ORDER BY {x}) FILTER ({x} IS NOT NULL), [])")

    def percentile(self, x: str, p: float) -> str:
        return self(f"percentile({x}, {p}D)", f"quantile_cont({x}, {p})")

    def day(self, ts: str) -> str:
        """ISO date text."""
        return self(f"date_format({ts}, 'yyyy-MM-dd')", f"strftime({ts}, '%Y-%m-%d')")

    def stamp(self, ts: str) -> str:
        return self(f"date_format({ts}, 'yyyy-MM-dd HH:mm:ss')", f"strftime({ts}, '%Y-%m-%d %H:%M:%S')")

    def days(self, a: str, b: str) -> str:
        """Days from b to a."""
        return self(f"datediff({a}, {b})", f"date_diff('day', CAST({b} AS DATE), CAST({a} AS DATE))")

    def json(self, x: str, key: str) -> str:
        return self(f"get_json_object({x}, '$.{key}')", f"json_extract_string({x}, '$.{key}')")

    def double(self, x: str) -> str:
        return f"CAST({x} AS DOUBLE)"

    def long(self, x: str) -> str:
        return f"CAST({x} AS BIGINT)"

    def flag(self, cond: str) -> str:
        """How many rows of a group meet a condition."""
        return f"CAST(count(CASE WHEN {cond} THEN 1 END) AS BIGINT)"


Query = Callable[[Dialect], str]
DUCK = Dialect(spark=False)


def runner(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    """The query over the Parquet tables of a directory; only tables it names are read."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prefix = f"docloom_{hashlib.md5(sf_dir.encode()).hexdigest()[:8]}_"
        text = query(Dialect(spark=True, prefix=prefix))
        for name in set(re.findall(rf"\b{prefix}(\w+)\b", text)) & set(TABLES):
            table(spark, sf_dir, name).createOrReplaceTempView(prefix + name)
        return spark.sql(text)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def registry(*queries: Query) -> tuple[dict, dict[str, str]]:
    return {q.__name__: runner(q) for q in queries}, {q.__name__: q(DUCK) for q in queries}
