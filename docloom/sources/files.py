"""File sources and sinks."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


def json_list(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A file that holds one JSON array of objects."""
    return spark.read.schema(schema).json(path, multiLine=True)


def csv_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header, quoted line breaks and doubled quotes; a byte-order mark is skipped."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', enforceSchema=True, encoding="UTF-8")


def line_list(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a whitelist, one a line: stripped; blank lines, comments and headings (with a colon) left out. An empty list is an error."""
    lines = spark.read.text(path).select(F.trim(F.regexp_replace("value", r"^\s*\d+→", "")).alias("entry"))
    out = lines.where("entry <> '' AND NOT startswith(entry, '#') AND NOT contains(entry, ':')")
    if out.isEmpty():
        raise ValueError(f"no entries in {path}")
    return out


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """The columns in this order, nulls as empty text."""
    df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]).write.mode("overwrite").csv(path, header=True, escape='"')


def write_json_report(df: DataFrame, path: str) -> None:
    """One JSON object a row."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def upsert(spark: SparkSession, path: str, updates: DataFrame, key: list[str], out: str) -> DataFrame:
    """Rows of ``path`` replaced or joined by those of ``updates`` on the key (of several with one key, the largest row), written to another path and read again."""
    rest = [c for c in updates.columns if c not in key]
    new = updates.groupBy(*key).agg(F.max(F.struct(*rest)).alias("x")).select(*key, "x.*")
    old = spark.read.parquet(path).join(new.select(*key), key, "left_anti")
    old.unionByName(new, allowMissingColumns=True).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


class _Page(InputPartition):
    def __init__(self, skip: int):
        super().__init__(skip)
        self.skip = skip


class _Span(InputPartition):
    def __init__(self, skip: int, limit: int):
        super().__init__((skip, limit))
        self.skip, self.limit = skip, limit


class PagedReader(DataSourceReader):
    """A partition a page: pages are fetched in parallel, each again if its executor is lost.

    The first short page ends the catalogue; it is found by doubling and then
    halving, so the driver asks for few pages whatever their number.
    """

    def __init__(self, source: PagedCatalog):
        self.source, self.size = source, int(source.options.get("pagesize", 1000))

    def _full(self, page: int) -> bool:
        return len(self.source.page(page * self.size, self.size)) == self.size

    def partitions(self) -> list[_Page]:
        high = 1
        while self._full(high - 1):
            high *= 2
        low = high // 2  # pages before this one are full, page high - 1 is not
        while low < high - 1:
            middle = (low + high - 1) // 2
            low, high = (middle + 1, high) if self._full(middle) else (low, middle + 1)
        return [_Page(k * self.size) for k in range(high)]

    def read(self, partition: _Page):
        for entry in self.source.page(partition.skip, self.size):
            yield entry["id"], entry.get("title"), entry.get("url")


class PagedStream(DataSourceStreamReader):
    """The catalogue as it grows: an offset is how many entries were taken, so a discovery that stops goes on behind them.

    A micro-batch takes what is new, a partition a page, read by executors; the
    driver finds the end by doubling and halving, from the last end it knows.
    """

    def __init__(self, source: PagedCatalog):
        self.source, self.size = source, int(source.options.get("pagesize", 1000))
        self.known = 0  # pages that were full when last seen

    def initialOffset(self) -> dict:  # noqa: N802 - names of the interface
        return {"skip": int(self.source.options.get("skip", 0))}

    def latestOffset(self) -> dict:  # noqa: N802
        step, low = 1, self.known
        while self._length(low + step - 1) == self.size:
            low, step = low + step, step * 2
        high = low + step - 1  # page high is not full; those before low are
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if self._length(middle) == self.size else (low, middle)
        self.known = low
        return {"skip": max(low * self.size + self._length(low), self.initialOffset()["skip"])}

    def _length(self, page: int) -> int:
        return len(self.source.page(page * self.size, self.size))

    def partitions(self, start: dict, end: dict) -> list[_Span]:
        edges = range(start["skip"], end["skip"], self.size)
        return [_Span(a, min(self.size, end["skip"] - a)) for a in edges]

    def read(self, partition: _Span):
        for entry in self.source.page(partition.skip, partition.limit):
            yield entry["id"], entry.get("title"), entry.get("url")

    def commit(self, end: dict) -> None:
        pass


class PagedCatalog(DataSource):
    """A catalogue that gives entries (dictionaries of id, title, url) by skip and limit; subclass it with ``fetch``."""

    TRIES = 5

    @classmethod
    def name(cls) -> str:
        return "paged_catalog"

    def schema(self) -> str:
        return "id long, title string, url string"

    def fetch(self, skip: int, limit: int) -> list[dict]:
        raise NotImplementedError("a live catalogue or a stored one")

    def page(self, skip: int, limit: int) -> list[dict]:
        """One page; a failed request is made again, five times in all, later each time."""
        for k in range(1, self.TRIES + 1):
            try:
                return self.fetch(skip, limit)
            except OSError:
                if k == self.TRIES:
                    raise
                time.sleep(0.1 * k)
        return []

    def reader(self, schema: T.StructType) -> PagedReader:
        return PagedReader(self)

    def streamReader(self, schema: T.StructType) -> PagedStream:  # noqa: N802
        return PagedStream(self)
