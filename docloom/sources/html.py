"""Title, main content and plain text of HTML pages from one parse, and pluggable row taggers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from itertools import accumulate
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(("script", "style"))
#: elements that part words
BREAKS = frozenset("p br div li h1 h2 h3 h4 h5 h6 tr td th dt dd section article main header footer nav aside ul ol table blockquote pre hr option figcaption title".split())
#: fixed values: containers of content in the order they are tried, as (tag, attribute, text the attribute holds)
CONTAINERS = (("", "class", "content"), ("", "class", "decision"), ("", "class", "body"), ("", "class", "text"), ("main", "", ""), ("article", "", ""), ("", "id", "content"), ("", "role", "main"))
BLOCKS = ("div", "p", "section", "article")
TITLE_CHARS = 60


class PageText(NamedTuple):
    """What a page says: its title, main content, and all visible text."""

    title: str | None
    main: str
    text: str


class _Page(HTMLParser):
    """Pieces of visible text, where words are parted, and for each element the range of pieces inside it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.pieces, self.parted, self.elements, self.open, self.silent = [], set(), [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag in BREAKS:
            self.parted.add(len(self.pieces))
        self.silent += tag in SILENT
        if tag not in VOID:
            self.open.append(len(self.elements))
            self.elements.append([tag, {k: v or "" for k, v in attrs}, len(self.pieces), None])

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BREAKS:
            self.parted.add(len(self.pieces))
        self.silent -= tag in SILENT and self.silent > 0
        if any(self.elements[k][0] == tag for k in self.open):
            while True:
                k = self.open.pop()
                self.elements[k][3] = len(self.pieces)
                if self.elements[k][0] == tag:
                    return

    def handle_data(self, data):
        if not self.silent:
            self.pieces.append(data)

    def between(self, start: int, end: int | None) -> str:
        """The text of a range of pieces, white space as it is, a line end where words are parted."""
        end = len(self.pieces) if end is None else end
        return "".join(("\n" if k in self.parted and k > start else "") + self.pieces[k] for k in range(start, end))


def _collapsed(text: str) -> str:
    return " ".join(text.split())


def page_text(html: str | None, letter: str = r"[^\W\d_]", enough: int = 200, least: int = 100) -> PageText:
    """Title, main content and all text from one parse of a page.

    The title is the first h1 with text, else the title element, else the first
    words of the text. The main content is that of the first container that holds
    over ``enough`` characters, else the largest block over ``least``, else all text
    over ``least``, else nothing; what is chosen must hold a character that
    ``letter`` matches. A null or empty page has no title and no text.
    """
    page = _Page()
    page.feed(html or "")
    page.close()
    found = re.compile(letter)
    ends = list(accumulate(map(len, page.pieces), initial=0))
    length = lambda e: ends[len(page.pieces) if e[3] is None else e[3]] - ends[e[2]]
    inside = lambda e: page.between(e[2], e[3])
    everything = page.between(0, None)
    text = _collapsed(everything)
    titles = (_collapsed(inside(e)) for tag in ("h1", "title") for e in page.elements if e[0] == tag)
    title = next((t for t in titles if t), text[:TITLE_CHARS].strip() or None)

    def main() -> str:
        for tag, name, value in CONTAINERS:
            e = next((e for e in page.elements if (not tag or e[0] == tag) and (not name or value in e[1].get(name, ""))), None)
            if e and length(e) > enough and found.search(inside(e)):
                return _collapsed(inside(e))
        for e in sorted((e for e in page.elements if e[0] in BLOCKS and length(e) > least), key=length, reverse=True):
            whole = inside(e).strip()
            if len(whole) > least and found.search(whole):
                return _collapsed(whole)
        return text if ends[-1] > least else ""

    return PageText(title, main(), text)


def main_content(html: str | None, letter: str = r"[^\W\d_]", enough: int = 200, least: int = 100) -> str:
    return page_text(html, letter, enough, least).main


@F.arrow_udf(T.StructType().add("title", T.StringType()).add("main", T.StringType()).add("text", T.StringType()))
def page_parts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """A struct of title, main and text of each page, from one parse."""
    for pages in batches:
        parts = [[], [], []]
        for k in range(0, len(pages), 64):  # few pages at a time are strings beside the batch that holds them
            for html in pages.slice(k, 64).to_pylist():
                for column, x in zip(parts, page_text(html)):
                    column.append(x)
        yield pa.StructArray.from_arrays([pa.array(p, pa.string()) for p in parts], ["title", "main", "text"])


def with_page_parts(df: DataFrame, html_col: str = "html", into: str = "page") -> DataFrame:
    """The frame with the struct of ``page_parts``; parsed once a row, whatever is read of it."""
    return df.withColumn(into, page_parts.asNondeterministic()(F.col(html_col)))


def concatenated(sections: Column) -> Column:
    """The text of a page that comes as an array of HTML sections."""
    return page_parts(F.array_join(sections, "\n"))["text"]


def tag_rows(df: DataFrame, tagger: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A black-box tagger (a rule set, or a client of a model) over batches of rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield tagger(pdf)

    return df.mapInPandas(run, schema)
