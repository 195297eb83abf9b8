"""Column expressions over text and delimited tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_tags(col: Column, sep: str = ";", keep_blank: bool = False) -> Column:
    """Trimmed items of a delimited column, first occurrence of each, blanks dropped unless kept; null is none."""
    items = F.transform(F.split(F.coalesce(col, F.lit("")), sep), lambda x: F.trim(x))
    return F.array_distinct(items if keep_blank else F.filter(items, lambda x: x != ""))


def join_tags(col: Column, sep: str = ";") -> Column:
    return F.array_join(col, f"{sep} ")


def word_set(col: Column, least: int = 1, stop: tuple[str, ...] = ()) -> Column:
    """Distinct lower-case words of at least ``least`` characters that are no stop words."""
    words = F.array_distinct(F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), r"(?U)[^\p{L}\p{N}]+", " ")), " "))
    return F.filter(words, lambda w: (F.length(w) >= least) & (w != "") & ~w.isin(*stop) if stop else (F.length(w) >= least) & (w != ""))


def jaccard(a: Column, b: Column, both_empty: float = 0.0) -> Column:
    """Shared over all items of two arrays of distinct items; 0 where one is empty."""
    both = F.array_size(F.array_intersect(a, b))
    return (
        F.when((F.array_size(a) == 0) & (F.array_size(b) == 0), F.lit(both_empty))
        .when((F.array_size(a) == 0) | (F.array_size(b) == 0), F.lit(0.0))
        .otherwise(both / (F.array_size(a) + F.array_size(b) - both))
    )


def clean(col: Column) -> Column:
    """White space runs to one space; zero-width and direction marks dropped."""
    return F.trim(F.regexp_replace(F.regexp_replace(col, "[​-‏‪-‮﻿]", ""), r"(?U)\s+", " "))


def strip_prefixes(col: Column, letters: str, rounds: int = 2, least: int = 3) -> Column:
    """Up to ``rounds`` leading letters of a set taken off while more than ``least`` characters remain."""
    for _ in range(rounds):
        col = F.when((F.length(col) > least) & F.substring(col, 1, 1).isin(*letters), F.substring(col, 2, 1 << 30)).otherwise(col)
    return col


def strip_suffix(col: Column, suffixes: tuple[str, ...], least: int = 3) -> Column:
    """The longest of the suffixes taken off if at least ``least`` characters remain."""
    out = col
    for s in sorted(suffixes, key=len):
        out = F.when(F.endswith(col, F.lit(s)) & (F.length(col) - len(s) >= least), F.substring(col, F.lit(1), F.length(col) - len(s))).otherwise(out)
    return out


def excerpt(col: Column, most: int, marker: str = " [...] ") -> Column:
    """A long text as its first 70 percent and last 30 percent of ``most`` characters."""
    head, tail = most * 7 // 10, most - most * 7 // 10
    return F.when(F.length(col) <= most, col).otherwise(F.concat(F.substring(col, 1, head), F.lit(marker), F.right(col, F.lit(tail))))


def change_hash(*cols: str) -> Column:
    """A digest of a row's columns in which null and blank agree."""
    return F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))
