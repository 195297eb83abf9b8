"""The query catalogue: name -> (spark, sf_dir) -> DataFrame, and its DuckDB oracles."""

from __future__ import annotations

from docloom.plans import checks, classified, fixes, loading, mentions, metrics, quality, records, tagged, tags, urls, views

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

for _module in (quality, views, records, checks, tags, fixes, metrics, tagged, urls, loading, mentions, classified):
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
