"""Taggers over batches of rows: the place of a language model, with rules as the default and as the fallback."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

FIELDS = "summary string, operativity string, tags string, confidence double, tagged_by string"
Tagger = Callable[[str, str], dict]


def rule_tagger(keywords: dict[str, tuple[str, ...]], operative: tuple[str, ...], fallback: str) -> Tagger:
    """Summary, class and tags of a title and text by words; no model."""

    def tag(title: str, text: str) -> dict:
        low = f"{title} {text}".lower()
        hits = {t: sum(w in low for w in ws) for t, ws in keywords.items()}
        tags = [t for t, n in sorted(hits.items(), key=lambda x: -x[1]) if n][:3]
        first = re.split(r"(?<=[.!?])\s", text.strip(), maxsplit=1)[0]
        return {"summary": first[:500], "operativity": "operative" if any(w in low for w in operative) else "declarative",
                "tags": "; ".join(tags) or fallback, "confidence": min(1.0, 0.5 + 0.1 * sum(hits.values()))}

    return tag


def tag_records(df: DataFrame, tagger: Tagger, fallback: Tagger | None = None, allowed: tuple[str, ...] | None = None, title: str = "title", text: str = "content") -> DataFrame:
    """The columns of ``df`` with those of a tagger; where it fails or leaves a field out, those of the fallback; tags outside ``allowed`` go.

    Rows are tagged in batches in their partitions; a tagger that holds a client
    opens it when it is first called in a worker.
    """
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def one(t: str | None, x: str | None) -> tuple:
        by, out = "tagger", None
        try:
            out = tagger(t or "", x or "")
            if not all(out.get(f) for f in ("summary", "operativity", "tags")):
                raise ValueError("a field is missing")
        except Exception:  # noqa: BLE001 - whatever a tagger raises, its row falls back
            if fallback is None:
                out, by = {}, "none"
            else:
                out, by = fallback(t or "", x or ""), "fallback"
        tags = [a.strip() for a in (out.get("tags") or "").split(";") if a.strip()]
        if allowed is not None:
            tags = [a for a in dict.fromkeys(tags) if a in allowed]
        return out.get("summary"), out.get("operativity"), "; ".join(tags), min(1.0, max(0.0, float(out.get("confidence") or 0))), by

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([one(t, x) for t, x in zip(pdf["__title"], pdf["__text"])], columns=names, index=pdf.index).assign(__row=pdf["__row"])[[*names, "__row"]]

    # rows meet their tags by a struct that travels along as JSON text: ids never become floating point
    from pyspark.sql import functions as F

    packed = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("__row"), F.col(title).alias("__title"), F.col(text).alias("__text"))
    tagged = packed.mapInPandas(run, f"{FIELDS}, __row string")
    return tagged.select(F.from_json("__row", df.schema).alias("r"), *names).select("r.*", *names)
