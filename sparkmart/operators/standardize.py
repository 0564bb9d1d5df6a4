"""Column standardisation (N1–N3): normalised names, source type, ingestion time.

Renaming is metadata only (``toDF``); the two stamps are literals, so the
whole step is a projection fused into the next stage's codegen.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalize_column_name(name: object) -> str:
    """Whole-name strip, lower case, each single space → ``_`` (tabs stay)."""
    return str(name).strip().lower().replace(" ", "_")


def utc_now_iso() -> str:
    """ISO-8601 UTC time with offset, e.g. ``2026-03-26T04:08:38.089433+00:00``."""
    return datetime.now(timezone.utc).isoformat()


def normalized_names(columns: list[str]) -> list[str]:
    new = [normalize_column_name(c) for c in columns]
    seen: dict[str, str] = {}
    for raw, n in zip(columns, new):
        if n in seen:
            raise ValueError(
                f"columns {seen[n]!r} and {raw!r} both normalise to {n!r}; rename one first"
            )
        seen[n] = raw
    return new


def standardize_columns(
    df: DataFrame, source_type: str, ingestion_time: str | None = None
) -> DataFrame:
    """N1 + N2 + N3.  ``ingestion_time`` defaults to the run clock (one value
    for the whole batch); pass it to make a run reproducible."""
    stamp = ingestion_time if ingestion_time is not None else utc_now_iso()
    renamed = df.toDF(*normalized_names(df.columns))
    return renamed.withColumn("source_type", F.lit(source_type)).withColumn(
        "ingestion_time", F.lit(stamp)
    )
