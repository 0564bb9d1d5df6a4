"""Pipeline timing and scaling reports.

Timing tables hold one row per stage or per configuration — a handful of
rows fixed by the pipeline, not by the data — so the running-sum and
first-row windows below run over a single tiny partition by design.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.functions import round_half_up

TIMING_SCHEMA = "seq int, stage string, seconds double"
SCALING_SCHEMA = "workers int, seconds double"


def timing_frame(spark: SparkSession, timings: list[tuple[str, float | None]]) -> DataFrame:
    return spark.createDataFrame(
        [(i, s, t) for i, (s, t) in enumerate(timings)], TIMING_SCHEMA
    )


def cumulative_timings(df: DataFrame, digits: int = 1) -> DataFrame:
    """B2: per-stage seconds and the running total in stage order."""
    w = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(
        "seq",
        "stage",
        round_half_up(F.col("seconds"), digits).alias("seconds"),
        round_half_up(F.sum("seconds").over(w), digits).alias("cumulative_seconds"),
    )


def scaling_report(df: DataFrame, digits: int = 2) -> DataFrame:
    """Rows with a missing time are dropped (P14); speed-up is the first
    configuration's time over each time, efficiency is speed-up per worker."""
    clean = df.dropna(subset=["seconds"])
    w = Window.orderBy("workers").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    speedup = F.first("seconds").over(w) / F.col("seconds")
    return clean.select(
        "workers",
        "seconds",
        round_half_up(speedup, digits).alias("speedup"),
        round_half_up(speedup / F.col("workers"), digits).alias("efficiency"),
    ).orderBy("workers")


def pruning_report(spark: SparkSession, partitioned_path: str, flat_path: str,
                   column: str, value) -> DataFrame:
    """The same equality filter on a ``partitionBy`` layout and on a flat
    (unpartitioned) copy — equal matching rows, less data scanned when pruned.

    Both sides are measured alike: a layout's scan is narrowed by the filter
    only if its folders are named after ``column`` (``column=value``), and
    ``rows_scanned`` and ``files_read`` count what that scan reads.  Two equal
    layouts give equal numbers.
    """
    cond = F.col(column) == F.lit(value)

    def measure(path: str) -> DataFrame:
        df = spark.read.parquet(path)
        some = df.select(F.col("_metadata.file_path").alias("file")).first()
        if some is not None and f"/{column}=" in some["file"]:
            df = df.where(cond)
        tagged = df.select(cond.alias("hit"), F.col("_metadata.file_path").alias("file"))
        return tagged.agg(
            F.count_if("hit").alias("rows"),
            F.count(F.lit(1)).alias("rows_scanned"),
            F.count_distinct("file").alias("files_read"),
        )

    pruned, flat = measure(partitioned_path), measure(flat_path)
    cols = ["rows", "rows_scanned", "files_read"]
    return pruned.select(F.lit("partitioned").alias("layout"), *cols).unionByName(
        flat.select(F.lit("unpartitioned").alias("layout"), *cols)
    )
