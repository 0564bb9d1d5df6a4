"""File sinks: processed-zone CSV (K2), dated raw-zone CSV (K1), partitioned
Parquet (K3), and CSV-safe conversions of ML output (K5, K6).

Writes go straight from the executors to storage; nothing passes through
the driver.  ``mode("overwrite")`` makes a rerun of a stage idempotent.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.sinks.manifest import dated_path, land

# Rows per output file; a hot partition value lands as several files instead
# of one huge one (nothing is dropped).
MAX_RECORDS_PER_FILE = 5_000_000


def drop_vectors(df: DataFrame) -> DataFrame:
    """K5: drop every ML vector column (CSV cannot store them)."""
    vec = [f.name for f in df.schema.fields if isinstance(f.dataType, VectorUDT)]
    return df.drop(*vec) if vec else df


def arrays_to_text(df: DataFrame, sep: str = ", ") -> DataFrame:
    """K6: ``array<string>`` columns joined to text with ``sep``."""
    out = df
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            out = out.withColumn(f.name, F.concat_ws(sep, F.col(f.name)))
    return out


def csv_safe(df: DataFrame) -> DataFrame:
    return arrays_to_text(drop_vectors(df))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K2: multi-part CSV with a header row."""
    (
        csv_safe(df)
        .write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .csv(path)
    )
    return path


def write_dated_csv(df: DataFrame, base: str, name: str, run_date: str, part: str = "") -> str:
    """K1: land a snapshot (or a ``part`` of it) under today's folder and commit
    it to the manifest; a same-day rerun replaces it."""
    return land(write_csv, df, base, name, run_date, part)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)
    return path


def write_partitioned_parquet(
    df: DataFrame, path: str, by: list[str], mode: str = "overwrite"
) -> str:
    """K3: Parquet in ``key=value`` folders.

    Rows are dealt by the key and then rebalanced by size at run time: small
    values share a task, and a hot value (say a third of all rows) is split
    into several, each of ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
    (with the small values that share its shuffle partition).  A value's files thus grow with its size and not with the number of tasks.
    Where the session has adaptive execution off nothing would split a hot
    value, so each task writes its own file per value.  ``maxRecordsPerFile``
    bounds file size in both cases.
    """
    if str(df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true")).lower() == "true":
        df = df.hint("rebalance", *by)
    (
        df.write.mode(mode)
        .partitionBy(*by)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .parquet(path)
    )
    return path
