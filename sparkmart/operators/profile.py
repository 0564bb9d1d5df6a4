"""Profiling: counts, frequencies, typed describe, histograms, schema rows.

All of these are single aggregate jobs: partial aggregation in every task,
then one small final merge, so their shuffle is bounded by the number of
groups, not rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions import hist_bin


def frequency(df: DataFrame, col: str, count_col: str = "count") -> DataFrame:
    """Rows per value, most frequent first (value breaks ties)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(count_col)).orderBy(F.desc(count_col), col)


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct values in ascending order."""
    return df.select(col).distinct().orderBy(col)


def describe(df: DataFrame, cols: list[str], digits: int | None = None) -> DataFrame:
    """A9 as a typed long-form table: column, count, mean, stddev, min, max.

    ``df.describe`` returns every statistic as text; this keeps numbers as
    doubles and computes all columns in one aggregate pass.  ``stddev`` is the
    sample standard deviation (NULL for fewer than two values).
    ``digits`` rounds mean and stddev half-up for cross-engine comparison.

    With a text column among ``cols`` there are two more, ``min_text`` and
    ``max_text``: of a text column ``count`` is that of its values, mean and
    stddev are those of the values that are numbers, ``min`` and ``max`` are
    NULL and the extremes are texts, by code point.
    """
    from sparkmart.functions import round_half_up

    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    any_text = any(c in text for c in cols)

    def stat(c: str):
        raw, is_text = F.col("`" + c.replace("`", "``") + "`"), c in text
        x = raw.try_cast(T.DoubleType()) if is_text else raw.cast(T.DoubleType())
        mean, sd = F.avg(x), F.stddev_samp(x)
        if digits is not None:
            mean, sd = round_half_up(mean, digits), round_half_up(sd, digits)
        return F.struct(
            F.lit(c).alias("column_name"),
            F.count(raw if is_text else x).alias("count"),
            mean.alias("mean"),
            sd.alias("stddev"),
            (F.lit(None).cast("double") if is_text else F.min(x)).alias("min"),
            (F.lit(None).cast("double") if is_text else F.max(x)).alias("max"),
            *[
                (fn(raw) if is_text else F.lit(None).cast("string")).alias(name)
                for fn, name in ((F.min, "min_text"), (F.max, "max_text")) if any_text
            ],
        )

    return df.agg(F.array(*[stat(c) for c in cols]).alias("s")).select(F.inline("s"))


def _numbers(df: DataFrame, col: str) -> DataFrame:
    """Rows with a number in ``col`` (NULL and, for floating columns, NaN skipped)."""
    keep = F.col(col).isNotNull()
    if isinstance(df.schema[col].dataType, (T.FloatType, T.DoubleType)):
        keep = keep & ~F.isnan(col)
    return df.where(keep)


def min_max(df: DataFrame, col: str) -> tuple[float | None, float | None]:
    row = _numbers(df, col).agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return row["lo"], row["hi"]


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over [min, max]; the max falls in the last bin.

    Returns every bin (``bin, bin_lo, bin_hi, count``), empty ones with 0;
    NULL and NaN values are not counted.
    Bounds come from one small aggregate; the counting pass is lazy.
    """
    spark = df.sparkSession
    lo, hi = min_max(df, col)
    if lo is None:
        schema = "bin int, bin_lo double, bin_hi double, count long"
        return spark.createDataFrame([], schema)
    lo_c, hi_c = F.lit(float(lo)), F.lit(float(hi))
    counts = (
        _numbers(df, col)
        .select(hist_bin(F.col(col).cast(T.DoubleType()), lo_c, hi_c, bins).alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    width = (hi_c - lo_c) / F.lit(bins)
    edges = spark.range(bins).select(
        F.col("id").cast(T.IntegerType()).alias("bin"),
    )
    return (
        edges.join(counts, "bin", "left")
        .select(
            "bin",
            (lo_c + F.col("bin") * width).alias("bin_lo"),
            (lo_c + (F.col("bin") + 1) * width).alias("bin_hi"),
            F.coalesce(F.col("count"), F.lit(0).cast(T.LongType())).alias("count"),
        )
        .orderBy("bin")
    )


def table_counts(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """One row per named frame with its row count (one job per frame,
    each a metadata-friendly ``count`` over the scan)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in frames.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as rows (position, name, type, nullable)."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean"
    )
