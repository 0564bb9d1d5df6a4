"""Feature preparation for the models."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions import hash_fraction, round_half_up


def assembler(cols: list[str], out: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    """F4.  A NULL input raises by default; ``"skip"`` drops the row and
    ``"keep"`` writes NaN — the caller decides, nothing is silently filled."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid)


def scaler(inp: str = "raw_features", out: str = "features") -> StandardScaler:
    """zero mean, unit sample standard deviation (constant column → 0)."""
    return StandardScaler(inputCol=inp, outputCol=out, withMean=True, withStd=True)


def indexer(col: str, out: str | None = None) -> StringIndexer:
    """most frequent category → 0.0, ties alphabetical, unseen → extra index."""
    return StringIndexer(inputCol=col, outputCol=out or f"{col}_idx", handleInvalid="keep",
                         stringOrderType="frequencyDesc")


def standardized(df: DataFrame, cols: list[str], key: str, digits: int | None = None) -> DataFrame:
    """F5 applied: one ``z_<col>`` column per input column, keyed rows."""
    from pyspark import StorageLevel
    from pyspark.ml import Pipeline

    # fit (mean / std pass) and transform both read the input: evaluate it once
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    model = Pipeline(stages=[assembler(cols, "raw_features"), scaler()]).fit(df)
    arr = vector_to_array(F.col("features"))
    zs = []
    for i, c in enumerate(cols):
        z = arr[i]
        zs.append((round_half_up(z, digits) if digits is not None else z).alias(f"z_{c}"))
    return model.transform(df).select(key, *zs)


def hash_split(df: DataFrame, key: str, test_ratio: float) -> tuple[DataFrame, DataFrame]:
    """a train/test split decided by a hash of the key.

    Unlike ``randomSplit``, membership does not depend on partitioning or
    row order, so every run and every engine picks the same rows.
    """
    number = F.col(key)
    if isinstance(df.schema[key].dataType, T.StringType):  # text keys by their hash
        number = F.xxhash64(key)
    is_test = hash_fraction(number) < F.lit(test_ratio)
    return df.where(~is_test), df.where(is_test)


def split_column(key: str, test_ratio: float):
    return F.when(hash_fraction(F.col(key)) < F.lit(test_ratio), F.lit("test")).otherwise(
        F.lit("train")
    )
