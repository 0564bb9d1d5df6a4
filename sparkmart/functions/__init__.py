"""Column expressions shared by operators and queries.

Everything here is a built-in Spark expression, so it stays inside
whole-stage codegen.  The same formulas are written in the DuckDB oracle SQL;
keep the two in step.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

def round_half_up(c: Column, digits: int = 2) -> Column:
    """Half-up rounding written as plain double arithmetic.

    ``floor(x * 10^d + 0.5) / 10^d`` gives the same double in Spark and in
    DuckDB, unlike the engines' own ``round`` on doubles.
    """
    scale = 10 ** digits
    return (F.floor(c * scale + F.lit(0.5)) / F.lit(scale)).cast(T.DoubleType())


def is_missing(c: Column, dtype: T.DataType) -> Column:
    """Null test that also counts NaN for floating columns."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def hist_bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin index in ``[0, bins-1]``; a constant column is bin 0."""
    raw = F.floor((x - lo) * F.lit(bins) / (hi - lo))
    return (
        F.when(hi == lo, F.lit(0))
        .otherwise(F.least(raw, F.lit(bins - 1)))
        .cast(T.IntegerType())
    )


# Multiplicative (Knuth) hash fraction used for a partition-independent split.
# The key is reduced below 2^31 first so the product stays within a long.
HASH_MULTIPLIER = 2654435761
HASH_MODULUS = 4294967296


def hash_fraction(key: Column) -> Column:
    reduced = F.pmod(key.cast(T.LongType()), F.lit(2147483648))
    return (
        F.pmod(reduced * F.lit(HASH_MULTIPLIER), F.lit(HASH_MODULUS)).cast(T.DoubleType())
        / F.lit(float(HASH_MODULUS))
    )


def items_text(c: Column, sep: str = ", ") -> Column:
    """Array of strings as sorted text (CSV-safe form of a basket or rule side)."""
    return F.concat_ws(sep, F.array_sort(c))


def rule_label(antecedent: Column, consequent: Column) -> Column:
    """``[a, b] → [c]`` label for an association rule."""
    return F.concat(
        F.lit("["), items_text(antecedent), F.lit("] → ["), items_text(consequent), F.lit("]")
    )
