"""Exact and approximate quantiles without gathering a column into one task.

``quantile_disc`` returns the k-th smallest value, k = max(1, ceil(q * n)),
the same element SQL ``percentile_disc(q)`` picks (lower middle for the
median of an even count).  Spark's own ``percentile_disc`` merges a map of
every distinct value in a single task; here each pass is an ordinary
distributed aggregate of one row:

1. a pass over the band ``[lo, hi]`` that holds the k-th value (at first the
   whole column) counts the rows below it and in it and sketches it
   (``percentile_approx``, merged map-side) at ``bins + 1`` ranks;
2. the two sketched values that enclose rank k, with a margin for the sketch's
   error, are the next band.  The next pass's counts check it: if rank k is not
   in it (the sketch was off), the band on the side that holds it is taken;
3. a band of at most ``small`` rows is finished with a bounded top-k, a band of
   one repeated value at once.

Bands are chosen by rank and not by width, so a long tail costs no passes: each
one leaves about ``3 / bins`` of the rows.

Infinite values are counted and set aside like NaN (which sorts last), and a
pass that does not shrink the band is an error instead of an endless loop.

Persist the input first: each pass is a job over it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quantile_disc(
    df: DataFrame, col: str, q: float, bins: int = 256, small: int = 50_000
) -> float | None:
    if not 0.0 <= q <= 1.0:
        raise ValueError(f"quantile must be in [0, 1], got {q}")
    x = F.col(col)
    floating = isinstance(df.schema[col].dataType, (T.FloatType, T.DoubleType))
    values = df.select(x.alias("v")).where(F.col("v").isNotNull())
    # NaN sorts above every number (as in SQL); refine over the finite rest
    inf = float("inf")
    nan = F.isnan("v") if floating else F.lit(False)
    top = (F.col("v") == inf) & ~nan if floating else F.lit(False)
    bottom = F.col("v") == -inf if floating else F.lit(False)
    finite = ~nan & ~top & ~bottom
    first = _pass(values, finite, None, None, bins, [
        F.count("v").alias("n"),
        F.count_if(nan).alias("nan"),
        F.count_if(top).alias("top"),
        F.count_if(bottom).alias("bottom"),
    ])
    n = first["n"]
    if n == 0:
        return None
    k = max(1, math.ceil(q * n))  # 1-based rank wanted
    if k > n - first["nan"]:
        return float("nan")
    if k > n - first["nan"] - first["top"]:
        return inf
    if k <= first["bottom"]:
        return -inf
    k -= first["bottom"]
    if floating:
        values = values.where(finite)
    lo, hi, below, band_n, ranks = first["lo"], first["hi"], 0, first["band"], first["ranks"]
    while True:
        if lo == hi:
            return lo
        if band_n <= small:
            band = values.where((F.col("v") >= F.lit(lo)) & (F.col("v") <= F.lit(hi)))
            return band.orderBy("v").offset(k - below - 1).limit(1).first()["v"]
        at = (k - below) / band_n * bins
        a, b = max(0, math.floor(at) - 1), min(bins, math.ceil(at) + 1)
        new_lo, new_hi = max(lo, ranks[a]), min(hi, ranks[b])
        # A few heavy values, or ones that the sketch (doubles) cannot tell apart.
        if new_hi < new_lo or (new_lo == lo and new_hi == hi):
            if (one := _heavy(values, lo, hi, k - below)) is not None:
                return one
            raise ArithmeticError(f"the band [{lo}, {hi}] of {col} cannot be narrowed")
        got = _pass(values, F.lit(True), new_lo, new_hi, bins, [
            F.count_if(F.col("v") < F.lit(new_lo)).alias("under"),
            F.max(F.when(F.col("v") < F.lit(new_lo), F.col("v"))).alias("last_under"),
            F.min(F.when(F.col("v") > F.lit(new_hi), F.col("v"))).alias("first_over"),
        ])
        if k <= got["under"]:  # the sketch was off: the wanted value is below
            hi, band_n = got["last_under"], got["under"] - below
        elif k > got["under"] + got["band"]:  # or above
            lo = got["first_over"]
            band_n -= got["under"] - below + got["band"]
            below = got["under"] + got["band"]
        else:
            lo, hi, below, band_n, ranks = got["lo"], got["hi"], got["under"], got["band"], got["ranks"]
            continue
        # Sketch the band that was left over.
        ranks = _pass(values, F.lit(True), lo, hi, bins, [])["ranks"]


def _pass(values: DataFrame, keep: Column, lo, hi, bins: int, more: list[Column]):
    """One row: ``more`` over all rows; count, least, greatest and ``bins + 1``
    evenly ranked values of those kept in ``[lo, hi]``."""
    if lo is not None:
        keep = keep & (F.col("v") >= F.lit(lo)) & (F.col("v") <= F.lit(hi))
    v = F.when(keep, F.col("v"))
    return values.agg(
        *more,
        F.count(v).alias("band"), F.min(v).alias("lo"), F.max(v).alias("hi"),
        F.percentile_approx(v, [i / bins for i in range(bins + 1)], 20 * bins).alias("ranks"),
    ).first()


def _heavy(values: DataFrame, lo, hi, k: int):
    """The k-th value of a band with a few heavy values (None if they are not few)."""
    band = values.where((F.col("v") >= F.lit(lo)) & (F.col("v") <= F.lit(hi)))
    below = 0
    for r in band.groupBy("v").count().orderBy("v").limit(4096).collect():
        below += r["count"]
        if below >= k:
            return r["v"]
    return None


def rank_error(df: DataFrame, col: str, q: float, value: float) -> float | None:
    """How far ``value``'s rank is from ``q``, as a share of the rows (0 if the
    wanted rank is one of its own); None without rows."""
    r = df.where(F.col(col).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(col) < F.lit(value)).alias("below"),
        F.count_if(F.col(col) <= F.lit(value)).alias("upto"),
    ).first()
    if not r["n"]:
        return None
    k = max(1, math.ceil(q * r["n"]))
    return max(0, r["below"] + 1 - k, k - r["upto"]) / r["n"]


def approx_quantile(df: DataFrame, col: str, q: float, rel_error: float = 0.01) -> float | None:
    """The reference's estimator: Greenwald-Khanna sketch, merged per partition."""
    got = df.approxQuantile(col, [q], rel_error)
    return got[0] if got else None
