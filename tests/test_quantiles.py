"""Exact distributed quantile vs brute force (A10)."""

from __future__ import annotations

import math
import random

import pytest

from sparkmart.operators.quantiles import approx_quantile, quantile_disc


def brute(values, q):
    xs = sorted(v for v in values if v is not None)
    if not xs:
        return None
    return xs[max(1, math.ceil(q * len(xs))) - 1]


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_matches_brute_force_with_refinement(spark, q):
    rnd = random.Random(7)
    values = [rnd.gauss(0, 1000) for _ in range(3000)] + [None] * 10
    df = spark.createDataFrame([(v,) for v in values], "x double")
    # tiny band limit and few bins force several refinement passes
    assert quantile_disc(df, "x", q, bins=4, small=20) == brute(values, q)


def test_hot_value_holding_a_third_of_rows(spark):
    rnd = random.Random(3)
    values = [5.0] * 1000 + [rnd.uniform(0, 10) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for q in (0.2, 0.5, 0.8):
        assert quantile_disc(df, "x", q, bins=8, small=50) == brute(values, q)


def test_even_count_takes_lower_middle(spark):
    df = spark.createDataFrame([(v,) for v in [4, 1, 3, 2]], "x long")
    assert quantile_disc(df, "x", 0.5) == 2


def test_integers_and_empty(spark):
    df = spark.createDataFrame([(v,) for v in range(1, 102)], "x int")
    assert quantile_disc(df, "x", 0.5, bins=3, small=5) == 51
    empty = spark.createDataFrame([], "x double")
    assert quantile_disc(empty, "x", 0.5) is None


def test_approx_within_one_percent_rank(spark):
    values = list(range(10_000))
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = approx_quantile(df, "x", 0.5, 0.01)
    assert abs(got - 5000) <= 0.01 * 10_000


def test_nan_sorts_above_numbers(spark):
    values = [1.0, 2.0, 3.0, float("nan"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert quantile_disc(df, "x", 0.5) == 3.0  # 3rd of 5
    assert math.isnan(quantile_disc(df, "x", 0.8))  # 4th of 5 is NaN
    sql = df.selectExpr("percentile_disc(0.5) WITHIN GROUP (ORDER BY x) AS m").first()["m"]
    assert sql == 3.0


def test_infinite_wide_and_close_values(spark):
    inf = float("inf")
    doubles = [-inf] * 3 + [float(i) for i in range(90)] + [1e308, -1e308] + [inf] * 4 + [float("nan")]
    df = spark.createDataFrame([(v,) for v in doubles], "v double").repartition(3)
    ranked = sorted(doubles[:-1]) + doubles[-1:]
    for q in (0.0, 0.02, 0.04, 0.3, 0.5, 0.9, 0.97, 0.98):
        want = ranked[max(1, math.ceil(q * len(doubles))) - 1]
        assert quantile_disc(df, "v", q, bins=4, small=3) == want
    longs = [-(2**62), 2**62, 2**62 + 1, 2**62 + 2, 2**62 + 3, 5, 6, 7]
    df = spark.createDataFrame([(v,) for v in longs], "v long")
    for q in (0.1, 0.4, 0.6, 0.8, 1.0):
        want = sorted(longs)[max(1, math.ceil(q * len(longs))) - 1]
        assert quantile_disc(df, "v", q, bins=4, small=1) == want
