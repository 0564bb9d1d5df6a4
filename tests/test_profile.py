"""Profiling operators (A6–A9, A13, T2) against hand-computed answers."""

from __future__ import annotations

import math

from sparkmart.operators.profile import describe, distinct_sorted, frequency, histogram, table_counts
from sparkmart.operators.rollups import top_k


def test_histogram_matches_hand_bins(spark):
    xs = [0.0, 1.0, 2.5, 5.0, 9.99, 10.0, None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    rows = histogram(df, "x", bins=10).collect()
    assert [r["bin"] for r in rows] == list(range(10))
    counts = {r["bin"]: r["count"] for r in rows}
    assert counts == {0: 1, 1: 1, 2: 1, 3: 0, 4: 0, 5: 1, 6: 0, 7: 0, 8: 0, 9: 2}  # max in last bin
    assert rows[3]["bin_lo"] == 3.0 and rows[3]["bin_hi"] == 4.0


def test_histogram_constant_and_empty(spark):
    const = spark.createDataFrame([(7,)] * 5, "x int")
    rows = histogram(const, "x", bins=4).collect()
    assert [r["count"] for r in rows] == [5, 0, 0, 0]
    empty = spark.createDataFrame([], "x double")
    assert histogram(empty, "x").count() == 0


def test_describe_typed_long_form(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, None)], "a int, b double")
    rows = {r["column_name"]: r for r in describe(df, ["a", "b"]).collect()}
    assert rows["a"]["count"] == 3 and rows["a"]["mean"] == 2.0 and rows["a"]["stddev"] == 1.0
    assert (rows["a"]["min"], rows["a"]["max"]) == (1.0, 3.0)
    assert rows["b"]["count"] == 1 and rows["b"]["stddev"] is None  # fewer than two values


def test_frequency_ties_and_distinct(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",)], "city string")
    assert [tuple(r) for r in frequency(df, "city").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert [r["city"] for r in distinct_sorted(df, "city").collect()] == ["a", "b", "c"]


def test_table_counts_and_top_k(spark):
    a = spark.range(5)
    b = spark.range(3)
    assert {r["table_name"]: r["row_count"] for r in table_counts(spark, {"a": a, "b": b}).collect()} == {
        "a": 5, "b": 3}
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 9.0), (4, 1.0)], "id int, v double")
    assert [r["id"] for r in top_k(df, 2, "v", "id").collect()] == [2, 3]
    assert math.isclose(top_k(df, 1, "v", "id").first()["v"], 9.0)


def test_histogram_skips_nan(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (float("nan"),), (5.0,)], "x double")
    rows = histogram(df, "x", bins=2).collect()
    assert [r["count"] for r in rows] == [1, 2]


def test_describe_of_texts(spark):
    from sparkmart.operators.profile import describe

    df = spark.createDataFrame([("10", 1), ("x", 2), (None, 3), ("é", None)], "`a.b` string, n int")
    text, number = describe(df, ["a.b", "n"]).collect()
    assert tuple(text) == ("a.b", 3, 10.0, None, None, None, "10", "é")
    assert tuple(number) == ("n", 3, 2.0, 1.0, 1.0, 3.0, None, None)
    assert "min_text" not in describe(df, ["n"]).columns
    none = describe(df.limit(0), ["a.b"]).first()
    assert none["count"] == 0 and none["min_text"] is None
