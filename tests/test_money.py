"""Line values in their own types and exact sums (P3, A2), distinct categories
as bits (A15), rollups (A14)."""

from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.money import ExactSum, line_value, product_type
from sparkmart.operators import rollups
from sparkmart.operators.features import customer_features, line_values, spend_aggregate


def total(spark, rows, ddl):
    """(value per line, total) of one customer's lines."""
    lines = spark.createDataFrame([(1, 7, i, q) for i, (q, _) in enumerate(rows)],
                                  f"order_id long, customer_id long, product_id long, quantity {ddl[0]}")
    prices = spark.createDataFrame([(i, p) for i, (_, p) in enumerate(rows)],
                                   f"product_id long, price {ddl[1]}")
    priced = line_values(lines, prices)
    got = spend_aggregate(priced).first()
    return priced.schema["value"].dataType, got["total_spend"], got["avg_spend_per_order"]


def test_product_types():
    d = T.DecimalType
    assert product_type(T.IntegerType(), T.IntegerType()) == d(21, 0)
    assert product_type(T.IntegerType(), d(10, 4)) == d(21, 4)
    assert product_type(T.LongType(), d(38, 2)) == d(38, 2)
    assert product_type(d(38, 20), d(38, 20)) == d(38, 6)
    assert product_type(T.FloatType(), d(10, 2)) == T.DoubleType()


def test_small_units_are_kept(spark):
    assert total(spark, [(1.0, 0.125)], ("double", "double"))[1] == 0.125
    assert total(spark, [(10.0, 0.333)], ("double", "double"))[1] == 3.33
    kind, got, avg = total(spark, [(3, Decimal("0.0001")), (7, Decimal("1.2345"))], ("int", "decimal(12,4)"))
    assert kind == T.DecimalType(23, 4) and got == Decimal("8.6418") and avg == 4.3209
    kind, got, _ = total(spark, [(5, 2_000_000_000), (5, 2_000_000_000)], ("int", "int"))
    assert kind == T.DecimalType(21, 0) and got == 20_000_000_000


def test_totals_above_1e15_are_exact(spark):
    got = total(spark, [(1_000_000.0, 999_999_999.25)] * 4, ("double", "double"))[1]
    assert got == 4 * 999_999_999_250_000.0
    kind, got, _ = total(
        spark, [(10**12, Decimal("12345678901234.5678"))] * 3, ("long", "decimal(24,4)")
    )
    assert got == 3 * 10**12 * Decimal("12345678901234.5678") and kind.scale == 4


def test_sum_does_not_depend_on_the_order(spark):
    rng = random.Random(3)
    values = [round(rng.uniform(-1000, 1e6), rng.randrange(7)) for _ in range(3000)]
    want = math.fsum(values)
    rows = [(i, v) for i, v in enumerate(values)]
    for seed in range(3):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k long, value double").repartition(seed + 1)
        s = ExactSum.of(df, "value")
        once = df.agg(*s.first(F.col("value"))).select(s.total()).first()[0]
        twice = (
            df.groupBy((F.col("k") % 7).alias("g")).agg(*s.first(F.col("value"))).select(*s.carried())
            .agg(*s.merged()).select(s.total()).first()[0]
        )
        assert once == twice and math.isclose(once, want, rel_tol=1e-15)


def test_values_that_are_no_plain_numbers(spark):
    def one(values):
        df = spark.createDataFrame([(v,) for v in values], "value double")
        s = ExactSum.of(df, "value")
        return df.agg(*s.first(F.col("value"))).select(s.total()).first()[0]

    assert one([None, None]) is None and one([None, 2.5]) == 2.5
    assert math.isnan(one([1.0, float("nan")])) and one([1.0, float("inf")]) == float("inf")
    assert one([2e15, 0.5, 1e300]) == 1e300
    assert one([-0.25, -1.0]) == -1.25


def test_features_keep_the_inputs_type(spark):
    c = spark.createDataFrame([(1, "a", "x", 3), (2, "b", "y", 4)],
                              "customer_id long, customer_name string, city string, age int")
    o = spark.createDataFrame([(1, 1, 5, 3)], "order_id long, customer_id long, product_id long, quantity int")
    p = spark.createDataFrame([(5, Decimal("0.3333"))], "product_id long, price decimal(10,4)")
    got = customer_features(c, o, p)
    assert isinstance(got.schema["total_spend"].dataType, T.DecimalType)
    assert [tuple(r)[4:] for r in got.orderBy("customer_id").collect()] == [
        (1, Decimal("0.9999"), 1.0, 1), (0, Decimal("0"), 0.0, 1)
    ]


def _retail(spark, n_categories, seed=5):
    rng = random.Random(seed)
    products = [(i, f"c{i % n_categories}" if i % 11 else None, round(rng.uniform(1, 9), 3)) for i in range(400)]
    orders = [(o, rng.randrange(30)) for o in range(300)]
    lines = [(rng.randrange(300), rng.randrange(420), float(rng.randrange(1, 9))) for _ in range(2000)]
    lines += [(0, rng.randrange(400), 1.0) for _ in range(1000)]  # a third of all lines in one order
    frames = (
        spark.createDataFrame(lines, "order_id long, product_id long, quantity double"),
        spark.createDataFrame(orders, "order_id long, customer_id long"),
        spark.createDataFrame(products, "product_id long, category string, price double"),
    )
    price, cat = {p: x for p, _, x in products}, {p: c for p, c, _ in products}
    of = dict(orders)
    want: dict[int, list] = {}
    for o, p, q in lines:
        if p in price:
            w = want.setdefault(of[o], [0, [], set()])
            w[0] += 1
            w[1].append(q * price[p])
            w[2] |= {cat[p]} - {None}
    return frames, want, (lines, of, price, cat)


@pytest.mark.parametrize(("n", "coded"), [(3, 1024), (64, 1024), (65, 1024), (300, 1024), (65, 10)])
def test_categories_as_bits(spark, monkeypatch, n, coded):
    monkeypatch.setattr(rollups, "CODED", coded)
    (lines, orders, products), want, _ = _retail(spark, n)
    got = {r["customer_id"]: r for r in rollups.customer_categories(lines, orders, products).collect()}
    assert set(got) == set(want)
    for k, (count, values, categories) in want.items():
        assert (got[k]["total_orders"], got[k]["categories_bought"]) == (count, len(categories))
        assert math.isclose(got[k]["total_spend"], math.fsum(values), rel_tol=1e-12)


def test_rollup_equals_brute_force(spark):
    (lines, orders, products), _, (raw, of, price, cat) = _retail(spark, 7)
    customers = spark.createDataFrame([(c, f"t{c % 3}") for c in range(30)], "customer_id long, city string")
    want: dict = {}
    for o, p, q in raw:
        if p in price:
            w = want.setdefault((f"t{of[o] % 3}", cat[p]), [0, [], set()])
            w[0] += 1
            w[1].append(q * price[p])
            w[2].add(of[o])
    got = rollups.city_category_rollup(lines, orders, products, customers).collect()
    assert len(got) == len(want)
    for r in got:
        n, values, who = want[r["city"], r["category"]]
        assert (r["total_orders"], r["unique_customers"]) == (n, len(who))
        assert math.isclose(r["total_spend"], math.fsum(values), rel_tol=1e-12)


def test_line_value_of_nulls(spark):
    df = spark.createDataFrame([(None, 2.0), (3, None), (3, 2.0)], "q int, p double")
    types = df.schema["q"].dataType, df.schema["p"].dataType
    assert [r[0] for r in df.select(line_value(F.col("q"), F.col("p"), types)).collect()] == [None, None, 6.0]
