"""Hot keys: one key holding a third of all rows must give whole, exact results."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from sparkmart.operators.features import customer_features
from sparkmart.operators.quality import quality_summary
from sparkmart.operators.rollups import city_category_rollup
from sparkmart.sources.files import latest_per_key


def _skewed(spark, n=3000):
    rnd = random.Random(11)
    lines = []
    for i in range(n):
        cust = 0 if i % 3 == 0 else rnd.randint(1, 200)  # customer 0: a third of all lines
        order = i if cust else 10_000  # and all of its lines in one order
        lines.append((order, cust, rnd.randint(1, 20), float(rnd.randint(1, 5))))
    customers = spark.createDataFrame(
        [(c, f"c{c}", f"city{c % 4}", 20 + c % 40) for c in range(201)],
        "customer_id long, customer_name string, city string, age int")
    products = spark.createDataFrame(
        [(p, f"p{p}", f"cat{p % 3}", float(p) + 0.25, 1) for p in range(1, 21)],
        "product_id long, product_name string, category string, price double, stock int")
    ol = spark.createDataFrame(lines, "order_id long, customer_id long, product_id long, quantity double")
    return customers, ol, products, lines


def test_hot_customer_features_are_exact(spark):
    c, ol, p, lines = _skewed(spark)
    want_n = sum(1 for x in lines if x[1] == 0)
    want_spend = sum(x[3] * (x[2] + 0.25) for x in lines if x[1] == 0)
    a = {r["customer_id"]: r for r in customer_features(c, ol, p).collect()}
    header = ol.select("order_id", "customer_id").distinct()
    b = {r["customer_id"]: r for r in customer_features(
        c, ol.drop("customer_id"), p, orders=header).collect()}
    assert a[0]["total_orders"] == b[0]["total_orders"] == want_n
    assert abs(a[0]["total_spend"] - want_spend) < 1e-6 and a[0]["total_spend"] == b[0]["total_spend"]
    assert sorted(map(tuple, a.values())) == sorted(map(tuple, b.values()))


def test_hot_customer_rollup_counts_every_line(spark):
    c, ol, p, lines = _skewed(spark)
    header = ol.select("order_id", "customer_id").distinct()
    out = city_category_rollup(ol.drop("customer_id"), header, p, c).agg(F.sum("total_orders")).first()[0]
    assert out == len(lines)


def test_hot_duplicate_group(spark):
    rows = [(1, "x")] * 1000 + [(i, "y") for i in range(2000)]
    s = quality_summary(spark.createDataFrame(rows, "a int, b string")).first()
    assert (s["n_rows"], s["duplicate_rows"]) == (3000, 999)


def test_latest_per_key_with_key_in_every_snapshot(spark):
    rows = [(1, f"v{d}", f"2024-01-{d:02d}") for d in range(1, 29)] + [(2, "only", "2024-01-03")]
    df = spark.createDataFrame(rows, "k int, v string, d string").withColumn("snapshot_date", F.to_date("d"))
    got = {r["k"]: r["v"] for r in latest_per_key(df.drop("d"), ["k"]).collect()}
    assert got == {1: "v28", 2: "only"}
