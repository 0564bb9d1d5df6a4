"""Synthetic generator (G1–G4) and reports."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from sparkmart import synth
from sparkmart.mining import rules as R
from sparkmart.operators.features import baskets
from sparkmart.reports import cumulative_timings, scaling_report, timing_frame


def test_products_and_customers(spark):
    p = synth.products(spark)
    assert p.count() == 100 and p.select("category").distinct().count() == 10
    lo, hi = p.agg(F.min("price"), F.max("price")).first()
    assert 5_000 <= lo and hi <= 2_000_000
    c = synth.customers(spark, 500).collect()
    assert len(c) == 500 and all(18 <= r["age"] <= 60 for r in c)
    assert c[0]["name"] == "Adi Santoso" and c[300]["name"].endswith(" 2")


def test_planted_patterns(spark):
    n = 40_000
    orders = synth.orders(spark, n, n_customers=400, num_partitions=4).persist()
    assert orders.select("order_id").distinct().count() == orders.count()
    prods = synth.products(spark)
    ids = {r["name"]: r["product_id"] for r in prods.collect()}
    base = orders.where(F.col("order_id") <= n)
    laptops = base.where(F.col("product_id") == ids["Laptop"]).count()
    extra = orders.where((F.col("order_id") > n) & (F.col("product_id") == ids["Mouse"])).count()
    rate = extra / laptops
    assert abs(rate - 0.65) < 0.1
    # the planted rule is recovered from customer-day baskets
    b = baskets(orders, prods, ["customer_id", "order_date"], "name", "drop").persist()
    _, rules = R.fp_growth(b, "items", min_support=0.0005, min_confidence=0.3)
    hit = [r for r in R.rules_as_text(rules).collect() if r["rule"] == "[Laptop] → [Mouse]"]
    assert hit and hit[0]["lift"] > 1.0
    assert synth.products(spark).collect() == synth.products(spark).collect()  # seeded


def test_cumulative_timings(spark):
    df = timing_frame(spark, [("load", 1.04), ("features", 2.0), ("rules", 0.55)])
    rows = cumulative_timings(df).orderBy("seq").collect()
    assert [r["cumulative_seconds"] for r in rows] == [1.0, 3.0, 3.6]


def test_scaling_report_drops_missing_time(spark):
    df = spark.createDataFrame([(1, 60.0), (2, 40.0), (3, None), (4, 20.0)], "workers int, seconds double")
    rows = scaling_report(df).collect()
    assert [(r["workers"], r["speedup"], r["efficiency"]) for r in rows] == [
        (1, 1.0, 1.0), (2, 1.5, 0.75), (4, 3.0, 0.75),
    ]
    assert math.isclose(rows[1]["seconds"], 40.0)


def test_pruning_report_reads_fewer_files(spark, tmp_path):
    from sparkmart.reports import pruning_report
    from sparkmart.sinks.files import write_parquet, write_partitioned_parquet

    df = spark.range(600).selectExpr("id", "concat('C', cast(id % 6 as string)) AS city").repartition(4)
    part = write_partitioned_parquet(df, str(tmp_path / "by_city"), ["city"])
    flat = write_parquet(df, str(tmp_path / "flat"))
    rows = {r["layout"]: r for r in pruning_report(spark, part, flat, "city", "C1").collect()}
    assert rows["partitioned"]["rows"] == rows["unpartitioned"]["rows"] == 100
    assert rows["partitioned"]["rows_scanned"] == 100
    assert rows["unpartitioned"]["rows_scanned"] == 600
    assert rows["partitioned"]["files_read"] <= rows["unpartitioned"]["files_read"]
