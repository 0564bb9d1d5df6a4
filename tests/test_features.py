"""Customer features (F1, F2), joins J1/J3/J4, label P4, baskets F3."""

from __future__ import annotations

import math

from fixtures import CUSTOMERS, brute_features, frames

from sparkmart.operators.features import baskets, customer_features


def test_features_match_brute_force_left_join(spark):
    c, o, p = frames(spark)
    got = {r["customer_id"]: r for r in customer_features(c, o, p).collect()}
    want = brute_features("keep")
    assert set(got) == {x[0] for x in CUSTOMERS}
    for cid, (n, total, avg) in want.items():
        r = got[cid]
        assert r["total_orders"] == n
        assert math.isclose(r["total_spend"], total, abs_tol=1e-9)
        assert math.isclose(r["avg_spend_per_order"], round(avg + 1e-12, 2), abs_tol=1e-9)


def test_unknown_product_counts_as_order_but_not_spend(spark):
    c, o, p = frames(spark)
    keep = {r["customer_id"]: r for r in customer_features(c, o, p).collect()}
    drop = {r["customer_id"]: r for r in customer_features(c, o, p, unknown_products="drop").collect()}
    assert keep[2]["total_orders"] == 2 and drop[2]["total_orders"] == 1
    assert keep[2]["total_spend"] == drop[2]["total_spend"] == 21.75


def test_customer_without_orders_is_filled(spark):
    c, o, p = frames(spark)
    r = {r["customer_id"]: r for r in customer_features(c, o, p).collect()}[5]
    assert (r["total_orders"], r["total_spend"], r["avg_spend_per_order"]) == (0, 0.0, 0.0)


def test_label_uses_lower_middle_median_and_ties_are_high(spark):
    c, o, p = frames(spark)
    rows = customer_features(c, o, p).collect()
    spends = sorted(r["total_spend"] for r in rows)
    median = spends[len(spends) // 2 - 1]  # six customers: the 3rd value
    for r in rows:
        assert r["is_high_value"] == (1 if r["total_spend"] >= median else 0)


def test_fill_all_numeric_also_fills_age(spark):
    c, o, p = frames(spark)
    f = customer_features(c, o, p, customer_cols=None, fill="all_numeric", round_average=False)
    assert {r["customer_id"]: r["age"] for r in f.collect()}[4] == 0
    f1 = customer_features(c, o, p)
    assert {r["customer_id"]: r["age"] for r in f1.collect()}[4] is None


def test_baskets_are_distinct_sorted_and_keep_commas(spark):
    c, o, p = frames(spark)
    b = {r["customer_id"]: r["items"] for r in baskets(o, p).collect()}
    assert b[1] == ["Laptop", "Mouse"]
    assert b[6] == ["Kopi, Arabika", "Mouse", "Teh"]
    assert b[2] == ["Kopi, Arabika"]  # the unknown product adds nothing


def test_per_order_plan_equals_line_plan(spark):
    from pyspark.sql import functions as F

    c, o, p = frames(spark)
    # the same orders split into line items and an order header (two lines per order id)
    lines = o.select(F.col("order_id"), "product_id", "quantity").unionByName(
        o.select(F.col("order_id"), F.lit(13).cast("long").alias("product_id"), F.lit(1.0).alias("quantity"))
    )
    header = o.select("order_id", "customer_id")
    joined = lines.join(header, "order_id")
    for unknown in ("keep", "drop"):
        a = customer_features(c, joined, p, unknown_products=unknown).collect()
        b = customer_features(c, lines, p, unknown_products=unknown, orders=header).collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_schema_rows(spark):
    from sparkmart.operators.profile import schema_rows

    c, _, _ = frames(spark)
    rows = [tuple(r) for r in schema_rows(c).collect()]
    assert rows[0] == (0, "customer_id", "bigint", True) and rows[3][1:3] == ("age", "int")
