"""Plan properties the scale design relies on (checked on the physical plan)."""

from __future__ import annotations

import os
import re

import pytest

from sparkmart import adapter
from sparkmart.operators import features as feat

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_scans_read_only_needed_columns(spark):
    c, li, p, o = adapter.feature_inputs(spark, SF)
    plan = plan_of(feat.customer_features_unlabeled(c, li, p, orders=o))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all(set(x.split(":")[0] for x in s.split(",")) <= {
        "l_orderkey", "l_partkey", "l_quantity"} for s in lineitem)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_rollups_exchange_no_raw_lines_and_expand_nothing(spark):
    """With broadcasts off: after pricing, every exchange carries partial sums."""
    from sparkmart.operators.rollups import city_category_rollup, customer_categories

    c, li, p, o = adapter.feature_inputs(spark, SF)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (city_category_rollup(li, o, p, c), customer_categories(li, o, p)):
            plan = plan_of(df)
            assert "Expand" not in plan and "distinct" not in plan.lower()
            lines = plan.split("\n")
            place = [len(re.match(r"[ :+\-*]*", x)[0]) for x in lines]
            seen = 0
            for i, x in enumerate(lines):
                below = []
                for j in range(i + 1, len(lines)):
                    if place[j] <= place[i]:
                        break
                    below.append(lines[j])
                # Exchanges above the pricing join of the line items.
                if "Exchange hashpartitioning" in x and any("l_quantity" in y for y in below) and any(
                    "SortMergeJoin [product_id" in y for y in below
                ):
                    node = next(y for y in below if " Project " not in y)
                    assert "HashAggregate" in node, x
                    seen += 1
            assert seen >= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_duplicate_check_exchanges_fingerprints_only(spark):
    from sparkmart.operators.quality import duplicate_summary

    li = adapter.table(spark, SF, "lineitem")
    exchanges = [x for x in plan_of(duplicate_summary(li)).split("\n") if "Exchange" in x]
    assert exchanges and not any("l_" in x for x in exchanges)
    assert "Join" not in plan_of(duplicate_summary(li))


def test_rows_that_hash_alike_are_told_apart(spark):
    from sparkmart.operators.quality import duplicate_summary

    rows = [("a", None, None), (None, "a", None), (None, None, "a"), ("", None, None), (None, "", None),
            (None, None, None), ("ab", "c", None), ("a", "bc", None), ("a", None, None)]
    got = duplicate_summary(spark.createDataFrame(rows, "x string, y string, z string")).first()
    assert tuple(got) == (9, 1)
