"""Models and rules (F4–F7, M1–M7, A11, A12) on fixtures with known answers."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from sparkmart.mining import models as M
from sparkmart.mining import rules as R
from sparkmart.mining.prep import hash_split, standardized


def test_fp_growth_fixture(spark):
    b = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "b", "c"]), (3, ["a"]), (4, [])],
                              "basket_id int, items array<string>")
    freq, rules = R.fp_growth(b, "items", min_support=0.25, min_confidence=0.5)
    got = {r["items"]: r["freq"] for r in R.itemsets_as_text(freq).collect()}
    assert got["a"] == 3 and got["b"] == 2 and got["a, b"] == 2 and got["c"] == 1
    ab = [r for r in R.rules_as_text(rules).collect() if r["rule"] == "[a] → [b]"][0]
    assert math.isclose(ab["confidence"], 2 / 3) and math.isclose(ab["lift"], 4 / 3)
    assert math.isclose(ab["support"], 0.5)  # the empty basket counts in n


def _blobs(spark):
    rnd = random.Random(1)
    rows, cid = [], 0
    for cx, cy in [(0, 0), (50, 50), (100, 0)]:
        for _ in range(40):
            rows.append((cid, 30, cx + rnd.gauss(0, 1), cy + rnd.gauss(0, 1)))
            cid += 1
    return spark.createDataFrame(rows, "customer_id long, age int, total_orders double, total_spend double")


def test_kmeans_recovers_blobs_and_assigns_nearest(spark):
    df = _blobs(spark)
    out, model = M.run_kmeans(df, ["age", "total_orders", "total_spend"], k=3, seed=42)
    rows = out.collect()
    assert {r["cluster"] for r in rows} == {0, 1, 2}
    by_blob = {}
    for r in rows:
        by_blob.setdefault(r["customer_id"] // 40, set()).add(r["cluster"])
    assert all(len(v) == 1 for v in by_blob.values())
    centers = M.cluster_centers(spark, model, ["age", "total_orders", "total_spend"]).collect()
    # the constant column is 0 after scaling, and maps back to its value
    assert all(c["center_std"] == 0.0 and c["center_raw"] == 30.0 for c in centers if c["feature"] == "age")
    prof = M.cluster_profile(out).collect()
    assert sum(r["n_customers"] for r in prof) == 120


def test_kmeans_same_input_same_result(spark):
    df = _blobs(spark)
    a, _ = M.run_kmeans(df, ["total_orders", "total_spend"], k=3)
    b, _ = M.run_kmeans(df.repartition(3), ["total_orders", "total_spend"], k=3)
    key = lambda d: sorted((r["customer_id"], r["cluster"]) for r in d.collect())
    assert key(a) == key(b)


def _labeled(spark, n=400):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        spend = rnd.uniform(0, 1000)
        rows.append((i, rnd.randint(18, 60), rnd.randint(1, 30), spend, spend / 3,
                     rnd.choice(["A", "B", "C"]), 1 if spend >= 500 else 0))
    return spark.createDataFrame(rows, "customer_id long, age int, total_orders int, total_spend double,"
                                       " avg_spend_per_order double, city string, is_high_value int")


def test_decision_tree_depth_auc_and_metrics(spark):
    df = _labeled(spark)
    preds, auc = M.run_decision_tree(df, ["age", "total_orders", "total_spend"], ["city"])
    assert auc is not None and auc > 0.95  # the label is a threshold on total_spend
    m = M.classification_metrics(preds, "is_high_value")
    assert 0.9 < m["accuracy"] <= 1.0
    assert set(M.MULTICLASS_METRICS) == set(m)
    ref = M.classification_metrics_mllib(preds, "is_high_value")
    assert all(math.isclose(m[k], ref[k], rel_tol=1e-12) for k in ref)
    _, auc_free = M.run_decision_tree(df, ["age", "total_orders", "total_spend"], ["city"], leak_free=True)
    assert auc_free is not None and auc_free < 0.8


def test_one_class_test_part_gives_null_auc(spark):
    df = _labeled(spark).withColumn("is_high_value", F.lit(1))
    preds, auc = M.run_decision_tree(df, ["age", "total_orders"], [])
    assert auc is None


def test_metrics_match_evaluator_with_missing_cells(spark):
    rows = [(0, 0.0)] * 5 + [(0, 2.0)] * 2 + [(1, 1.0)] * 3 + [(2, 0.0)] * 4
    df = spark.createDataFrame(rows, "y int, prediction double")
    a, b = M.classification_metrics(df, "y"), M.classification_metrics_mllib(df, "y")
    assert all(math.isclose(a[k], b[k], rel_tol=1e-12, abs_tol=1e-15) for k in b)


def test_confusion_matrix_fills_missing_cells(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.0), (0, 1.0)], "y int, prediction double")
    rows = {r["y"]: (r["pred_0"], r["pred_1"]) for r in M.confusion_matrix(df, "y").collect()}
    assert rows == {1: (0, 2), 0: (0, 1)}


def test_hash_split_is_partition_independent(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r["k"] for r in hash_split(df, "k", 0.2)[1].collect()}
    b = {r["k"] for r in hash_split(df.repartition(7), "k", 0.2)[1].collect()}
    assert a == b and 150 < len(a) < 250


def test_standardized_zero_mean_unit_std(spark):
    df = _blobs(spark)
    z = standardized(df, ["age", "total_spend"], "customer_id").toPandas()
    assert (z["z_age"] == 0).all()
    assert abs(z["z_total_spend"].mean()) < 1e-9 and abs(z["z_total_spend"].std() - 1) < 1e-9


def test_assembler_rejects_null_by_default(spark):
    from pyspark.ml.feature import VectorAssembler  # noqa: F401

    from sparkmart.mining.prep import assembler

    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception):
        assembler(["a", "b"]).transform(df).collect()
    assert assembler(["a", "b"], handle_invalid="skip").transform(df).count() == 0


def test_itemset_estimate_of_dense_and_sparse_baskets(spark):
    import itertools

    items = [f"i{k}" for k in range(30)]
    dense = spark.createDataFrame([(b, items) for b in range(50)], "b int, items array<string>")
    est = R.estimate_frequent_itemsets(dense, "items", 0.05)
    assert est["max_size"] == 30 and est["estimate"] == 2**30 - 1
    sparse = spark.createDataFrame(
        [(b, list(p)) for b, p in enumerate(itertools.combinations(items[:6], 2))],
        "b int, items array<string>")
    assert R.estimate_frequent_itemsets(sparse, "items", 0.05)["max_size"] <= 2


def test_confusion_matrix_counts_every_class(spark):
    from sparkmart.mining import models as M

    rows = [(1.0, 2.0), (2.0, 2.0), (2.0, 0.0), (0.0, 0.0), (1.0, 1.0)]
    df = spark.createDataFrame(rows, "y double, prediction double")
    got = {r["y"]: (r["pred_0"], r["pred_1"], r["pred_2"]) for r in M.confusion_matrix(df, "y").collect()}
    assert got == {0.0: (1, 0, 0), 1.0: (0, 1, 1), 2.0: (1, 0, 1)}


def test_equal_baskets_are_mined_in_one_task(spark, monkeypatch):
    rows = [(i, [f"i{j}" for j in range(8) if i % 60 >> j & 1]) for i in range(600)]
    baskets = spark.createDataFrame(rows, "basket long, items array<string>").repartition(7)
    mined, fit = [], R.FPGrowth.fit
    monkeypatch.setattr(R.FPGrowth, "fit", lambda self, df: (mined.append(df), fit(self, df))[1])
    freq, rules = R.fp_growth(baskets, "items", 0.01, 0.1)
    kinds = mined[0].withColumn("task", F.spark_partition_id()).groupBy("items").agg(
        F.count_distinct("task").alias("tasks"), F.count(F.lit(1)).alias("n")
    )
    assert {(r.tasks, r.n) for r in kinds.collect()} == {(1, 10)}
    found = freq.collect()
    assert len(found) > 30 and rules.count() > 0
    for r in found:
        assert r.freq == sum(set(r["items"]) <= set(items) for _, items in rows)
