"""K-Means at a fixed point (M1, M2), the exact split (M3), exact and
approximate quantiles on long tails (A10)."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from sparkmart.mining.exact import best_split, fixed_point_kmeans, kmeans_invariants
from sparkmart.operators import quantiles as Q


def blobs(spark, extra=()):
    rnd = random.Random(1)
    rows = [
        (100 * b + i, 7.0, x + rnd.gauss(0, 1), y + rnd.gauss(0, 1))
        for b, (x, y) in enumerate([(0, 0), (50, 50), (100, 0)]) for i in range(40)
    ]
    return spark.createDataFrame([*rows, *extra], "id long, c double, x double, y double")


def test_kmeans_reaches_a_fixed_point(spark):
    df = blobs(spark, [(999, 7.0, None, 1.0)])
    out, model = fixed_point_kmeans(df, ["c", "x", "y"], 3, "id")
    assert tuple(kmeans_invariants(df, out, model).first()) == (120, 3, 0, 0)
    rows = out.collect()
    assert {r["id"]: r["cluster"] for r in rows}[999] is None
    assert all(len({r["cluster"] for r in rows if r["id"] // 100 == b and r["id"] != 999}) == 1 for b in range(3))
    assert sorted(model.sizes) == [40, 40, 40] and model.std[0] == 0.0
    again, other = fixed_point_kmeans(df.repartition(5, "x"), ["c", "x", "y"], 3, "id")
    assert other.centers == model.centers


def test_kmeans_with_noise_and_with_few_points(spark):
    rnd = random.Random(4)
    df = spark.createDataFrame([(i, rnd.random(), rnd.random()) for i in range(400)], "id long, x double, y double")
    out, model = fixed_point_kmeans(df, ["x", "y"], 5, "id")
    assert tuple(kmeans_invariants(df, out, model).first()) == (400, 5, 0, 0) and model.steps > 3
    few = spark.createDataFrame([(1, 2.0), (2, 2.0), (3, 5.0)], "id long, x double")
    out, model = fixed_point_kmeans(few, ["x"], 4, "id")
    assert len(model.centers) == 2 and tuple(kmeans_invariants(few, out, model).first()) == (3, 2, 0, 0)
    with pytest.raises(ValueError):
        fixed_point_kmeans(few.limit(0), ["x"], 2, "id")


def test_invariants_notice_what_is_off(spark):
    df = blobs(spark)
    out, model = fixed_point_kmeans(df, ["x", "y"], 3, "id")
    bad = out.withColumn("cluster", F.when(F.col("id") == 0, (F.col("cluster") + 1) % 3).otherwise(F.col("cluster")))
    assert tuple(kmeans_invariants(df, bad, model).first())[2:] == (1, 2)


def brute_split(rows):
    values = sorted({v for v, _ in rows})
    best = None
    for a, b in zip(values, values[1:], strict=False):
        t = (a + b) / 2
        score = 0.0
        for side in ([y for v, y in rows if v <= t], [y for v, y in rows if v > t]):
            score += sum((side.count(c) ** 2) for c in (0, 1)) / len(side)
        if best is None or score > best[0] + 1e-12:
            best = score, t
    return best and best[1]


def test_split_equals_brute_force_and_the_librarys_stump(spark):
    rng = random.Random(2)
    for seed in range(3):
        rows = [(float(v), int(rng.random() < 0.2 + 0.6 * (v > 10 + seed))) for v in
                (rng.randrange(25) for _ in range(500))]
        df = spark.createDataFrame(rows, "v double, y int")
        got = best_split(df, "v", "y").first()
        assert got["threshold"] == brute_split(rows)
        assert got["n_left"] == sum(v <= got["threshold"] for v, _ in rows)
        assert got["left_1"] == sum(y for v, y in rows if v <= got["threshold"])
        data = VectorAssembler(inputCols=["v"], outputCol="features").transform(df)
        tree = DecisionTreeClassifier(labelCol="y", maxDepth=1, maxBins=64).fit(data)
        text = tree.toDebugString
        assert float(text.split("feature 0 <= ")[1].split(")")[0]) == got["threshold"]


def test_split_cases(spark):
    ddl = "v double, y int"
    assert best_split(spark.createDataFrame([], ddl), "v", "y").count() == 0
    assert best_split(spark.createDataFrame([(1.0, 0), (1.0, 1)], ddl), "v", "y").count() == 0
    rows = [(1.0, 0), (2.0, 1), (None, 1), (3.0, None), (3.0, 7)]
    assert tuple(best_split(spark.createDataFrame(rows, ddl), "v", "y").first()) == (1.5, 1, 1, 1, 0, 0.5)
    tie = [(1.0, 0), (2.0, 1), (3.0, 0)]
    assert best_split(spark.createDataFrame(tie, ddl), "v", "y").first()["threshold"] == 1.5


def test_long_tail_needs_two_passes(spark, monkeypatch):
    df = spark.range(60_000).select(F.exp(F.randn(3) * 6).alias("v")).persist()
    values = sorted(r[0] for r in df.collect())
    passes = []
    real = Q._pass
    monkeypatch.setattr(Q, "_pass", lambda *a: passes.append(1) or real(*a))
    for q in (0.0, 0.01, 0.5, 0.999, 1.0):
        passes.clear()
        assert Q.quantile_disc(df, "v", q, small=2_000) == values[max(1, math.ceil(q * len(values))) - 1]
        assert len(passes) <= 2
    df.unpersist()


def test_rank_error_of_the_sketch(spark):
    df = spark.range(20_000).select((F.col("id") % 1000).cast("double").alias("v"))
    value = Q.approx_quantile(df, "v", 0.5, 0.01)
    assert Q.rank_error(df, "v", 0.5, value) <= 0.01
    assert Q.rank_error(df, "v", 0.5, 900.0) == pytest.approx(0.4, abs=0.001)
    assert Q.rank_error(df.limit(0), "v", 0.5, 1.0) is None
