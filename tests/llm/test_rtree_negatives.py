from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm.rtree_negatives import RTree, hard_negatives

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, anchors, positives=5, negatives=3, low=50, high=95, scale=256):
    def usable(r):
        return None not in r and all(x is not None and math.isfinite(x) for x in r[2])

    whole = lambda r: (r[0], r[1], [math.floor(scale * x) for x in r[2]])
    rows = [whole(r) for r in rows if usable(r)]
    asked = {(a[0], a[1], tuple(a[2])) for a in map(whole, filter(usable, anchors))}
    out = []
    for i, label, v in asked:
        scores = [
            (-sum(x * y for x, y in zip(v, w, strict=True)), j, other == label)
            for j, other, w in rows if j != i and len(w) == len(v)
        ]
        best = sorted((s, j) for s, j, same in scores if same)[:positives]
        for s, j in best:
            fit = sorted((t, n) for t, n, same in scores if not same and low * -s <= 100 * -t <= high * -s)
            out += [(i, j, k + 1, n, -s, -t) for k, (t, n) in enumerate(fit[:negatives])]
    return sorted(out)


def result(df):
    return sorted(
        (r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)
        for r in df.collect()
    )


def test_tree_holds_every_row_in_its_boxes():
    rng = np.random.default_rng(1)
    for n in (1, 5, 300, 2000):
        labels = rng.integers(0, 7, n)
        v = rng.integers(-50, 50, (n, 6)).astype(float)
        t = RTree(np.arange(n), labels, v, leaf=16)
        assert sorted(t.ids.tolist()) == list(range(n))
        covered = np.zeros(n, int)
        for x in range(t.leaves):
            covered[t.start[x] : t.end[x]] += 1
        assert (covered == 1).all() and max(np.diff([*t.start[: t.leaves], n])) <= 16
        anchors = rng.integers(-50, 50, (4, 6)).astype(float)
        least, top = t.intervals(anchors)

        def rows(x):
            if x < t.leaves:
                return range(t.start[x], t.end[x])
            return [i for y in range(t.start[x], t.end[x]) for i in rows(y)]

        for x in range(t.root + 1):
            score = t.vectors[list(rows(x))] @ anchors.T
            assert (score <= top[:, x]).all() and (score >= least[:, x]).all()
            assert t.first[x] == min(t.ids[list(rows(x))])
        assert len(list(rows(t.root))) == n


@pytest.mark.parametrize("block", [40, 10_000])
def test_equals_brute_force(spark, block):
    rng = np.random.default_rng(4)
    rows = [(i, int(rng.integers(0, 4)), rng.normal(0, 0.1, 8).tolist()) for i in range(400)]
    rows += [(1000 + i, i % 3, [0.25] * 8) for i in range(60)]  # equal vectors
    rows += [(2000 + i, 9, [0.5 * i, 0.1] + [0.0] * 6) for i in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    anchors = df.filter("vec_id % 20 = 0")
    want = brute(rows, [r for r in rows if r[0] % 20 == 0])
    assert want
    assert result(hard_negatives(df, anchors, rows_per_block=block, leaf=8)) == want
    assert result(hard_negatives(df, anchors, positives=2, negatives=7, low=10, high=100, leaf=4)) == brute(
        rows, [r for r in rows if r[0] % 20 == 0], 2, 7, 10, 100
    )


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (0, 2, [0.9, 0.5]), (1, 1, [1.0, 0.5]), (2, 1, [0.5, 0.5]),
        (3, 2, [0.7, 0.4]), (3, 2, [0.7, 0.4]), (4, 2, [0.6, 0.2]), (None, 2, [0.7, 0.4]),
        (5, None, [0.7, 0.4]), (6, 2, None), (7, 2, [0.7, None]), (8, 2, [nan, 0.4]), (9, 2, [inf, 0.4]),
        (10, 2, [0.7]), (11, 2, [0.7, 0.4, 0.1]), (12, 1, [1.0]), (13, 1, []), (14, 2, []), (15, 1, []),
        (16, 1, [0.0, 0.0]), (17, 3, [1e12, 1e12]), (18, 3, [2e12, 1e12]), (19, 2, [1.5e12, 1e12]),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("block", F.lit(1)).withColumn("key", F.lit(2))
    got = result(hard_negatives(df, df, leaf=2))
    want = brute(rows, rows)
    clip = lambda x: max(-(2**63), min(2**63 - 1, x))
    plain = lambda out: [r for r in out if r[0] < 17]
    assert plain(got) == plain(want)
    # Scores beyond a long are cut to its range (and their windows with them).
    assert {(r[0], r[1], r[4]) for r in got} >= {(17, 18, clip(2**80))} or not [r for r in got if r[0] == 17]
    assert hard_negatives(df.limit(0), df.limit(0)).count() == 0
    assert hard_negatives(df, df.limit(0)).count() == 0


def test_query_equals_its_sql(spark):
    import duckdb

    from sparkmart.llm.queries import ORACLE, QUERIES

    for sf in ("sf0.001", "sf0.1"):
        folder = f"/root/testdata/{sf}"
        got = result(QUERIES["op12_rtree_hard_negatives"](spark, folder))
        con = duckdb.connect()
        con.sql(f"CREATE VIEW embeddings AS FROM '{folder}/embeddings.parquet'")
        assert got == sorted(con.sql(ORACLE["op12_rtree_hard_negatives"]).fetchall()) and got
