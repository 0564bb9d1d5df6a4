from __future__ import annotations

import math
import random

import numpy as np

from sparkmart.llm.collision_ann import collision_knn

SCHEMA = "vec_id long, embedding array<float>, rank string, block string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)


def brute(rows, asked, k):
    out = {}
    for q, v in asked:
        d = sorted(
            (math.sqrt(sum((float(a) - float(b)) ** 2 for a, b in zip(v, w))), i)
            for i, w in rows if i != q
        )
        out[q] = d[:k]
    return out


def f32(rows):
    return [(i, [float(np.float32(x)) for x in v]) for i, v in rows]


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 32))
    rows = f32([
        (i, (centres[i % 20] + 0.5 * rng.standard_normal(32)).tolist()) if i % 3
        else (i, rng.standard_normal(32).tolist())
        for i in range(3000)
    ])
    asked = [r for r in rows if r[0] % 50 == 0]
    got = {}
    for r in collision_knn(frame(spark, rows), frame(spark, asked), k=10, rows_per_block=700).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.score, r.vec_id)
    want = brute(rows, asked, 10)
    hits = 0
    for q, near in want.items():
        assert sorted(got[q]) == list(range(1, 11))
        assert [got[q][i] for i in range(1, 11)] == sorted(got[q].values())
        hits += len({i for _, i in near} & {i for _, i in got[q].values()})
        exact = dict((i, d) for d, i in brute(rows, [(q, dict(rows)[q])], 3000)[q])
        for d, i in got[q].values():
            assert math.isclose(d, exact[i], rel_tol=1e-12)
    assert hits >= 0.9 * 10 * len(want)


def test_awkward_vectors_ties_and_few_rows(spark):
    rows = [
        (0, [1.0, 0.0]), (5, [1.0, 0.0]), (3, [1.0, 0.0]), (9, [0.0, 2.0]), (7, [3.0, 4.0]),
        (7, [3.0, 4.0]), (20, None), (21, []), (22, [0.0, 0.0]), (23, [float("nan"), 1.0]),
        (24, [float("inf"), 1.0]), (25, [None, 1.0]), (26, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]),
    ]
    df = frame(spark, rows)
    got = collision_knn(df, df, k=10).collect()
    good = [(i, v) for i, v in rows if i in (0, 3, 5, 7, 9)]
    want = brute(good, dict(good).items(), 10)
    for q, near in want.items():
        mine = sorted((r["rank"], r.score, r.vec_id) for r in got if r.query_id == q)
        if q == 7:  # two rows with one id: a query each
            continue
        assert [(round(d, 9), i) for _, d, i in mine] == [(round(d, 9), i) for d, i in near]
    assert {r.query_id for r in got} == {0, 3, 5, 7, 9}
    assert collision_knn(df.limit(0), df, k=3).count() == 0
    assert collision_knn(df, df.limit(0), k=3).count() == 0


def test_many_equal_vectors_tie_by_id(spark):
    rng = random.Random(4)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(500)]
    rows += f32([(1000 + i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(500)])
    df = frame(spark, rows)
    got = collision_knn(df, df.filter("vec_id = 100"), k=10, rows_per_block=128).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, 0.0) for i in range(10)]


def test_lengths_are_searched_apart(spark):
    from sparkmart.llm.collision_ann import collision_knn

    rows = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 0.1, 0.0]), (2, [0.0, 1.0, 0.0]),
            (3, [1.0, 0.0]), (4, [0.5, 0.5]), (5, [0.0, 1.0]), (6, [7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collision_knn(df, df, k=2)
    near = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got.collect())
    assert near == [(0, 1, 1), (0, 2, 2), (1, 1, 0), (1, 2, 2), (2, 1, 1), (2, 2, 0),
                    (3, 1, 4), (3, 2, 5), (4, 1, 3), (4, 2, 5), (5, 1, 4), (5, 2, 3)]
