from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import toxicity as X


@pytest.fixture(scope="module")
def corpus(make_docs, spark):
    rng = random.Random(2)
    vocab = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(800)]
    rows, labels = [], []
    for i in range(3000):
        bad = i % 8 == 0
        words = rng.choices(vocab, k=rng.randrange(20, 120))
        if bad:
            for _ in range(rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(["Scoundrel", "nitwit!", "rotter"]))
        rows.append((i, " ".join(words), "s"))
        if i % 2 == 0:
            labels.append((i, int(bad)))
    labels += [(None, 1), (0, 0), (6, None)]
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_rule(spark):
    got = spark.range(200).select("id", X.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)


def test_accuracy_on_rows_whose_labels_were_not_seen(make_docs, corpus, awkward):
    rows, labels = corpus
    docs = make_docs(rows + [(10_000 + (i or 0), t, s) for i, t, s in awkward], extra=("score_",))
    model = X.train(docs, labels)
    got = {r.doc_id: r.score for r in X.score(docs, model).collect()}
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    wrong = [i for i in held if (got[i] >= 0.7) != (i % 8 == 0)]
    assert len(wrong) <= 0.02 * len(held)
    assert all(0 <= s <= 1 for s in got.values())
    assert got[10_003] == got[10_002] < 0.7  # null and empty
    kept = {r.doc_id for r in X.drop_toxic(docs, labels).collect()}
    assert kept == {i for i, s in got.items() if s < 0.7}


def test_labels_of_held_out_rows_do_not_matter(make_docs, corpus):
    rows, labels = corpus
    flipped = labels.withColumn(
        "toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    a, b = X.train(make_docs(rows), labels), X.train(make_docs(rows), flipped)
    assert np.array_equal(a.features, b.features) and np.allclose(a.weights, b.weights)


def test_no_positive_examples_and_empty_tables(spark, make_docs, corpus):
    rows, _ = corpus
    none = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    docs = make_docs(rows[:20])
    assert X.drop_toxic(docs, none).count() == 20
    assert X.drop_toxic(make_docs([]), none).count() == 0


def test_long_text_is_read_whole():
    long = ("lorem ipsum " * 200_000 + "nitwit").encode()
    feats = np.sort(np.unique(np.concatenate([h for _, h in X.feature_blocks([b"nitwit"])])))
    model = X.Model(feats, np.ones(len(feats)), -1.0)
    s = model.scores([long, b"lorem ipsum", None, b""])
    assert s[0] > s[1] == s[2] == s[3]


def test_nnpu_separates_from_unlabelled_mixtures():
    rng = np.random.default_rng(0)
    pos = (rng.random((400, 3)) < [0.9, 0.5, 0.5]).astype(float)
    unl = np.vstack([
        (rng.random((300, 3)) < [0.9, 0.5, 0.5]), (rng.random((2700, 3)) < [0.02, 0.5, 0.5])
    ]).astype(float)
    w, b = X.fit_nnpu(pos, unl, 0.1)
    assert w[0] > 5 * max(abs(w[1]), abs(w[2])) and b < -1


def test_sample_is_the_smallest_hashes_at_any_table_size(spark):
    rows = spark.range(5000).select(
        F.xxhash64(F.lit("unlabelled"), "id").alias("h"), F.when(F.col("id") > 0, F.xxhash64("id")).alias("t")
    )
    want = sorted((r.h, r.t) for r in rows.collect())[:70]
    got = sorted((r.h, r.t) for r in rows.filter(X._smallest(rows, 70)).collect())
    assert got == want
    # Nothing is scaled by a row count: a huge table gives as many rows.
    many = rows.unionByName(rows).unionByName(rows)
    assert many.filter(X._smallest(many, 70)).count() in range(70, 73)
    assert X._smallest(rows.limit(0), 70) is None
    nulls = rows.limit(3).select(F.lit(1).cast("long").alias("h"), F.lit(None).cast("long").alias("t"))
    assert nulls.filter(X._smallest(nulls, 2)).count() == 3


def test_scorer_equals_plain_python(make_docs, corpus):
    rows, labels = corpus
    model = X.train(make_docs(rows), labels)
    texts = [t.encode() for _, t, _ in rows[:40]] + [b"", None]
    place = {int(f): i for i, f in enumerate(model.features)}
    for text, got in zip(texts, model.scores(texts), strict=True):
        found = {int(h) for _, hs in X.feature_blocks([text]) for h in hs}
        z = model.bias + sum(float(model.weights[place[h]]) for h in found if h in place)
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-9
