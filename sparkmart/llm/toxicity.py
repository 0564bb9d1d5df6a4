"""Toxicity by non-negative positive-unlabelled (nnPU) learning.

The learner sees confirmed toxic texts and unlabelled texts, never confirmed
clean ones.  With class prior ``p``, risk ``R(label)`` over a set, the
estimator is ``p R_pos(+) + max(0, R_unl(-) - p R_pos(-))``: the part of the
unlabelled risk that the hidden positives explain is taken off, and when the
rest falls below zero (over-fitting) the step goes back up instead.

Features are presences of words and of word prefixes, as 64-bit hashes over
whole texts.  Spark counts in how many positive and unlabelled texts each
feature appears; features that are significantly more frequent among the
positives are kept, and a numpy logistic model is fitted on them.

Bounds (documented parameters): at most ``max_positive`` positive and about
``max_unlabelled`` unlabelled texts are learnt from, chosen by hash of the
id, and at most ``max_features`` features are kept.  Scoring covers every row
and whole texts.

Defined cases: null and empty texts score like a text without any feature; a
document labelled both toxic and clean is not a confirmed example; null ids
and null labels are never examples; without positive examples every score is
the prior (0); repeated rows score alike; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import _PUNCT, GROUP_BYTES, Words, bound_batches, col, free_name, text_blocks

PREFIXES = (0, 4, 5, 6)  # 0: the whole word
_U = np.uint64


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id's text mod 3 is 1."""
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def feature_blocks(texts: Sequence[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(text number, feature)`` arrays covering the texts, in blocks; a
    feature may come up several times."""
    i, n = 0, len(texts)
    while i < n:
        j, size = i, 0
        while j < n and (j == i or size + len(texts[j] or b"") <= GROUP_BYTES):
            size += len(texts[j] or b"")
            j += 1
        if size > GROUP_BYTES:
            parts = ((data, np.array([0]), np.array([i]), np.array([len(data)]))
                     for data in text_blocks(texts[i], _PUNCT))
        elif size:
            lengths = np.array([len(t or b"") for t in texts[i:j]])
            full = np.flatnonzero(lengths)
            ends = np.cumsum(lengths)[full]
            data = np.frombuffer(b"".join(t or b"" for t in texts[i:j]), np.uint8)
            parts = iter([(data, ends - lengths[full], i + full, ends)])
        else:
            parts = iter(())
        for data, first, rows, ends in parts:
            words = Words(data, first, _PUNCT)
            owner = rows[np.searchsorted(ends, words.s, "right")]
            for k in PREFIXES:
                h = words.hashes(k)
                with np.errstate(over="ignore"):
                    h = h ^ _U((k * 0x9E3779B97F4A7C15) & (2**64 - 1))
                if k:
                    long = words.e - words.s > k
                    yield owner[long], h[long]
                else:
                    yield owner, h
        i = j


@dataclass
class Model:
    """A fitted classifier: sorted feature hashes, their weights, the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.flag = np.zeros(1 << 20, bool)
        self.flag[(self.features & _U((1 << 20) - 1)).astype(np.int64)] = True

    def present(self, texts: Sequence[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """``(text number, feature number)``, each pair once."""
        pairs = []
        for owner, h in feature_blocks(texts):
            maybe = np.flatnonzero(self.flag[(h & _U((1 << 20) - 1)).astype(np.int64)])
            at = np.searchsorted(self.features, h[maybe])
            at = np.minimum(at, len(self.features) - 1)
            hit = self.features[at] == h[maybe] if len(self.features) else np.zeros(0, bool)
            if hit.any():
                pairs.append(owner[maybe[hit]] * len(self.features) + at[hit])
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = np.unique(np.concatenate(pairs))
        return both // len(self.features), both % len(self.features)

    def scores(self, texts: Sequence[bytes | None]) -> np.ndarray:
        row, feature = self.present(texts) if len(self.features) else (np.zeros(0, int),) * 2
        z = self.bias + np.bincount(row, self.weights[feature], len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_nnpu(
    pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = 800, rate: float = 0.05,
    l2: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model from 0/1 matrices of positive and
    unlabelled rows, by Adam on the whole sample (deterministic)."""
    d = pos.shape[1]
    x = np.zeros(d + 1)
    x[d] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    m, v = np.zeros(d + 1), np.zeros(d + 1)
    for t in range(1, steps + 1):
        sp = 1 / (1 + np.exp(-np.clip(pos @ x[:d] + x[d], -40, 40)))
        su = 1 / (1 + np.exp(-np.clip(unl @ x[:d] + x[d], -40, 40)))
        # Logistic loss: of label + it is -log s, of label - it is -log(1 - s).
        rest = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean()
        rest += prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
        gp, gu = (sp - 1) / len(sp), su / len(su)  # of R_pos(+) and R_unl(-)
        gn = sp / len(sp)  # of R_pos(-)
        up = lambda a, b: np.append(a @ pos + b @ unl, a.sum() + b.sum())
        grad = up(prior * gp - prior * gn, gu) if rest >= 0 else up(prior * gn, -gu)
        grad[:d] += l2 * x[:d]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        x -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return x[:d], float(x[d])


def _texts(batch: pa.RecordBatch, at: int) -> list[bytes | None]:
    return batch.column(at).cast(pa.large_binary()).to_pylist()


def _smallest(rows: DataFrame, n: int) -> Column | None:
    """True for the rows with the ``n`` smallest ``(h, t)`` (an exact sample by
    hash, of any table size; repeated rows share theirs); None without rows."""
    key = F.struct("h", "t")
    cut = rows.select(key.alias("key")).orderBy("key").limit(n).agg(F.max("key").alias("m")).first()["m"]
    if cut is None:
        return None
    # A NULL text's hash sorts first.
    upto = F.col("t").isNull() if cut["t"] is None else F.coalesce(F.col("t") <= cut["t"], F.lit(True))
    return (F.col("h") < cut["h"]) | ((F.col("h") == cut["h"]) & upto)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    class_prior: float | None = None,
    max_positive: int = 3000,
    max_unlabelled: int = 9000,
    max_features: int = 1500,
) -> Model:
    """Fit on rows that are not held out.  ``class_prior`` is by default the
    toxic share of the labelled rows that may be learnt from."""
    bound_batches(docs)
    known = (
        labels.select(col(id_col).alias("id"), col(label_col).alias("y"))
        .filter(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.min("y").alias("y"))
    )
    n_known, n_toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("y") == 1).cast("long")), F.lit(0))).first()
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), -40.0)
    if not n_toxic:
        return nothing
    prior = class_prior if class_prior is not None else n_toxic / n_known
    prior = min(max(prior, 1e-4), 0.999)
    ids = (
        known.filter("y = 1").orderBy(F.xxhash64("id"), "id").limit(max_positive)
        .select("id", F.lit(1).alias("positive"))
    )
    rows = docs.select(
        col(id_col).alias("id"), col(text_col).alias("text"),
        F.xxhash64(F.lit("unlabelled"), col(id_col)).alias("h"), F.xxhash64(col(text_col)).alias("t"),
    ).filter(F.col("id").isNotNull() & ~held_out(F.col("id")))
    rows = rows.join(F.broadcast(ids), "id", "left").withColumn("positive", F.coalesce("positive", F.lit(0)))
    some = _smallest(rows, max_unlabelled)
    positives = _smallest(rows.filter("positive = 1"), max_positive)
    if some is None or positives is None:
        return nothing
    sample = (
        rows.withColumn("unlabelled", some.cast("int"))
        .withColumn("positive", F.when(positives, F.col("positive")).otherwise(0))
        .filter((F.col("positive") == 1) | (F.col("unlabelled") == 1))
        # Rows that repeat an id and its text count once.
        .groupBy("id", "t").agg(
            F.first("text").alias("text"), F.max("positive").alias("positive"),
            F.max("unlabelled").alias("unlabelled"),
        )
        .select("text", "positive", "unlabelled")
    )

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch, 0)
            flags = [np.asarray(batch.column(i).to_pylist(), np.int64) for i in (1, 2)]
            step = 256  # texts counted at a time
            for i in range(0, len(texts), step):
                parts = list(feature_blocks(texts[i : i + step]))
                if not parts:
                    continue
                owner = np.concatenate([p[0] for p in parts])
                h = np.concatenate([p[1] for p in parts])
                order = np.lexsort((owner, h))
                owner, h = owner[order], h[order]
                once = np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))
                owner, h = owner[once] + i, h[once]
                values, start = np.unique(h, return_index=True)
                sums = [np.add.reduceat(f[owner], start) for f in flags]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), *map(pa.array, sums)], ["f", "p", "u"]
                )

    n_pos, n_unl = sample.agg(F.sum("positive"), F.sum("unlabelled")).first()
    if not n_pos or not n_unl:
        return nothing
    counts = sample.mapInArrow(tally, "f long, p long, u long").groupBy("f").agg(
        F.sum("p").alias("p"), F.sum("u").alias("u")
    )
    a, b = F.col("p") / F.lit(float(n_pos)), (F.col("u") + 1) / F.lit(float(n_unl + 1))
    lift = (a - b) / F.sqrt(b / F.lit(float(n_pos)) + b / F.lit(float(n_unl)))
    top = (
        counts.withColumn("z", lift)
        .filter((F.col("p") >= 3) & (F.col("z") >= 5) & (a >= 1.5 * b))
        .orderBy(F.desc("z"), "f").limit(max_features).select("f").collect()
    )
    features = np.sort(np.array([r.f for r in top], np.int64).view(np.uint64))
    if not len(features):
        return nothing
    blank = Model(features, np.zeros(len(features)), 0.0)

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch, 0)
            row, feature = blank.present(texts)
            cuts = np.searchsorted(row, np.arange(len(texts) + 1))
            found = [feature[x:y].tolist() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.int32()))],
                ["positive", "unlabelled", "x"],
            )

    got = sample.mapInArrow(presence, "positive int, unlabelled int, x array<int>").collect()
    got.sort(key=lambda r: (r.positive, r.unlabelled, r.x))  # independent of partitioning

    def matrix(rows) -> np.ndarray:
        out = np.zeros((len(rows), len(features)), np.float32)
        for i, r in enumerate(rows):
            out[i, r.x] = 1
        return out

    weights, bias = fit_nnpu(
        matrix([r for r in got if r.positive]), matrix([r for r in got if r.unlabelled]), prior
    )
    return Model(features, weights, bias)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the model's score of each whole text (0 to 1)."""

    bound_batches(docs)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores([None if t is None else t.encode() for t in texts]))

    return docs.withColumn(out, scored(col(text_col)))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    name = free_name(docs, "__score")
    model = train(docs, labels, **options)
    text = options.get("text_col", "text")
    return score(docs, model, text, name).filter(F.col(name) < threshold).drop(name)
