"""Nearest neighbours by query-aware collision counting (Euclidean distance).

Every vector is projected on ``m`` random lines, and each projection is kept
as a sorted array.  A query's own projections are the centres of windows of
width ``w * R``; a vector that falls into enough of the query's windows (the
collision threshold) is verified by its exact distance.  ``R`` grows round by
round (virtual rehashing: the windows widen, nothing is hashed again, and only
the newly covered parts of the arrays are counted) until ``k`` verified
vectors lie within ``R`` or the windows cover everything.

The index is dealt into blocks of about ``rows_per_block`` vectors, every
vector in one block, the queries to every block; a task keeps one block's
arrays and streams the queries by.  Blocks return their ``k`` best, which
Spark merges per query, so nothing else travels and no group is unbounded.

Threshold: a vector within ``R`` collides with probability ``p1`` per line,
so that its count is about normal; ``slack`` standard deviations below the
mean keep it with probability 0.97 at distance ``R`` and more when nearer.
There is no cap on candidates: all vectors over the threshold are verified.

Defined cases: vectors that are null, empty, all zero, or that hold null or
non-finite components take no part, as query or candidate; vectors are compared
with those of equal length; null ids take no part; a query's own row (its id) is no candidate;
rows that repeat an id are candidates each; ties go to the smaller id; with
fewer than ``k`` candidates all are returned; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import bound_batches, col, materialize

RATIO = 1.2  # growth of R from round to round


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall(vector, lambda x: x == 0)
    return F.coalesce((F.size(vector) > 0) & ~bad & ~zero, F.lit(False))


class Block:
    """Sorted projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lines: np.ndarray):
        self.ids, self.vectors = ids, vectors
        projected = vectors @ lines
        self.order = np.argsort(projected, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.take_along_axis(projected.T, self.order, 1)
        self.order = np.ascontiguousarray(self.order)

    def nearest(
        self, query: int, vector: np.ndarray, at: np.ndarray, k: int, start: float, width: float,
        least: int,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the ``k`` nearest that collide often enough."""
        n = len(self.ids)
        # Where every round's windows begin and end, line by line.  The last
        # round's windows reach every value.
        reach = max(np.abs(self.values[:, 0] - at).max(), np.abs(self.values[:, -1] - at).max())
        rounds = max(1, math.ceil(math.log(max(2 * reach / (width * start), 1), RATIO)) + 1)
        radii = start * RATIO ** np.arange(rounds)
        half = radii * width / 2
        lo, hi = (
            np.array([np.searchsorted(v, x + sign * half, side) for v, x in zip(self.values, at, strict=True)])
            for sign, side in ((-1, "left"), (1, "right"))
        )
        counts = np.zeros(n, np.int32)
        done = self.ids == query
        found, dist = [], []
        for r, radius in enumerate(radii):
            if r == 0:
                parts = [o[a:b] for o, a, b in zip(self.order, lo[:, 0], hi[:, 0], strict=True)]
            else:
                left = zip(self.order, lo[:, r].tolist(), lo[:, r - 1].tolist(), strict=True)
                right = zip(self.order, hi[:, r - 1].tolist(), hi[:, r].tolist(), strict=True)
                parts = [o[a:b] for side in (left, right) for o, a, b in side if b > a]
            if parts:
                counts += np.bincount(np.concatenate(parts), minlength=n).astype(np.int32)
            new = np.flatnonzero((counts >= least) & ~done)
            if len(new):
                done[new] = True
                found.append(new)
                dist.append(np.sqrt(((self.vectors[new] - vector) ** 2).sum(axis=1)))
            if sum(int((x <= radius).sum()) for x in dist) >= k:
                break
        if not found:
            return np.zeros(0, np.int64), np.zeros(0)
        ids, d = self.ids[np.concatenate(found)], np.concatenate(dist)
        best = np.lexsort((ids, d))[:k]
        return ids[best], d[best]


def collision_knn(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    lines: int = 96,
    width: float = 2.2,
    slack: float = 2.0,
    rows_per_block: int = 8192,
    seed: int = 7,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows of
    ``vectors`` for each row of ``queries``; both have the same two columns."""
    parts = lambda df: df.select(
        col(id_col).cast("long").alias("id"), col(vector_col).cast("array<double>").alias("v")
    ).filter(F.col("id").isNotNull() & usable(F.col("v")))
    data, asked = parts(vectors), parts(queries)
    n = data.count()
    schema = "query_id long, vec_id long, score double"
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks = -(-n // rows_per_block)
    p1 = math.erf(width / 2 / math.sqrt(2))
    least = max(1, math.floor(lines * p1 - slack * math.sqrt(lines * p1 * (1 - p1))))

    # Block rows come first in a partition, then the queries stream by.
    rows = data.select(
        F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("block"),
        F.size("v").alias("d"), F.lit(0).alias("kind"), "id", "v",
    ).unionByName(
        asked.select(
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
            F.size("v").alias("d"), F.lit(1).alias("kind"), "id", "v",
        )
    )
    rows = rows.repartition(blocks, "block").sortWithinPartitions("block", "d", "kind", "id")
    bound_batches(rows)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, vecs, block = None, [], [], None  # of one block and vector length
        for batch in batches:
            if not batch.num_rows:
                continue
            which, size, kind, key = (np.asarray(batch.column(i)) for i in (0, 1, 2, 3))
            values, places = np.asarray(batch.column(4).values), np.asarray(batch.column(4).offsets)
            out: list[list[np.ndarray]] = [[], [], []]
            differ = (which[1:] != which[:-1]) | (size[1:] != size[:-1]) | (kind[1:] != kind[:-1])
            cut = np.flatnonzero(np.append(True, differ))
            for a, b in zip(cut, np.append(cut[1:], len(which)), strict=True):
                d = int(size[a])
                if (which[a], d) != current:
                    current, ids, vecs, block = (which[a], d), [], [], None
                flat = values[places[a] : places[b]].reshape(-1, d)
                if kind[a] == 0:
                    ids.append(key[a:b])
                    vecs.append(flat)
                    continue
                if block is None:
                    if not ids:
                        continue
                    directions = np.random.default_rng(seed).standard_normal((d, lines))
                    start = math.sqrt((np.concatenate(vecs) ** 2).sum(axis=1).mean()) / 64
                    block = Block(np.concatenate(ids), np.concatenate(vecs), directions)
                    ids, vecs = [0], []
                at = flat @ directions
                for i in range(b - a):
                    got, dist = block.nearest(
                        int(key[a + i]), flat[i], at[i], k, start, width, least
                    )
                    for x, y in zip(out, (np.full(len(got), key[a + i]), got, dist), strict=True):
                        x.append(y)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in out], ["query_id", "vec_id", "score"]
                )

    best = materialize(rows.mapInArrow(search, schema), "neighbours")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return (
        best.withColumn("rank", place.cast("int")).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
