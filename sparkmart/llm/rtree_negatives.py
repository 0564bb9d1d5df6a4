"""Hard negatives by inner product, searched in STR-packed R-trees.

An anchor's *positives* are the best other rows of its label.  Its *hard
negatives* for one positive are the best rows of other labels whose score lies
in a window below the positive's: at least ``low`` and at most ``high`` percent
of it.  A score is the integer inner product of the quantised vectors
(``floor(scale * x)``).

Vectors are dealt into blocks of about ``rows_per_block`` by a hash (every row
in one block, equal vectors spread), anchors to every block.  A block is packed
as an R-tree by sort-tile-recursion: rows sorted by label, each label's rows
tiled along the coordinates of greatest variance, leaves of ``leaf`` rows,
``FANOUT`` nodes under each upper one.  A node keeps its minimum bounding box,
its smallest id and its labels' range.  For an anchor ``a`` the box gives an
interval of each coordinate's product and so of the score::

    max = sum(max(a_i * low_i, a_i * high_i)),  min = sum(min(...))

A best-first queue takes the node with the largest possible score next, until
it is strictly below the k-th found; a node that could only tie with the k-th is
skipped when all its ids are larger.  The search for negatives keeps the
windows of all the anchor's positives at once and drops a node when no window
meets its interval, or only strictly below that window's k-th.  All arithmetic
is exact, so results are those of a full comparison.

Blocks return their best, which Spark merges per anchor.

Defined cases: rows with a null id, label or vector, or with a null or
non-finite component take no part; only vectors of equal length are compared
(one without components scores 0); other rows are rows of another id; rows
that repeat an id are candidates each, anchors that repeat in id, label and
vector are one anchor; ties go to the smaller id; negative positive scores have
an empty window; scores beyond a long are cut to its range; an empty table
gives no rows.
"""

from __future__ import annotations

import heapq
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sparkmart.llm.common import bound_batches, col, materialize

FANOUT = 8
LONG = 2**63 - 1
EXACT = 2**53  # integers up to this size are exact as doubles


class RTree:
    """A block's rows (``vectors``: integers as doubles, or as Python numbers
    where a score could pass :data:`EXACT`), packed."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf: int = 128):
        order, cuts = self._pack(ids, labels, vectors, leaf)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        starts, ends = cuts[:-1], cuts[1:]
        over = lambda f, a, s: f.reduceat(a, s, axis=0)
        box = [
            over(np.minimum, self.vectors, starts), over(np.maximum, self.vectors, starts),
            over(np.minimum, self.ids, starts),
            over(np.minimum, self.labels, starts), over(np.maximum, self.labels, starts),
        ]
        levels, spans, base = [box], [(starts, ends)], len(starts)
        self.leaves = base
        while len(box[0]) > 1:
            at = np.arange(0, len(box[0]), FANOUT)
            offset = base - len(box[0])
            spans.append((at + offset, np.minimum(at + FANOUT, len(box[0])) + offset))
            f = (np.minimum, np.maximum, np.minimum, np.minimum, np.maximum)
            box = [over(g, a, at) for g, a in zip(f, box, strict=True)]
            levels.append(box)
            base += len(at)
        low, high, first, least, most = (np.concatenate(x) for x in zip(*levels, strict=True))
        self.low, self.high = low, high
        self.first, self.least, self.most = first.tolist(), least.tolist(), most.tolist()
        self.start, self.end = (np.concatenate(x).tolist() for x in zip(*spans, strict=True))
        self.root = base - 1

    @staticmethod
    def _pack(ids, labels, vectors, leaf) -> tuple[np.ndarray, np.ndarray]:
        """Row order and leaf bounds: labels first, then tiles."""
        order = np.lexsort((ids, labels))
        sizes = np.unique(labels, return_counts=True)[1].tolist()
        slabs, at, held = [], 0, 0
        for n in sizes:  # small labels share a slab, others have their own
            if n >= leaf and held:
                slabs.append((at, at + held))
                at, held = at + held, 0
            held += n
            if held >= leaf:
                slabs.append((at, at + held))
                at, held = at + held, 0
        if held:
            slabs.append((at, at + held))
        plain = vectors.astype(float)
        widest = np.argsort(-plain.var(axis=0), kind="stable").tolist() if plain.shape[1] else []
        cuts = [0]

        def tile(a: int, b: int, depth: int) -> None:
            leaves = -(-(b - a) // leaf)
            if leaves <= 1 or depth >= len(widest):
                cuts.extend([*range(a + leaf, b, leaf), b])
                return
            part = order[a:b]
            order[a:b] = part[np.lexsort((ids[part], plain[part, widest[depth]]))]
            slabs = int(np.ceil(leaves ** (1 / (len(widest) - depth))))
            size = leaf * -(-leaves // max(2, slabs))
            for x in range(a, b, size):
                tile(x, min(x + size, b), depth + 1)

        for a, b in slabs:
            tile(a, b, 0)
        return order, np.array(cuts)

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score of every anchor with every node."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        low, high = self.low.T, self.high.T
        return up @ low + down @ high, up @ high + down @ low

    def positives(self, anchor, own: int, label: int, top: list, k: int) -> list[tuple]:
        """The best ``k`` ``(-score, id)`` of the label; ``top``: the anchor's
        greatest possible scores."""
        best: list[tuple] = []
        queue = [(-top[self.root], self.first[self.root], self.root)]
        while queue:
            bound, first, node = heapq.heappop(queue)
            if len(best) == k and (bound, first) > best[-1]:
                if bound > best[-1][0]:
                    break  # all others are strictly below too
                continue
            a, b = self.start[node], self.end[node]
            if node >= self.leaves:
                for x in range(a, b):
                    if self.least[x] <= label <= self.most[x]:
                        heapq.heappush(queue, (-top[x], self.first[x], x))
                continue
            score = self.vectors[a:b] @ anchor
            keep = (self.labels[a:b] == label) & (self.ids[a:b] != own)
            if len(best) == k:
                keep &= score >= -best[-1][0]
            at = np.flatnonzero(keep)
            if len(at):
                best += zip((-score[at]).tolist(), self.ids[a:b][at].tolist(), strict=True)
                best.sort()
                del best[k:]
        return best

    def negatives(
        self, anchor, own: int, label: int, windows: list[tuple], least: list, top: list, k: int
    ) -> list[list[tuple]]:
        """For every window ``(low, high)`` the best ``k`` ``(-score, id)`` of
        other labels inside it."""
        best: list[list[tuple]] = [[] for _ in windows]
        floor = [low for low, _ in windows]  # scores below are of no use to the window
        live = [i for i, (low, high) in enumerate(windows) if low <= high]
        if not live:
            return best
        ceiling, ground = max(windows[i][1] for i in live), min(floor[i] for i in live)
        queue = [(-top[self.root], self.root)]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < ground:
                break  # all others are strictly below every window's k-th
            if least[node] > ceiling or not any(
                -bound >= floor[i] and least[node] <= windows[i][1]
                and (len(best[i]) < k or floor[i] < windows[i][1] or self.first[node] < best[i][-1][1])
                for i in live
            ):
                continue
            a, b = self.start[node], self.end[node]
            if node >= self.leaves:
                for x in range(a, b):
                    if not (self.least[x] == label == self.most[x]):
                        heapq.heappush(queue, (-top[x], x))
                continue
            score = self.vectors[a:b] @ anchor
            keep = (score >= ground) & (score <= ceiling)
            keep &= (self.labels[a:b] != label) & (self.ids[a:b] != own)
            at = np.flatnonzero(keep)
            for s, x in zip(score[at].tolist(), self.ids[a:b][at].tolist(), strict=True):
                for i in live:
                    if floor[i] <= s <= windows[i][1]:
                        insort(best[i], (-s, x))
                        if len(best[i]) > k:
                            best[i].pop()
                        if len(best[i]) == k:
                            floor[i] = max(floor[i], -best[i][-1][0])
            if len(at):
                ground = min(floor[i] for i in live)
        return best


def _search(schema: str, visit, leaf: int):
    """A ``mapInArrow`` function: packs the data rows (kind 0) of each block
    and vector length, then calls ``visit(tree, anchors, rows)`` for the
    anchor rows (kind 1) that follow them."""
    out_schema = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, tree = None, [], None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            block, d, kind, ids, labels = (np.asarray(batch.column(i)) for i in range(5))
            vectors = batch.column(5)
            flat, offsets = np.asarray(vectors.values), np.asarray(vectors.offsets)
            change = (block[1:] != block[:-1]) | (d[1:] != d[:-1]) | (kind[1:] != kind[:-1])
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), n]
            for a, b in zip(cuts, cuts[1:], strict=False):
                size = int(d[a])
                if (block[a], size) != current:
                    current, held, tree = (block[a], size), [], None
                v = flat[offsets[a] : offsets[b]].reshape(b - a, size)
                if kind[a] == 0:
                    held.append((ids[a:b], labels[a:b], v))
                    continue
                if tree is None:
                    if not held:
                        continue
                    ids_, labels_, v_ = (np.concatenate(x) for x in zip(*held, strict=True))
                    held = [0]
                    # In Python's integers where doubles would not be exact.
                    peak = max(int(v_.max(initial=0)), -int(v_.min(initial=0)))
                    limit = EXACT // max(1, size * max(1, peak))
                    tree = RTree(ids_, labels_, v_.astype(float if peak < limit else object), leaf)
                for i in range(a, b, 256):
                    j = min(i + 256, b)
                    some = v[i - a : j - a]
                    peak = max(int(some.max(initial=0)), -int(some.min(initial=0)))
                    use = tree
                    if tree.vectors.dtype != object and peak >= limit:
                        use = RTree(ids_, labels_, v_.astype(object), leaf)
                    rows = visit(
                        use, some.astype(use.vectors.dtype), batch.slice(i, j - i), ids[i:j], labels[i:j]
                    )
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(x, f.type)
                                for x, f in zip(zip(*rows, strict=True), out_schema, strict=True)
                            ],
                            schema=out_schema,
                        )

    return run


def _long(x) -> int:
    return max(-LONG - 1, min(LONG, int(x)))


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: float = 256.0,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    rows_per_block: int = 1 << 14,
    leaf: int = 128,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)`` for the rows of ``anchors``, searched among the rows of
    ``vectors``; both have the same three columns."""

    def usable(df: DataFrame) -> DataFrame:
        x = df.select(
            col(id_col).cast("long").alias("id"), col(label_col).cast("long").alias("label"),
            col(vector_col).cast("array<double>").alias("x"),
        ).filter("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
        x = x.filter("forall(x, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('inf'))")
        whole = F.transform("x", lambda c: F.floor(F.lit(float(scale)) * c).cast("long"))
        return x.select("id", "label", whole.alias("v"))

    data = materialize(usable(vectors), "rows")
    asked = materialize(
        usable(anchors).distinct().withColumn("key", F.xxhash64("id", "label", "v")), "anchors"
    )
    blocks = max(1, -(-data.count() // rows_per_block))

    def dealt(asked: DataFrame, extra: list[str]) -> DataFrame:
        """Every block's rows, then the anchors of equal length."""
        each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        none = [F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in extra]
        rows = data.select(
            F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("block"),
            F.size("v").alias("d"), F.lit(0).alias("kind"), "id", "label", "v", *none,
        ).unionByName(
            asked.select(
                each.alias("block"), F.size("v").alias("d"), F.lit(1).alias("kind"), "id", "label", "v",
                *extra,
            )
        )
        bound_batches(rows)
        return rows.repartition(blocks, "block").sortWithinPartitions("block", "d", "kind", "id")

    def find_positives(tree, anchors, batch, ids, labels) -> list[tuple]:
        top = tree.intervals(anchors)[1].tolist()
        keys = batch.column(6).to_pylist()
        return [
            (key, int(own), int(label), x, _long(-s))
            for key, own, label, a, t in zip(keys, ids, labels, anchors, top, strict=True)
            for s, x in tree.positives(a, int(own), int(label), t, positives)
        ]

    schema = "key long, id long, label long, positive_id long, positive_score long"
    found = materialize(
        dealt(asked, ["key"]).mapInArrow(_search(schema, find_positives, leaf), schema), "positives"
    )
    of = Window.partitionBy("key", "id", "label")
    place = F.row_number().over(of.orderBy(F.desc("positive_score"), "positive_id"))
    pairs = found.withColumn("n", place).filter(F.col("n") <= positives)
    pairs = materialize(pairs.select("key", "id", "label", "n", "positive_id", "positive_score"), "pairs")

    targets = pairs.groupBy("key", "id", "label").agg(  # ``positives`` of them at most
        F.sort_array(F.collect_list(F.struct("n", "positive_id", "positive_score"))).alias("targets")
    )
    asked = asked.join(targets, ["key", "id", "label"])

    def find_negatives(tree, anchors, batch, ids, labels) -> list[tuple]:
        least, top = (x.tolist() for x in tree.intervals(anchors))
        out = []
        for key, own, label, a, targets, lo, hi in zip(
            batch.column(6).to_pylist(), ids, labels, anchors, batch.column(7).to_pylist(), least, top,
            strict=True,
        ):
            scores = [t["positive_score"] for t in targets]
            windows = [(-(-s * low // 100), s * high // 100) for s in scores]
            best = tree.negatives(a, int(own), int(label), windows, lo, hi, negatives)
            for t, rows in zip(targets, best, strict=True):
                out += [
                    (key, int(own), int(label), t["n"], t["positive_id"], t["positive_score"], x, _long(-s))
                    for s, x in rows
                ]
        return out

    schema = (
        "key long, id long, label long, n int, positive_id long, positive_score long, "
        "negative_id long, negative_score long"
    )
    found = materialize(
        dealt(asked, ["key", "targets"]).mapInArrow(_search(schema, find_negatives, leaf), schema),
        "negatives",
    )
    of = Window.partitionBy("key", "id", "label", "n")
    place = F.row_number().over(of.orderBy(F.desc("negative_score"), "negative_id"))
    return (
        found.withColumn("rank", place.cast("int"))
        .filter(F.col("rank") <= negatives)
        .select(
            F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score",
            "negative_score",
        )
    )
