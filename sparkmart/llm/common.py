"""Helpers shared by the corpus operators: scratch tables, exact global
ranks, connected components, and vectorised word hashing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.session import scratch_path

# --------------------------------------------------------------------------
# DataFrame helpers
# --------------------------------------------------------------------------


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def col(name: str) -> Column:
    """A top-level column by its exact name (dots and blanks allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the cluster's shared checkpoint folder and read it
    back.  Cuts lineage with files that every executor sees, so a lost
    executor costs a re-read and not a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(df: DataFrame, limit: int = 8 << 20) -> None:
    """Keep the Arrow batches sent to Python tasks within ``limit`` bytes (one
    row at least), unless the session already has a smaller limit."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf = df.sparkSession.conf
    text = str(conf.get(key, str(2**31 - 1))).strip().lower()
    digits = text.rstrip("bkmg")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[len(digits) : len(digits) + 1], 1)
    if not digits.isdigit() or int(digits) * unit > limit:
        conf.set(key, str(limit))


def global_index(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add ``name``: the row's 0-based position in the total order ``order``.

    One range shuffle and no single-task window: rows are range-partitioned
    and sorted inside each partition, written with their place in the
    partition, and the per-partition counts (one row per partition) give each
    partition's offset.  ``order`` should end in a column that separates
    rows, so that no key is too large for one partition.
    """
    mid, part, start = (free_name(df, c) for c in ("__mid", "__part", "__start"))
    spread = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    placed = materialize(
        df.repartitionByRange(int(spread), *order)
        .sortWithinPartitions(*order)
        .withColumn(mid, F.monotonically_increasing_id()),
        "ranked",
    )
    # monotonically_increasing_id: partition number in the upper 31 bits, row
    # number within the partition in the lower 33.
    tagged = placed.withColumn(part, F.shiftright(F.col(mid), 33))
    counts = tagged.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    # A window without a partition, over one row per shuffle partition.
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        part, F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias(start)
    )
    low = F.col(mid).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        tagged.join(F.broadcast(offsets), part)  # one row per shuffle partition
        .withColumn(name, F.col(start) + low)
        .drop(mid, part, start)
    )


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(id, component)`` for the vertices of ``edges(a, b)``; the component
    is the smallest id that can be reached.

    Alternating large-star / small-star: every step is a ``min`` per vertex
    (combined map-side, so a vertex with very many edges collapses in each
    task) and a join back.  Each round is a written table; nothing but two
    totals per round reaches the driver.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e = materialize(e.filter("u <> v").distinct(), "edges")
    last = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(low, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(
                F.explode(
                    F.array(
                        F.struct(F.col("u"), F.col("m").alias("v")),
                        F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                    )
                ).alias("x")
            )
            .select("x.u", "x.v")
            .filter("u <> v")
            .distinct()
        )
        e = materialize(small, "edges")
        now = e.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # Settled: every vertex points straight at its component's smallest id.
    stars = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionByName(
        stars.select(F.col("component").alias("id"), "component").distinct()
    )


# --------------------------------------------------------------------------
# Word hashing (numpy, inside tasks)
# --------------------------------------------------------------------------

GROUP_BYTES = 1 << 20  # texts are hashed in groups of about this many bytes
_U = np.uint64


def splitmix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator (public constants)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_WS = np.zeros(256, bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True
_PUNCT = _WS.copy()
_PUNCT[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE = splitmix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))[_LOWER]
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_POW: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW[0]) < n:
        size = max(n, GROUP_BYTES + 1)
        with np.errstate(over="ignore"):
            one = lambda b: np.multiply.accumulate(
                np.concatenate([[_U(1)], np.full(size - 1, b, np.uint64)])
            )
            _POW[:] = [one(_U(_BASE)), one(_U(pow(_BASE, -1, 1 << 64)))]
    return _POW[0], _POW[1]


class Words:
    """The words in ``data`` (bytes ``s[i]:e[i]``); a text begins at each of
    ``first``, and ``gaps`` flags the bytes between words."""

    def __init__(self, data: np.ndarray, first: np.ndarray, gaps: np.ndarray):
        n = len(data)
        up, self.down = _powers(n + 1)
        gap = gaps[data]
        cut = np.zeros(n + 1, bool)
        cut[first] = True
        cut[n] = True
        start = ~gap
        end = start.copy()
        start[1:] &= gap[:-1] | cut[1:n]
        end[:-1] &= gap[1:] | cut[1:n]
        self.s, self.e = np.flatnonzero(start), np.flatnonzero(end) + 1
        with np.errstate(over="ignore"):
            self.total = np.concatenate(
                [[_U(0)], np.cumsum(_BYTE[data] * up[:n], dtype=np.uint64)]
            )

    def hashes(self, prefix: int = 0) -> np.ndarray:
        """Hashes of the words, or of their first ``prefix`` bytes where they are longer."""
        s, e = self.s, self.e
        if prefix:
            e = np.minimum(e, s + prefix)
        with np.errstate(over="ignore"):
            return splitmix(
                (self.total[e] - self.total[s]) * self.down[s] + (e - s).astype(np.uint64)
            )


def _hash_block(data: np.ndarray, first: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = Words(data, first, gaps)
    return words.hashes(), words.s


def word_groups(
    texts: Sequence[bytes | None], punctuation: bool = False
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Groups ``(i, j, words, bounds)``: the 64-bit hashes of the words of
    ``texts[i:j]`` and where each text's words begin and end in ``words``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; ``punctuation``
    makes ASCII punctuation part of the gaps.  A null text has no words.
    Temporary arrays are bounded by ``GROUP_BYTES`` for any text length; only
    the 8 bytes a word of one text are held whole.
    """
    gaps = _PUNCT if punctuation else _WS
    i, n = 0, len(texts)
    while i < n:
        j, size = i, 0
        while j < n and (j == i or size + len(texts[j] or b"") <= GROUP_BYTES):
            size += len(texts[j] or b"")
            j += 1
        if size > GROUP_BYTES:  # one long text: blocks that end at white space
            words = np.concatenate([np.zeros(0, np.uint64), *_long_text(texts[i], gaps)])
            yield i, j, words, np.array([0, len(words)])
        else:
            lengths = np.array([len(t or b"") for t in texts[i:j]])
            ends = np.cumsum(lengths)
            if size:
                data = np.frombuffer(b"".join(t or b"" for t in texts[i:j]), np.uint8)
                first = (ends - lengths)[lengths > 0]
                words, at = _hash_block(data, first, gaps)
                bounds = np.concatenate([[0], np.searchsorted(at, ends)])
            else:
                words, bounds = np.zeros(0, np.uint64), np.zeros(j - i + 1, np.int64)
            yield i, j, words, bounds
        i = j


def _long_text(text: bytes, gap: np.ndarray) -> Iterator[np.ndarray]:
    for data in text_blocks(text, gap):
        yield _hash_block(data, np.array([0]), gap)[0]


def text_blocks(text: bytes, gap: np.ndarray = _WS) -> Iterator[np.ndarray]:
    """Parts of a text of about ``GROUP_BYTES`` each, cut between words."""
    data = np.frombuffer(text, np.uint8)
    at = 0
    while at < len(data):
        end = min(at + GROUP_BYTES, len(data))
        if end < len(data):
            cuts = np.flatnonzero(gap[data[at:end]])
            while not len(cuts) and end < len(data):  # a word longer than a block
                more = min(end + GROUP_BYTES, len(data))
                cuts = np.flatnonzero(gap[data[end:more]]) + (end - at)
                end = more
            if len(cuts) and end < len(data):
                end = at + int(cuts[-1]) + 1
        yield data[at:end]
        at = end


_MIX = [int(x) | 1 for x in splitmix(np.arange(1, 65, dtype=np.uint64))]


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words (``len(words) - k + 1`` of them)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = words[:n] * _U(_MIX[0])
        for i in range(1, k):
            h = h + (words[i : i + n] ^ _U(_MIX[-1 - i])) * _U(_MIX[i])
        return splitmix(h)


def shingle_sets(texts: Sequence[bytes | None], k: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct ``k``-word shingle hashes.

    A text with fewer than ``k`` words has its whole sequence as its one
    shingle; a text without words (or null) has none.
    """
    for i, j, words, bounds in word_groups(texts):
        grams = window_hashes(words, k)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= k:
                yield np.unique(grams[a : b - k + 1])
            elif b > a:
                with np.errstate(over="ignore"):
                    h = window_hashes(words[a:b], int(b - a)) + _U(int(b - a) * 2 + 1)
                yield splitmix(h)
            else:
                yield np.zeros(0, np.uint64)
