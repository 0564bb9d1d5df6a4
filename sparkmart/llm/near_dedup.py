"""Near-duplicate documents by HyperMinHash.

A document is its set of distinct ``k``-word shingles.  Its HyperMinHash has a
register for each of 128 buckets: the leading-zero count and ten mantissa
bits of the smallest shingle hash that falls in the bucket (0 if none does).
Four registers make a band; documents that share a band's registers are
candidates.  With similarity 0.8 a band agrees with probability 0.8**4 at
least, so that all 32 bands miss a pair once in 20 million.  Candidates whose
collision-corrected register estimate is far below the threshold are dropped
(six standard deviations), the others are confirmed on their full sets.

Groups of copies cost no pairs among themselves:

* documents with equal sets are one class with one representative;
* in a band's bucket each member is paired with one centre, the member that
  sits in the fullest buckets (the likely origin of the copies);
* then only buckets whose members are still in several components are looked
  at again, pairing every member outside the bucket's largest component with
  the members of other components.  The documents of buckets where that would
  be more than ``FEW`` pairs (a passage that many documents share, or a group
  of edited copies, fills such buckets) are joined among themselves without
  bands and without a chance of a miss: each set is put in the order of how
  many of these documents hold a shingle, the rarest first.  Sets that reach
  the threshold share a shingle among the first ``n - threshold * n + 1``, and
  the places of the first one they share bound their intersection, which
  rules out copies with many edits of their own.

So every candidate pair is either compared or already connected, and the
components are those of all confirmed links.

Defined cases: documents without words (null, empty, blank) have no shingle
and are linked with nothing; a null id takes part in no link, has a null
component and is kept; rows that repeat an id are one vertex of
:func:`near_duplicates`, linked by any of their texts, while
:func:`deduplicate` judges each text of such an id by itself; an empty table
gives an empty result; extra columns pass
through :func:`deduplicate` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import (
    bound_batches,
    col,
    connected_components,
    free_name,
    materialize,
    shingle_sets,
    splitmix,
)

P, R, ROWS = 7, 10, 4  # 2**P buckets, R mantissa bits, registers a band
BUCKETS, BANDS = 1 << P, (1 << P) // ROWS
SIGMAS = 6.0
FEW = 16  # pairs that a bucket may give before the prefix join takes over
BATCH = 4 << 20  # bytes sent to a Python task at once
BITMAP = 1 << 23  # bits of the filter on ids whose texts are needed
_U = np.uint64
_STARTS = np.arange(BUCKETS, dtype=np.uint64) << _U(64 - P)

SIGNATURE = "id long, t long, n long, h1 long, h2 long, regs array<long>"


def registers(hashes: np.ndarray) -> np.ndarray:
    """The registers of a sorted array of distinct 64-bit hashes."""
    out = np.zeros(BUCKETS, np.uint64)
    at = np.searchsorted(hashes, _STARTS)
    full = np.flatnonzero(np.append(at[1:], len(hashes)) > at)
    low = hashes[at[full]] & _U((1 << (64 - P)) - 1)
    mantissa, exponent = np.frexp(low.astype(np.float64))
    zeros = (64 - P) - exponent
    bits = np.where(low == 0, 0, (mantissa * 2 - 1) * (1 << R)).astype(np.int64)
    out[full] = ((zeros.astype(np.int64) << R) | bits) + 1
    return out


def packed(regs: np.ndarray) -> np.ndarray:
    """Four 16-bit registers in each of 32 longs."""
    parts = regs.reshape(BANDS, ROWS)
    shifts = np.arange(ROWS, dtype=np.uint64) * _U(16)
    return np.bitwise_or.reduce(parts << shifts, axis=1).view(np.int64)


def unpacked(bands: np.ndarray) -> np.ndarray:
    """``(rows, 32)`` longs as ``(rows, 128)`` registers."""
    return np.ascontiguousarray(bands).astype("<i8").view("<u2").reshape(len(bands), BUCKETS)


@lru_cache(maxsize=4096)
def _expected(n16: int, m16: int) -> float:
    """Registers of two independent sets that agree by chance; sizes as
    sixteenths of their binary logarithm."""
    n, m = 2 ** (n16 / 16), 2 ** (m16 / 16)
    i = np.arange(1, 65 - P, dtype=np.float64)[:, None]
    j = np.arange(1 << R, dtype=np.float64)[None, :]
    # A register's value is one interval of the unit range of hashes.
    low = ((1 << R) + j) / 2.0 ** (P + R + i)
    high = ((1 << R) + j + 1) / 2.0 ** (P + R + i)
    part = lambda x: np.exp(x * np.log1p(-low)) - np.exp(x * np.log1p(-high))
    return float((part(n) * part(m)).sum() * BUCKETS)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected similarity from registers, and the number of
    registers it rests on."""
    used = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1).astype(float)
    size = lambda x: np.round(np.log2(np.maximum(x, 1)) * 16).astype(int)
    chance = np.array([_expected(x, y) for x, y in zip(size(n), size(m), strict=True)])
    chance = np.minimum(chance, same)
    return (same - chance) / np.maximum(used, 1), used


def signatures(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:data:`SIGNATURE` rows: a hash of the text, set size, set hash and packed registers."""
    bound_batches(docs, BATCH)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            n, h1, h2, regs = [], [], [], []
            with np.errstate(over="ignore"):
                for u in shingle_sets(texts, k):
                    n.append(len(u))
                    h1.append(int(splitmix(u).sum(dtype=np.uint64).view(np.int64)))
                    h2.append(int(splitmix(~u).sum(dtype=np.uint64).view(np.int64)))
                    regs.append(packed(registers(u)))
            flat = np.concatenate(regs) if regs else np.zeros(0, np.int64)
            at = np.arange(len(regs) + 1, dtype=np.int32) * BANDS
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(h1, pa.int64()),
                 pa.array(h2, pa.int64()), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))],
                ["id", "t", "n", "h1", "h2", "regs"],
            )

    rows = docs.select(
        col(id_col).cast("long").alias("id"), col(text_col).alias("text"), F.xxhash64(col(text_col)).alias("t")
    )
    return rows.mapInArrow(sign, SIGNATURE)


def _bands(reps: DataFrame) -> DataFrame:
    """``(key, id)``: a row for each band that is not all empty.  Sets of up to
    three shingles are only similar if equal and need no band."""
    return (
        reps.filter("n > 3")
        .select("id", "n", F.posexplode("regs").alias("band", "packed"))
        .filter("packed <> 0")
        .select(F.xxhash64("band", "packed").alias("key"), "id", "n")
    )


def _shared(rows: DataFrame) -> DataFrame:
    """The rows whose ``key`` has several, with the number as ``size``.  The
    counts are combined map-side; a hot key then meets one row in the join."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return rows.join(sizes, "key")


def _likely(pairs: DataFrame, reps: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose sizes allow the threshold and whose register estimate
    is not far below it."""
    side = lambda x: reps.select(
        F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("regs").alias(f"r_{x}")
    )
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    t = threshold
    both = both.filter(f"n_a * 100 >= n_b * {t} AND n_b * 100 >= n_a * {t}")
    bound_batches(both, BATCH)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = (np.asarray(batch.column(i)) for i in (2, 4))
            a, b = (
                unpacked(batch.column(i).flatten().to_numpy().reshape(-1, BANDS)) for i in (3, 5)
            )
            est, used = estimate(a, b, n, m)
            j = threshold / 100
            keep = est >= j - SIGMAS * np.sqrt(j * (1 - j) / np.maximum(used, 1))
            yield batch.select([0, 1]).filter(pa.array(keep))

    return (
        both.select("a", "b", "n_a", "r_a", "n_b", "r_b")
        .mapInArrow(near, "a long, b long").distinct()
    )


def _places() -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(BITMAP)).alias(f"p{i}") for i in range(2)]


def _bitmap(ids: DataFrame) -> bytes:
    """A bitmap of ``BITMAP`` bits over ``ids(id)``, whatever their number."""
    words = (
        ids.select(F.explode(F.array(*_places())).alias("p"))
        .groupBy(F.shiftright("p", 6).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("bits"))
        .collect()  # BITMAP / 64 rows at most
    )
    bitmap = np.zeros(BITMAP // 64, np.int64)
    bitmap[[r.w for r in words]] = [r.bits for r in words]
    return bitmap.tobytes()


def _kept(batches: Iterator[pa.RecordBatch], bitmap: bytes) -> Iterator[pa.RecordBatch]:
    """The rows ``(id, text)`` of ``(id, text, p0, p1)`` whose places are set."""
    flags = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little").astype(bool)
    for batch in batches:
        at = [np.asarray(batch.column(i)) for i in (2, 3)]
        yield batch.select([0, 1]).filter(pa.array(flags[at[0]] & flags[at[1]]))


def only_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs(id, text)`` whose id may be among ``ids(id)``, by a
    bitmap, so that a shuffle carries few texts that are not needed."""
    data = _bitmap(ids)
    bound_batches(docs, BATCH)
    rows = docs.filter("id IS NOT NULL").select("id", "text", *_places())
    return rows.mapInArrow(lambda batches: _kept(batches, data), "id long, text string")


def confirmed(pairs: DataFrame, docs: DataFrame, k: int, threshold: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets reach the threshold; only
    texts that are in some pair are shuffled."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    docs = materialize(only_ids(docs, ids), "texts")
    left = docs.select(F.col("id").alias("a"), F.col("text").alias("t_a"))
    right = docs.select(F.col("id").alias("b"), F.col("text").alias("t_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "t_a", "t_b")
    bound_batches(both, BATCH)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ta, tb = (batch.column(i).cast(pa.large_binary()).to_pylist() for i in (2, 3))
            keep = []
            for u, v in zip(shingle_sets(ta, k), shingle_sets(tb, k), strict=True):
                same = len(u) + len(v) - len(np.union1d(u, v))
                keep.append(same > 0 and 100 * same >= threshold * (len(u) + len(v) - same))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(check, "a long, b long").distinct()


def _star_pairs(shared: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's centre."""
    weight = shared.groupBy("id").agg(F.sum("size").alias("weight"))
    rows = shared.join(weight, "id")
    centre = rows.groupBy("key").agg(
        F.max(F.struct("weight", (-F.col("id")).alias("minus"))).alias("top")
    )
    pairs = shared.join(centre.select("key", (-F.col("top.minus")).alias("b")), "key")
    return pairs.filter("id <> b").select(
        F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")
    ).distinct()


def _prefixes(ids: DataFrame, texts: DataFrame, sig: DataFrame, k: int, threshold: int) -> DataFrame:
    """``(key, id, n, place)``: the shingles ``key`` at the first places of the
    sets of the documents among ``ids``, in the order of how many of them hold
    a shingle.  Two sets of the threshold have one of these in common; those
    that one set alone holds are left out.

    What is shuffled for a shingle is its hash, its set's number and size.
    Shingles of one set alone come first in the order, so they are counted and
    not ranked.  (The filter on ids may let a few more documents in; they do
    no harm.)
    """
    data = _bitmap(ids)
    bound_batches(texts, BATCH)

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _kept(batches, data):
            ids_ = np.asarray(batch.column(0))
            sets = shingle_sets(batch.column(1).cast(pa.large_binary()).to_pylist(), k)
            some, n = [], 0  # some 64 thousand shingles at once, one set at least
            for i, x in zip(ids_.tolist(), sets, strict=True):
                some.append((i, x))
                n += len(x)
                if n >= 1 << 16:
                    yield rows_of(some)
                    some, n = [], 0
            if n:
                yield rows_of(some)

    def rows_of(some: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        sizes = np.array([len(x) for _, x in some], np.int32)
        with np.errstate(over="ignore"):
            names = np.array([splitmix(x).sum(dtype=np.uint64) for _, x in some], np.uint64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([x for _, x in some]).view(np.int64)),
             pa.array(np.repeat(np.array([i for i, _ in some], np.int64), sizes)),
             pa.array(np.repeat(names.view(np.int64), sizes)), pa.array(np.repeat(sizes, sizes))],
            ["key", "id", "h1", "n"],
        )

    # An id may have several sets, each with a number of its own; rows that
    # repeat an id and its text repeat the same number.
    number = F.xxhash64("id", "h1").alias("set")
    rows = texts.filter("id IS NOT NULL").select("id", "text", *_places())
    each = rows.mapInArrow(shingles, "key long, id long, h1 long, n int")
    each = each.select("key", number, "n")
    held = each.groupBy("key").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    mine = Window.partitionBy("set", "n")
    order = mine.orderBy("held", "key")
    # dense_rank: a repeated row's shingles share their places.
    ranked = each.join(held, "key").select("key", "set", "n", F.dense_rank().over(order).alias("rank"))
    ranked = ranked.withColumn("shared", F.max("rank").over(mine))
    placed = ranked.withColumn("place", F.col("n") - F.col("shared") + F.col("rank") - 1)
    placed = placed.filter(f"(n - place) * 100L >= n * {threshold}L").distinct()
    sets = only_rows(sig.select("id", number), ids)
    return placed.join(sets, "set").select("key", "id", F.col("n").cast("long").alias("n"), "place")


def only_rows(sets: DataFrame, ids: DataFrame) -> DataFrame:
    return sets.join(ids, "id", "left_semi").distinct()


def _open_buckets(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """The rows whose ``key`` has members in several components, with their
    component, the key's largest one and the pairs to be looked at."""
    rows = rows.join(comp, "id", "left").withColumn("comp", F.coalesce("component", "id"))
    rows = rows.drop("component")
    part = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    keys = part.groupBy("key").agg(
        F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("all"),
        F.count(F.lit(1)).alias("parts"),
    ).filter("parts > 1")
    keys = keys.select(
        "key", F.col("top.comp").alias("main"),
        ((F.col("all") - F.col("top.c")) * F.col("all")).alias("cost"),
    )
    return materialize(rows.join(keys, "key"), "open-buckets")


def _cross_pairs(rows: DataFrame, threshold: int) -> DataFrame:
    """Pairs across components within the open buckets ``rows``, of sizes and
    places that allow the threshold."""
    t = threshold
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("id", "comp", "n", "place")]
    return (
        rows.filter("comp <> main").select("key", *side("x"))
        .join(rows.select("key", "main", *side("y")), "key")
        .filter("comp_x <> comp_y AND (comp_y = main OR id_x < id_y)")
        .filter(f"n_x * 100 >= n_y * {t} AND n_y * 100 >= n_x * {t}")
        .filter(f"least(n_x - place_x, n_y - place_y) * (100 + {t}) >= (n_x + n_y) * {t}")
        .select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()
    )


def _open_pairs(
    rows: DataFrame, comp: DataFrame, texts: DataFrame, sig: DataFrame, k: int, threshold: int
) -> DataFrame | None:
    """Pairs across components of documents that share a bucket of
    ``rows(key, id, n)``, of sizes that allow the threshold."""
    open_ = _open_buckets(rows.withColumn("place", F.lit(0)), comp)
    n_few, n_many = open_.agg(
        F.count(F.when(F.col("cost") <= FEW, 1)), F.count(F.when(F.col("cost") > FEW, 1))
    ).first()
    if not n_few and not n_many:
        return None
    pairs = _cross_pairs(open_.filter(F.col("cost") <= FEW), threshold)
    if n_many:
        ids = materialize(open_.filter(F.col("cost") > FEW).select("id").distinct(), "crowd")
        crowd = materialize(_prefixes(ids, texts, sig, k, threshold), "prefixes")
        pairs = pairs.unionByName(_cross_pairs(_open_buckets(crowd, comp), threshold)).distinct()
    return pairs


def _components(
    docs: DataFrame, k: int, threshold: int, id_col: str, text_col: str, join_ids: bool
) -> DataFrame:
    """``(id, t, n, component)`` for every row; ``t`` is a hash of its text.
    ``join_ids`` makes the rows of one id one vertex."""
    if threshold < 76:
        raise ValueError("the bands are laid out for a similarity of 0.76 or more")
    texts = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))
    sig = materialize(signatures(texts, k, "id", "text"), "signatures")
    named = sig.filter("n > 0 AND id IS NOT NULL")
    reps = named.groupBy("n", "h1", "h2").agg(F.min(F.struct("id", "regs")).alias("r"))
    reps = materialize(reps.select("n", "h1", "h2", "r.id", "r.regs"), "classes")
    shared = materialize(_shared(_bands(reps)), "bands")
    pairs = materialize(_likely(_star_pairs(shared), reps, threshold), "pairs")
    links = materialize(confirmed(pairs, texts, k, threshold), "links")
    comp = materialize(connected_components(links), "components")
    more = _open_pairs(shared.drop("size"), comp, texts, named, k, threshold)
    found = None
    if more is not None:
        more = more.join(pairs, ["a", "b"], "left_anti")
        more = materialize(_likely(more, reps, threshold), "pairs")
        found = materialize(confirmed(more, texts, k, threshold), "links")
        found = None if found.isEmpty() else found
    ties = None
    if join_ids:
        ties = materialize(_id_ties(named, reps), "ties")
        ties = None if ties.isEmpty() else ties
    for extra in (found, ties):
        links = links if extra is None else links.unionByName(extra)
    if found is not None or ties is not None:
        comp = materialize(connected_components(links), "components")
    classes = reps.select("n", "h1", "h2", "id").join(comp, "id", "left").select(
        "n", "h1", "h2", F.coalesce("component", "id").alias("component")
    )
    return sig.join(classes, ["n", "h1", "h2"], "left").select(
        "id", "t", "n",
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"),
    )


def _id_ties(named: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of the representatives of one id's different sets."""
    name = F.struct("n", "h1", "h2")
    several = named.groupBy("id").agg(F.min(name).alias("x"), F.max(name).alias("y")).filter("x <> y")
    sets = named.select("id", "n", "h1", "h2").join(several.select("id"), "id", "left_semi").distinct()
    other = reps.select("n", "h1", "h2", F.col("id").alias("rep"))
    met = sets.join(other, ["n", "h1", "h2"]).select("id", "rep")
    first = met.groupBy("id").agg(F.min("rep").alias("a"))
    return met.join(first, "id").filter("a <> rep").select("a", F.col("rep").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, k: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(id, n_shingles, component, kept)`` for every row of ``docs``.

    Two documents are linked if ``100 * |intersection| >= threshold *
    |union|`` of their ``k``-word shingle sets; ``component`` is the smallest
    id that links reach, and ``kept`` marks the row with that id.
    """
    rows = _components(docs, k, threshold, id_col, text_col, join_ids=True)
    return rows.select(
        "id", F.col("n").alias("n_shingles"), "component",
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def deduplicate(docs: DataFrame, k: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near duplicates: that with
    the smallest id.  Where an id repeats with several texts, each text is
    judged by its own group, so that none is lost with another one's."""
    rows = _components(docs, k, threshold, id_col, text_col, join_ids=False)
    name, text = free_name(docs, "__gone"), free_name(docs, "__text")
    gone = rows.filter("id <> component").select(F.col("id").alias(name), F.col("t").alias(text)).distinct()
    same = (col(id_col).cast("long") == F.col(name)) & (F.xxhash64(col(text_col)) == F.col(text))
    return docs.join(gone, same, "left_anti")
