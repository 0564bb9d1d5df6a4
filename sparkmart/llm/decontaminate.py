"""Benchmark decontamination by pigeonhole edit matching.

An item of ``n`` words may appear in a document with up to ``e =
floor(max_error * n)`` word edits.  The item is split into ``e + 1`` pieces;
with at most ``e`` edits one piece at least must appear unchanged, so exact
piece hits find every match.  Hits come from rolling hashes of the document's
words, looked up in the pieces of the same length; the stretch around each
hit is verified with Myers' bit-parallel distance over words.

Words are runs of bytes other than ASCII white space and punctuation, with
A-Z lower-cased, in texts and items alike.

Items go to the tasks in blocks of at most ``BLOCK_BYTES`` of text (one item
at least); a larger benchmark makes several passes over the same batch.

Defined cases: a null or empty document matches nothing; a null item or one
with fewer than ``min_words`` words is no evidence and matches nothing; items
that repeat an id or a text are matched one by one; documents that repeat are
matched one by one; texts are searched whole.  An empty benchmark keeps every
document.  Extra columns pass through unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.llm.common import _powers, bound_batches, col, free_name, splitmix, word_groups

BLOCK_BYTES = 16 << 20
_U = np.uint64
_MASK = (1 << 20) - 1
MATCHES = "array<struct<item_id:long,distance:int,start_word:int,end_word:int>>"


def myers(pattern: dict[int, int], m: int, text: list[int]) -> tuple[int, int]:
    """Least edit distance of the pattern (bit masks by word, ``m`` words) to
    a stretch of ``text``, and where the first such stretch ends."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text):
        eq = pattern.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full  # the match may begin anywhere: no cost on the left
        mh = (mh << 1) & full
        pv = mh | (~(xv | ph) & full)
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def bit_masks(words: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


class Items:
    """Pieces of a block of items, by piece length."""

    def __init__(self, items: list[tuple[int, str]], max_error: float, min_words: int):
        self.ids: list[int] = []
        self.words: list[list[int]] = []
        self.budget: list[int] = []
        pieces: dict[int, dict[int, list[tuple[int, int]]]] = {}
        texts = [t.encode() for _, t in items]
        for i, j, words, bounds in word_groups(texts, punctuation=True):
            for x, a, b in zip(range(i, j), bounds[:-1], bounds[1:], strict=True):
                n = int(b - a)
                if n < max(min_words, 1):
                    continue
                e = min(math.floor(max_error * n), n - 1)
                at = len(self.ids)
                self.ids.append(items[x][0])
                self.words.append(words[a:b].tolist())
                self.budget.append(e)
                rolling = Rolling(words[a:b])
                for p in range(e + 1):
                    lo, hi = n * p // (e + 1), n * (p + 1) // (e + 1)
                    h = int(rolling.windows(hi - lo)[lo])
                    pieces.setdefault(hi - lo, {}).setdefault(h, []).append((at, lo))
        self.masks = [bit_masks(w) for w in self.words]
        self.back = [bit_masks(w[::-1]) for w in self.words]
        self.pieces = pieces
        self.flags = {}
        for length, table in pieces.items():
            flag = np.zeros(_MASK + 1, bool)
            flag[np.array([h & _MASK for h in table], np.int64)] = True
            self.flags[length] = (flag, np.sort(np.array(list(table), np.uint64)))

    def search(self, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, list[dict]]]:
        """``(text, matches)`` for the texts of a group with a match."""
        near: dict[tuple[int, int], list[tuple[int, int]]] = {}
        rolling = Rolling(words)
        for length, (flag, known) in self.flags.items():
            h = rolling.windows(length)
            if not len(h):
                continue
            at = np.flatnonzero(flag[(h & _U(_MASK)).astype(np.int64)])
            at = at[known[np.minimum(np.searchsorted(known, h[at]), len(known) - 1)] == h[at]]
            doc = np.searchsorted(bounds, at, "right") - 1
            inside = at + length <= bounds[doc + 1]
            for p, d in zip(at[inside].tolist(), doc[inside].tolist(), strict=True):
                for item, lo in self.pieces[length][int(h[p])]:
                    e, n = self.budget[item], len(self.words[item])
                    near.setdefault((d, item), []).append((p - lo - e, p - lo + n + e))
        found: dict[int, list[dict]] = {}
        for (d, item), spans in sorted(near.items()):
            first, last = int(bounds[d]), int(bounds[d + 1])
            n, e, best = len(self.words[item]), self.budget[item], None
            for a, b in merged(spans, first, last):
                text = words[a:b].tolist()
                distance, end = myers(self.masks[item], n, text)
                if distance <= e and (best is None or distance < best["distance"]):
                    # Backwards from the end: how far the stretch reaches.
                    _, back = myers(self.back[item], n, text[:end][::-1])
                    best = {
                        "item_id": self.ids[item], "distance": distance,
                        "start_word": a + end - back - first, "end_word": a + end - first,
                    }
            if best:
                found.setdefault(d, []).append(best)
        yield from found.items()


class Rolling:
    """Hashes of all windows of any length from one prefix sum."""

    def __init__(self, words: np.ndarray):
        up, self.down = _powers(len(words) + 1)
        with np.errstate(over="ignore"):
            self.total = np.concatenate(
                [[_U(0)], np.cumsum((words | _U(1)) * up[: len(words)], dtype=np.uint64)]
            )

    def windows(self, k: int) -> np.ndarray:
        n = len(self.total) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            return splitmix((self.total[k:] - self.total[:n]) * self.down[:n])


def merged(spans: list[tuple[int, int]], first: int, last: int) -> Iterator[tuple[int, int]]:
    """The union of the spans inside ``[first, last)``, so that a document's
    words are compared once however many hits they have."""
    a = b = None
    for x, y in sorted((max(x, first), min(y, last)) for x, y in spans):
        if b is None or x > b:
            if b is not None:
                yield a, b
            a, b = x, y
        else:
            b = max(b, y)
    if b is not None:
        yield a, b


_BUILT: dict[int, list[Items]] = {}


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    max_error: float = 0.1,
    min_words: int = 5,
) -> tuple[DataFrame, str]:
    """``docs`` with an array of the best match per item (empty where none),
    and the name of that column (``matches`` unless ``docs`` has one)."""
    bound_batches(docs)
    items = benchmark.select(
        col(item_col).cast("long").alias("i"), col(item_text_col).alias("t")
    ).filter("t is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-int(size) // BLOCK_BYTES))
    name = free_name(docs, "matches")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T._parse_datatype_string(MATCHES))])
    out = docs
    held = F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks))
    for b in range(n_blocks):
        # Bounded: one block of the benchmark's text.
        block = sorted((r.i, r.t) for r in items.filter(held == b).collect() if r.i is not None)
        out = _search_block(out, block, text_col, name, schema, max_error, min_words, b > 0)
    return out, name


def _search_block(docs, block, text_col, name, schema, max_error, min_words, more) -> DataFrame:
    kind = pa.list_(
        pa.struct(
            [("item_id", pa.int64()), ("distance", pa.int32()),
             ("start_word", pa.int32()), ("end_word", pa.int32())]
        )
    )
    key = hash((tuple(block), max_error, min_words))
    place = [c.lower() for c in docs.columns].index(text_col.lower())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _BUILT.get(key)
        if table is None:
            table = _BUILT[key] = Items(block, max_error, min_words)
        for batch in batches:
            texts = batch.column(place).cast(pa.large_binary()).to_pylist()
            hits: list[list[dict]] = [[] for _ in texts]
            if table.ids:
                for i, _, words, bounds in word_groups(texts, punctuation=True):
                    for d, found in table.search(words, bounds):
                        hits[i + d] = found
            arrays = list(batch.columns)
            if more:
                hits = [[*a, *b] for a, b in zip(arrays.pop().to_pylist(), hits, strict=True)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(hits, kind)], schema.names)

    return docs.mapInArrow(search, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    found, name = find_leaks(docs, benchmark, **options)
    return found.filter(F.size(col(name)) == 0).drop(name)
