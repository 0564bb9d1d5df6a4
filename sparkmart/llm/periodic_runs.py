"""Runs of periodically repeated words, found by block convolution.

A *run* is a stretch of consecutive words whose smallest period is ``q`` (words
``q`` apart are identical), that is at least ``max(min_words, repeats * q)``
long and that no neighbouring word extends with the same period.

At every dyadic scale ``B`` a text is cut into blocks of ``B`` words.  The
squared differences between a block and every place of the window that follows
it, ``sum((block - window)**2)``, come from one exact number-theoretic
transform; where the sum is zero the block occurs again, and the distance
between the two places seeds an extension, word by word, to the longest
stretch with that period.

* Nothing is missed: a run of period ``q`` in ``(B, 2B]`` (at the smallest
  scale: of any period up to ``2B``) holds ``q`` words more than some whole
  block of ``B`` words, because the run less one period has ``2B - 1`` words or
  more.  That block occurs again ``q`` words later.
* Only blocks that can recur are transformed: every word of such a block must
  come again within ``2B`` words, which one sort of the words tells.
* A place that an already known run of a period up to ``B`` covers to the
  window's end is skipped: two periods over such a stretch make the new one a
  multiple of the known one.
* The transform is exact modulo a prime, so a zero sum is never lost; a sum that
  is only zero modulo the prime is thrown out by the word-by-word comparison.

Texts are worked on inside the task that reads them: no shuffle.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+``, compared exactly; a null or
empty text has no runs and the collapsed text ''; texts are treated whole,
whatever their length; equal rows give equal results; other columns stay in
the JVM and pass through, and a column that is named like an output raises.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import bound_batches, col, free_name

PRIME = 15 * 2**27 + 1  # has roots of unity of every order 2**k up to 2**27
ROOT = 31  # generates the prime's multiplicative group
GROUP_BYTES = 1 << 20  # texts are worked on in groups of about this many bytes
CELLS = 1 << 18  # numbers transformed at once, or one block's if that is more

_U = np.uint64
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


# -- exact transform ---------------------------------------------------------


def _powers(h: int, back: bool) -> np.ndarray:
    """The first ``h`` powers of a root of unity of order ``2h``."""
    key = h, back
    if key not in _POWERS:
        w = pow(ROOT, (PRIME - 1) // (2 * h), PRIME)
        w = pow(w, -1, PRIME) if back else w
        out = np.ones(1, _U)
        while len(out) < h:  # doubling: the next powers are these times w**len
            out = np.concatenate([out, out * _U(pow(w, len(out), PRIME)) % _U(PRIME)])
        _POWERS[key] = out
    return _POWERS[key]


def transform(a: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of every column of ``a`` (in place; length a
    power of two, values below ``PRIME``), in bit-reversed order."""
    n, c = a.shape
    p, h = _U(PRIME), n // 2
    while h:
        x = a.reshape(-1, 2, h, c)
        low, high = x[:, 0], x[:, 1]
        both = low + high
        diff = (low + p - high) * _powers(h, False)[:, None] % p
        np.minimum(both, both - p, out=both)  # both - p wraps round when it is negative
        x[:, 0], x[:, 1] = both, diff
        h //= 2
    return a


def inverse(a: np.ndarray) -> np.ndarray:
    """Undo :func:`transform`."""
    n, c = a.shape
    p, h = _U(PRIME), 1
    while h < n:
        x = a.reshape(-1, 2, h, c)
        low, high = x[:, 0], x[:, 1] * _powers(h, True)[:, None] % p
        both, diff = low + high, low + (p - high)
        x[:, 0] = np.minimum(both, both - p)
        x[:, 1] = np.minimum(diff, diff - p)
        h *= 2
    a *= _U(pow(n, -1, PRIME))
    a %= p
    return a


def zero_mismatch(x: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(start, distance)`` of every block ``x[start : start + size]`` that
    recurs at a distance of 1 to ``2 * size``.  ``x`` (non-negative, below
    ``PRIME``) must go on for ``3 * size`` after each start."""
    n, p = 4 * size, _U(PRIME)
    if n > 2**27:
        raise ValueError("a text of more than 100 million words is beyond the transform")
    found: list[tuple[np.ndarray, np.ndarray]] = []
    some = max(1, CELLS // n)
    for at in range(0, len(starts), some):
        s = starts[at : at + some]
        window = np.zeros((n, len(s)), _U)
        window[: 3 * size - 1] = x[np.arange(1, 3 * size)[:, None] + s]
        block = np.zeros((n, len(s)), _U)
        block[:size] = x[np.arange(size)[:, None] + s]
        square = window[: 3 * size - 1] ** _U(2) % p
        sums = np.zeros((3 * size, len(s)), _U)
        np.cumsum(square, axis=0, out=sums[1:])
        own = (block[:size] ** _U(2) % p).sum(axis=0)
        block[:size] = block[:size][::-1].copy()
        both = transform(window)
        both *= transform(block)
        both %= p
        product = inverse(both)[size - 1 : 3 * size - 1]
        squares = (own + sums[size:] - sums[: 2 * size]) % p
        zero = squares == 2 * product % p
        d, i = np.nonzero(zero)
        found.append((s[i], d + 1))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(v) for v in zip(*found, strict=True))


# -- runs --------------------------------------------------------------------


def _extend(x: np.ndarray, i: int, size: int, d: int, n: int) -> tuple[int, int]:
    """The longest stretch ``[l, r)`` around ``i`` where words ``d`` apart are
    equal, given that those of ``[i, i + size)`` are."""
    step, a = 32, i + size
    while a + d < n:
        b = min(a + step, n - d)
        differ = np.flatnonzero(x[a:b] != x[a + d : b + d])
        if len(differ):
            a += int(differ[0])
            break
        a, step = b, step * 2
    step, left = 32, i
    while left:
        b = max(0, left - step)
        differ = np.flatnonzero(x[b:left] != x[b + d : left + d])
        if len(differ):
            left = b + int(differ[-1]) + 1
            break
        left, step = b, step * 2
    return left, a + d


def first_scale(min_words: int, repeats: int) -> int:
    """The smallest block: the largest power of two that a run less one period
    surely holds at a multiple of it."""
    if repeats < 3 or min_words < 3:
        raise ValueError("runs of at least three periods and three words can be found")
    least = -(-min_words * (repeats - 1) // repeats)
    size = 1
    while 4 * size - 1 <= least:
        size *= 2
    return size


def find_runs(
    codes: np.ndarray, longest: int, min_words: int = 24, repeats: int = 3
) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run in ``codes``, sorted.

    ``codes`` may be several texts end to end if no number occurs in two of
    them; ``longest`` is the length of the longest one.
    """
    n = len(codes)
    size = first_scale(min_words, repeats)
    if n < min_words:
        return []
    # Distance to the word's next occurrence.
    order = np.argsort(codes, kind="stable")
    after = np.full(n, n + 1, np.int64)
    same = codes[order[1:]] == codes[order[:-1]]
    after[order[:-1][same]] = (order[1:] - order[:-1])[same]

    periods: dict[tuple[int, int], int] = {}
    covered = None  # where a known run that holds the place ends
    x, scale = None, size
    # Farthest next occurrence in each whole block.
    far = after[: n // size * size].reshape(-1, size).max(axis=1)
    while (scale == size or scale < longest // repeats) and len(far):
        starts = np.flatnonzero(far <= 2 * scale) * scale
        if covered is not None and len(starts):
            starts = starts[covered[starts] < starts + 3 * scale]
        if len(starts):
            if x is None or len(x) < n + 3 * scale:  # past the end: a number of its own
                x = np.concatenate([codes, np.full(n + 3 * scale, codes.max() + 1)]).astype(_U)
            at, d = zero_mismatch(x, starts, scale)
            keep = at + scale + d <= n
            if scale > size:
                keep &= d > scale
            if covered is not None:
                keep &= covered[at] < at + scale + d
            at, d = at[keep], d[keep]
            new = []
            last = reach = -1
            for k in np.lexsort((at, d)):
                i, q = int(at[k]), int(d[k])
                if q == last and i < reach:  # inside the stretch just extended
                    continue
                if not np.array_equal(codes[i : i + scale], codes[i + q : i + q + scale]):
                    continue
                left, right = _extend(codes, i, scale, q, n)
                last, reach = q, right - q
                if right - left >= max(min_words, repeats * q):
                    # Equal stretches of several periods: the smallest is the period.
                    if q < periods.get((left, right), n):
                        periods[left, right] = q
                        new.append((left, right))
            for left, right in new:
                if covered is None:
                    covered = np.zeros(n, np.int64)
                np.maximum(covered[left:right], right, out=covered[left:right])
        scale *= 2
        far = np.maximum(far[: len(far) // 2 * 2 : 2], far[1::2])
    return sorted((a, b - a, q) for (a, b), q in periods.items())


def text_runs(
    texts: Sequence[bytes | None], min_words: int = 24, repeats: int = 3
) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Each text's runs and its collapsed words (joined by one blank)."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or b"") <= GROUP_BYTES):
            size += len(texts[j] or b"")
            j += 1
        yield from _group_runs([(t or b"").split() for t in texts[i:j]], min_words, repeats)
        i = j


def _group_runs(words: list[list[bytes]], min_words: int, repeats: int):
    # A number for each word of each text; bytes.split() cuts at exactly the
    # six characters that separate words.
    fresh = count().__next__
    lengths = [len(w) for w in words]
    ends = np.cumsum(lengths)
    codes = np.empty(int(ends[-1]), np.int64)
    for w, end in zip(words, ends, strict=True):
        if w:
            number = defaultdict(fresh)
            codes[end - len(w) : end] = np.fromiter(map(number.__getitem__, w), np.int64, len(w))
    runs = find_runs(codes, max(lengths), min_words, repeats)
    of = np.searchsorted(ends, [r[0] for r in runs], "right").tolist()
    mine = defaultdict(list)
    for k, (start, length, period) in zip(of, runs, strict=True):
        mine[k].append((start - int(ends[k]) + lengths[k], length, period))
    for k, w in enumerate(words):
        if k in mine:
            keep = np.ones(len(w), bool)
            for start, length, period in mine[k]:
                keep[start + period : start + length] = False
            w = [w[i] for i in np.flatnonzero(keep)]
        yield mine.get(k, []), b" ".join(w)


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(
    docs: DataFrame, text_col: str = "text", min_words: int = 24, repeats: int = 3,
    runs: str = "runs", collapsed: str = "collapsed",
) -> DataFrame:
    """``docs`` with ``runs`` (an array of ``(start, length, period)``, counted
    in words, by start and period) and ``collapsed``: the words that no run
    holds after its first period, joined by one blank."""
    taken = {c.lower() for c in docs.columns}
    if {runs.lower(), collapsed.lower()} & taken:
        raise ValueError(f"the table has a column {runs} or {collapsed}; name the output otherwise")
    first_scale(min_words, repeats)
    bound_batches(docs)

    @F.arrow_udf(f"{runs} array<struct<start:bigint,length:bigint,period:bigint>>, {collapsed} string")
    def find(texts: pa.Array) -> pa.Array:
        lists, kept, offsets = [], [], [0]
        binary = texts.cast(pa.binary()).to_pylist()
        for found, text in text_runs(binary, min_words, repeats):
            lists += found
            offsets.append(len(lists))
            kept.append(text)
        columns = list(zip(*lists, strict=True)) or [(), (), ()]
        flat = pa.StructArray.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], fields=list(RUN)
        )
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            [runs, collapsed],
        )

    both = free_name(docs, "__found")
    return docs.withColumn(both, find(col(text_col))).select(
        *[col(c) for c in docs.columns], F.col(both)[runs].alias(runs),
        F.col(both)[collapsed].alias(collapsed),
    )
