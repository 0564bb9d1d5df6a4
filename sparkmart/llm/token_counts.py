"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut into pieces by the vocabulary's byte-level pattern.  Each piece
starts as its bytes, one symbol each, in a doubly linked list; a heap holds
the adjacent pairs that have a merge, and the pair with the lowest rank
(leftmost on a tie) is merged until none is left.  The piece's count is its
initial symbols minus its merges; no token ids are emitted.  Counts of pieces
are remembered per task in a table of bounded size.

Strings of the vocabulary's special tokens inside a text count as one token
each, as the public library does by default; no begin, end or other tokens
are added and nothing is truncated or padded.

Defined cases: a null or empty text has 0 tokens; every text is counted
whole, however long; other columns stay in the JVM and pass through.
"""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import bound_batches, col

# Fixed values.  Letters and numbers assigned after version 16 of the Unicode
# tables, which the vocabulary's library has; the `regex` module knows later ones.
NEWER = """
0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D
107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F
12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA
18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24
1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED
1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
""".split()
# Fixed value: the byte-level pattern of the vocabulary, L and N standing for
# letters and numbers.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?[L]+| ?[N]+| ?[O]+|\s+(?!\S)|\s+"

CACHE_ENTRIES = 800_000
LONG_TEXT = 1 << 20  # above this many characters, pieces are not listed at once


def piece_pattern() -> regex.Pattern:
    newer = "".join(
        "-".join(f"\\U{int(x, 16):08X}" for x in part.split("-")) for part in NEWER
    )
    letters, numbers = rf"[\p{{L}}--[{newer}]]", rf"[\p{{N}}--[{newer}]]"
    other = rf"[^\s{letters}{numbers}]"
    text = PIECES.replace("[L]", letters).replace("[N]", numbers).replace("[O]", other)
    return regex.compile(text, regex.V1)


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies, by
    rule: printable Latin-1 bytes stand for themselves, the others take the
    code points from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {chr(b if b in plain else next(rest)): b for b in range(256)}


class Merges:
    """Merge ranks of a byte-level vocabulary and the counts of its pieces."""

    def __init__(self, spec: str):
        """``spec``: the text of a tokenizer's JSON file."""
        data = json.loads(spec)
        model, pre = data["model"], data.get("pre_tokenizer") or {}
        plain = {"dropout": None, "byte_fallback": False, "ignore_merges": False}
        if (
            model.get("type") != "BPE"
            or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space")
            or not pre.get("use_regex", True)
            or data.get("normalizer")
            or any(model.get(k) not in (v, None) for k, v in plain.items())
        ):
            raise ValueError("a byte-level BPE vocabulary without normaliser is needed")
        special = data.get("added_tokens") or []
        if any(t.get(k) for t in special for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("special tokens with white-space or word rules are not supported")
        vocab, letters = model["vocab"], byte_letters()
        self.first = [0] * 256  # symbol of each byte
        for letter, b in letters.items():
            self.first[b] = vocab[letter]
        self.base = max(vocab.values()) + 1
        self.rank: dict[int, tuple[int, int]] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[a] * self.base + vocab[b]] = (r, vocab[a + b])
        names = sorted((t["content"] for t in special), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.pieces = piece_pattern()
        self.known = Known(self)

    def merges(self, piece: bytes) -> int:
        """Number of merges made in ``piece``."""
        first, rank, base = self.first, self.rank, self.base
        symbol = [first[b] for b in piece]
        n = len(symbol)
        get = rank.get
        heap = []
        for i in range(n - 1):
            hit = get(symbol[i] * base + symbol[i + 1])
            if hit:
                heap.append((hit[0], i, hit[1]))
        if not heap:
            return 0
        heapify(heap)
        after = list(range(1, n + 1))  # after[i]: next symbol's place, n at the end
        before = list(range(-1, n - 1))
        done = 0
        while heap:
            r, i, new = heappop(heap)
            j = after[i]
            # Stale: the left symbol is gone, or the pair has changed since.
            if symbol[i] < 0 or j >= n:
                continue
            hit = get(symbol[i] * base + symbol[j])
            if not hit or hit[0] != r:
                continue
            symbol[i], symbol[j] = new, -1
            k = after[i] = after[j]
            done += 1
            if k < n:
                before[k] = i
                hit = get(new * base + symbol[k])
                if hit:
                    heappush(heap, (hit[0], i, hit[1]))
            p = before[i]
            if p >= 0:
                hit = get(symbol[p] * base + new)
                if hit:
                    heappush(heap, (hit[0], p, hit[1]))
        return done

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None:
            return self._plain(text)
        parts = self.special.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1

    def _plain(self, text: str) -> int:
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        if len(text) <= LONG_TEXT:
            return sum(map(self.known.__getitem__, self.pieces.findall(text)))
        total = 0
        for m in self.pieces.finditer(text):
            total += self.known[m.group()]
            if len(self.known) > CACHE_ENTRIES:
                self.known.clear()
        return total


class Known(dict):
    """Counts of pieces met before; long pieces are not kept."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.owner = merges

    def __missing__(self, piece: str) -> int:
        raw = piece.encode()
        n = len(raw) - self.owner.merges(raw)
        if len(raw) <= 64:
            self[piece] = n
        return n


_LOADED: dict[int, Merges] = {}


def _merges(spec: str) -> Merges:
    """One table per worker process, whatever the number of batches."""
    key = hash(spec)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Merges(spec)
    return _LOADED[key]


def count_tokens(docs: DataFrame, vocabulary: str, text_col: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with the token count of ``text_col`` as the long ``out``.

    ``vocabulary`` is the path of a byte-level BPE tokenizer file.  The driver
    reads it (a vocabulary is a megabyte or two) and ships it with the task,
    so executors need no copy of the file.
    """
    bound_batches(docs)
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    if len(spec) > 64 << 20:
        raise ValueError("the vocabulary file is too large to ship with a task")

    @F.pandas_udf("long")
    def tokens(texts: pd.Series) -> pd.Series:
        count = _merges(spec).count
        return pd.Series(np.fromiter(map(count, texts), np.int64, len(texts)))

    return docs.withColumn(out, tokens(col(text_col)))
