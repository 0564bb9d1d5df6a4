"""Token ids in patched frame-of-reference blocks.

Numbers are coded in blocks of ``BLOCK``: the block's minimum is subtracted, the
rest packed at the width that a chosen percentile of them needs, and the bits
above that width of the few that need more go to the block's exception list
(place and high part).  Block starts are indexed, so a range of ids is read
without decoding what lies before it.

A token file is a sequence of segments of whole documents and a footer::

    segment = head | ids | lengths | document ids | null bits
    head    = magic "PFSG", documents, ids, bytes of each section, crc32 of the sections
    section = number of values | blocks | offset of each block | number of blocks
    footer  = one row a segment (offset, first id, first document) | count | magic "PFTF"

The ids section holds the documents' ids end to end, the lengths section the
number of ids of each, the third the document ids (zigzag) and the last a bit
for each that is null.  All
numbers are little-endian.

:func:`write_tokens` sorts the documents by id with one range shuffle, encodes
each text with the tokenizers library, appends ``end_id`` and writes a file per
task (rolled at ``roll_ids``).  The library is asked once for every distinct
unit of text: there are places where a byte-level tokenizer surely cuts
(:data:`UNIT`), so texts are cut there and units met before are looked up.  Files have names of the task's attempt
and only the manifest that the tasks return names them: a task that is lost and
run again leaves an unnamed file behind, and no duplicate.

Defined cases: a null or empty text is only the end id; texts are encoded
whole, whatever their length (a stretch without such a place is one call); null
document ids come first, rows that repeat an id follow one another, ordered by
a hash of their text; an empty table writes no file; other columns take no
part.  A truncated or damaged file is an error that names it.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import bound_batches, col, materialize
from sparkmart.llm.token_counts import byte_letters
from sparkmart.llm.warc import open_folder

BLOCK = 128
SEGMENT_IDS = 1 << 18  # a segment ends with the document that reaches this many ids
CHUNK_BLOCKS = 1 << 13  # blocks coded at once
UNITS = 600_000  # units of text that a task remembers, twice
PART = 1 << 20  # long texts are encoded in parts of about this many characters
HEAD = "<4sqqqqqI"
ROW = "<qqq"
TAIL = "<q4s"
BLOCK_HEAD = 11  # minimum (8 bytes), width, exceptions, bytes of an exception's high part

_U = np.uint64


# -- codec -------------------------------------------------------------------


def _bit_length(v: np.ndarray) -> np.ndarray:
    """Bits that each number needs."""
    n = np.zeros(v.shape, np.int64)
    v = v.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = v >= _U(1 << step)
        n[big] += step
        v[big] >>= _U(step)
    return n + (v > 0)


def _pack(v: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` numbers as rows of ``BLOCK * width / 8`` bytes."""
    size = -(-width // 8)
    raw = v.astype("<u8").view(np.uint8).reshape(*v.shape, 8)[:, :, :size]
    bits = np.unpackbits(np.ascontiguousarray(raw), axis=2, bitorder="little")[:, :, :width]
    return np.packbits(bits.reshape(len(v), -1), axis=1, bitorder="little")


def _unpack(raw: np.ndarray, width: int) -> np.ndarray:
    size = -(-width // 8)
    bits = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(raw), BLOCK, width)
    full = np.zeros((len(raw), BLOCK, 8), np.uint8)
    full[:, :, :size] = np.packbits(bits, axis=2, bitorder="little")
    return full.view("<u8")[:, :, 0]


def encode(values: np.ndarray, percentile: float = 0.8) -> bytes:
    """``values`` (non-negative integers below 2**64) as a section."""
    values = np.asarray(values).astype(_U)
    n = len(values)
    parts, starts, at = [], [], 0
    step = BLOCK * CHUNK_BLOCKS
    for i in range(0, n, step):
        v = values[i : i + step]
        if len(v) % BLOCK:  # the last block is filled with its last value
            v = np.concatenate([v, np.full(-len(v) % BLOCK, v[-1], _U)])
        data, offsets = _encode_blocks(v.reshape(-1, BLOCK), percentile)
        parts.append(data)
        starts.append(offsets + at)
        at += len(data)
    index = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return b"".join(
        [struct.pack("<q", n), *parts, index.astype("<u8").tobytes(), struct.pack("<q", len(index))]
    )


def _encode_blocks(v: np.ndarray, percentile: float) -> tuple[bytes, np.ndarray]:
    k = len(v)
    low = v.min(axis=1)
    rest = v - low[:, None]
    place = max(0, min(BLOCK, int(np.ceil(percentile * BLOCK))) - 1)
    width = _bit_length(np.partition(rest, place, axis=1)[:, place])
    shift = np.minimum(width, 63).astype(_U)[:, None]
    high = np.where(width[:, None] == 64, _U(0), rest >> shift)
    many = (high > 0).sum(axis=1)
    size = -(-_bit_length(high.max(axis=1)) // 8)
    length = BLOCK_HEAD + BLOCK // 8 * width + many * (1 + size)
    start = np.cumsum(length) - length
    out = np.zeros(int(length.sum()), np.uint8)
    head = np.zeros((k, BLOCK_HEAD), np.uint8)
    head[:, :8] = low.astype("<u8").view(np.uint8).reshape(k, 8)
    head[:, 8], head[:, 9], head[:, 10] = width, many, size
    out[start[:, None] + np.arange(BLOCK_HEAD)] = head
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            here = start[own, None] + (BLOCK_HEAD + np.arange(BLOCK // 8 * w))
            out[here] = _pack(rest[own] & _U((1 << int(w)) - 1), int(w))
    row, cell = np.nonzero(high)
    if len(row):
        first = np.cumsum(many) - many
        nth = np.arange(len(row)) - first[row]
        base = start[row] + BLOCK_HEAD + BLOCK // 8 * width[row]
        out[base + nth] = cell
        raw = high[row, cell].astype("<u8").view(np.uint8).reshape(-1, 8)
        base += many[row] + nth * size[row]
        for b in range(int(size.max())):
            has = size[row] > b
            out[base[has] + b] = raw[has, b]
    return out.tobytes(), start


class Section:
    """A coded section in memory; decodes whole or by range."""

    def __init__(self, data: bytes | memoryview, name: str = "section"):
        self.name = name
        try:
            (self.n,) = struct.unpack_from("<q", data, 0)
            (k,) = struct.unpack_from("<q", data, len(data) - 8)
            if k != -(-self.n // BLOCK) or k < 0 or len(data) < 16 + 8 * k:
                raise ValueError
            self.starts = np.frombuffer(data, "<u8", k, len(data) - 8 - 8 * k).astype(np.int64)
            self.blocks = np.frombuffer(data, np.uint8, len(data) - 16 - 8 * k, 8)
        except (struct.error, ValueError):
            raise ValueError(f"{name}: damaged section") from None

    def read(self, start: int = 0, count: int | None = None) -> np.ndarray:
        """``count`` values from ``start`` on (all, if None); only the blocks
        that hold them are decoded."""
        stop = self.n if count is None else min(self.n, start + count)
        if start >= stop:
            return np.zeros(0, _U)
        first, last = start // BLOCK, -(-stop // BLOCK)
        out = np.empty((last - first) * BLOCK, _U)
        for a in range(first, last, CHUNK_BLOCKS):
            b = min(a + CHUNK_BLOCKS, last)
            out[(a - first) * BLOCK : (b - first) * BLOCK] = self._decode(a, b).ravel()
        return out[start - first * BLOCK : stop - first * BLOCK]

    def _decode(self, a: int, b: int) -> np.ndarray:
        start, data = self.starts[a:b], self.blocks
        try:
            head = data[start[:, None] + np.arange(BLOCK_HEAD)]
            low = np.ascontiguousarray(head[:, :8]).view("<u8")[:, 0]
            width, many, size = (head[:, i].astype(np.int64) for i in (8, 9, 10))
            out = np.zeros((b - a, BLOCK), _U)
            for w in np.unique(width):
                if w:
                    own = np.flatnonzero(width == w)
                    here = start[own, None] + (BLOCK_HEAD + np.arange(BLOCK // 8 * w))
                    out[own] = _unpack(data[here], int(w))
            if many.any():
                row = np.repeat(np.arange(b - a), many)
                nth = np.arange(len(row)) - (np.cumsum(many) - many)[row]
                base = start[row] + BLOCK_HEAD + BLOCK // 8 * width[row]
                cell = data[base + nth].astype(np.int64)
                base += many[row] + nth * size[row]
                high = np.zeros((len(row), 8), np.uint8)
                for i in range(int(size.max())):
                    has = size[row] > i
                    high[has, i] = data[base[has] + i]
                out[row, cell] |= high.view("<u8")[:, 0] << width[row].astype(_U)
        except (IndexError, ValueError):
            raise ValueError(f"{self.name}: damaged block") from None
        return out + low[:, None]


# -- texts to ids ------------------------------------------------------------


# Units of text whose ends are surely cuts of the byte-level pattern: a run of
# Latin letters that an ASCII non-letter follows, digits, ASCII punctuation
# (no apostrophe, which may begin a contraction), one line break before any of
# these, or else all up to the next blank with a letter.
_L = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_P = r"!-&(-/:-@\[-`{-~"
_END = r"|\Z)"
UNIT = re.compile(
    rf" ?[{_L}]+(?=[\x00-@\[-`{{-\x7f]{_END}"
    rf"| ?[{_P}]+(?=[ \t-\r{_L}0-9]{_END}"
    rf"|\n(?=[{_L}{_P}0-9])"
    rf"| ?[0-9]+(?=[ \t-\r{_L}{_P}']{_END}"
    rf"|.(?:(?! [{_L}]).)*",
    re.DOTALL,
)
_CUT = re.compile(f" (?=[{_L}])")
# Units that the pattern leaves whole, so that the library's model may be asked
# for them without its cutting step.
WHOLE = re.compile(rf" ?[{_L}]+| ?[{_P}]+|\n| ?[0-9]+")


class Encoder(dict):
    """The library's ids (as little-endian bytes) of units met before."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        super().__init__()
        data = json.loads(spec)
        pre, added = data.get("pre_tokenizer") or {}, data.get("added_tokens") or []
        #: Texts may be cut only where the tokenizer surely cuts, too.
        self.cuts = (
            pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
            and not data.get("normalizer")
            and not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip"))
            and not any(" " in t["content"] for t in added)
        )
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile(f"({'|'.join(map(re.escape, names))})") if names else None
        self.old: dict[str, bytes] = {}  # the units remembered before the present ones
        self.letters = {b: letter for letter, b in byte_letters().items()}
        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def ask(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, unit: str) -> bytes:
        ids = self.old.get(unit)
        if ids is None:
            if WHOLE.fullmatch(unit):
                raw = unit.encode().decode("latin-1").translate(self.letters)
                got = [t.id for t in self.model.tokenize(raw)]
                ids = struct.pack(f"<{len(got)}I", *got)
            else:
                ids = self.ask(unit)
        if len(unit) <= 64:
            self[unit] = ids
        return ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of whole texts."""
        if not self.cuts:
            return [self.ask(t) if t else b"" for t in texts]
        return [b"".join(map(self._part, _parts(t))) if t else b"" for t in texts]

    def _part(self, text: str) -> bytes:
        if len(self) > UNITS:
            self.old = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, self._units(text)))

    def _units(self, text: str) -> list[str]:
        if self.special is None:
            return UNIT.findall(text)
        parts = self.special.split(text)
        units = UNIT.findall(parts[0])
        for name, part in zip(parts[1::2], parts[2::2], strict=True):
            units += [name, *UNIT.findall(part)]
        return units


def _parts(text: str) -> Iterator[str]:
    """A long text in parts of about ``PART``, cut where it is safe."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + PART)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


_LOADED: dict[int, Encoder] = {}


def _encoder(spec: str) -> Encoder:
    """One tokenizer per worker process, whatever the number of batches."""
    key = hash(spec)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(spec)
    return _LOADED[key]


# -- files -------------------------------------------------------------------


def _zigzag(ids: np.ndarray) -> np.ndarray:
    return ((ids << 1) ^ (ids >> 63)).view(_U)


def _unzigzag(v: np.ndarray) -> np.ndarray:
    return (v >> _U(1)).view(np.int64) ^ -(v & _U(1)).view(np.int64)


def pack_segment(doc_ids: list[int | None], ids: list[bytes], percentile: float) -> bytes:
    """A segment of documents and their ids (little-endian, 4 bytes each)."""
    lengths = np.array([len(x) // 4 for x in ids], np.int64)
    null = np.array([x is None for x in doc_ids])
    sections = [
        encode(np.frombuffer(b"".join(ids), "<u4"), percentile),
        encode(lengths, percentile),
        encode(_zigzag(np.array([x or 0 for x in doc_ids], np.int64)), percentile),
        np.packbits(null, bitorder="little").tobytes(),
    ]
    crc = 0
    for x in sections:
        crc = zlib.crc32(x, crc)
    sizes = [len(x) for x in sections[:3]]
    return struct.pack(HEAD, b"PFSG", len(ids), int(lengths.sum()), *sizes, crc) + b"".join(sections)


class Segment:
    def __init__(self, data: bytes, name: str):
        try:
            magic, self.docs, self.n, *sizes, crc = struct.unpack_from(HEAD, data)
        except struct.error:
            magic = b""
        body = memoryview(data)[struct.calcsize(HEAD) :]
        if magic != b"PFSG" or zlib.crc32(body) != crc:
            raise ValueError(f"{name}: damaged segment")
        a, b, c = np.cumsum(sizes).tolist()
        self.ids = Section(body[:a], name)
        self.lengths = Section(body[a:b], name).read().astype(np.int64)
        known = _unzigzag(Section(body[b:c], name).read()).tolist()
        null = np.unpackbits(np.frombuffer(body[c:], np.uint8), count=self.docs, bitorder="little")
        self.doc_ids = [None if x else i for i, x in zip(known, null, strict=True)]


def _footer(source, name: str) -> list[tuple[int, int, int]]:
    size = source.size()
    try:
        source.seek(size - struct.calcsize(TAIL))
        n, magic = struct.unpack(TAIL, source.read(struct.calcsize(TAIL)))
        if magic != b"PFTF" or n < 0 or n * struct.calcsize(ROW) + struct.calcsize(TAIL) > size:
            raise ValueError
        source.seek(size - struct.calcsize(TAIL) - n * struct.calcsize(ROW))
        rows = list(struct.iter_unpack(ROW, source.read(n * struct.calcsize(ROW))))
    except (struct.error, ValueError, OSError):
        raise ValueError(f"{name}: not a whole token file") from None
    return [*rows, (size - struct.calcsize(TAIL) - n * struct.calcsize(ROW), 0, 0)]


def read_range(uri: str, start: int, count: int) -> np.ndarray:
    """``count`` ids of one file from its id ``start`` on, read by the indexes:
    only the segments and blocks that hold them are decoded."""
    files, path = open_folder(uri)
    out = []
    with files.open_input_file(path) as source:
        rows = _footer(source, uri)
        firsts = [r[1] for r in rows[:-1]]
        i = max(0, int(np.searchsorted(firsts, start, "right")) - 1)
        while count > 0 and i < len(firsts):
            source.seek(rows[i][0])
            segment = Segment(source.read(rows[i + 1][0] - rows[i][0]), uri)
            got = segment.ids.read(start - firsts[i], count)
            out.append(got)
            start, count, i = start + len(got), count - len(got), i + 1
    return np.concatenate([np.zeros(0, _U), *out]).astype(np.uint32)


MANIFEST = "file string, part int, seq int, documents long, ids long, bytes long"
NAMES = [x.split()[0] for x in MANIFEST.split(", ")]


def write_tokens(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int | None = None,
    id_col: str = "doc_id", text_col: str = "text", percentile: float = 0.8,
    roll_ids: int = 64 << 20,
) -> DataFrame:
    """Write the ids of every text in ascending order of ``id_col``; returns
    the manifest, a row a file: ``file, part, seq, documents, ids, bytes`` and
    ``start``, the number of ids in all files before it.

    ``vocabulary`` is the path of a tokenizer file; the driver reads it and
    ships it with the task.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    if len(spec) > 64 << 20:
        raise ValueError("the vocabulary file is too large to ship with a task")
    if not 0 < percentile <= 1:
        raise ValueError("the percentile is a share of a block, above 0 and at most 1")
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        files, root = open_folder(folder)
        encoder = _encoder(spec)
        out = None
        docs_, ids_, held = [], [], 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts), strict=True):
                if out is None:
                    files.create_dir(root, recursive=True)
                    name = f"tokens-{uuid.uuid4().hex}.pfor"
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                    rows, at, n, k = [], 0, 0, 0
                ids_.append(ids + end)
                docs_.append(doc)
                held += len(ids_[-1]) // 4
                if held >= SEGMENT_IDS:
                    at, n, k = flush(out, rows, docs_, ids_, held, at, n, k)
                    docs_, ids_, held = [], [], 0
                    if n >= roll_ids:
                        yield closed(out, rows, name, part, seq, at, n, k)
                        out, seq = None, seq + 1
        if out is not None:
            if docs_:
                at, n, k = flush(out, rows, docs_, ids_, held, at, n, k)
            yield closed(out, rows, name, part, seq, at, n, k)

    def flush(out, rows, docs_, ids_, held, at, n, k) -> tuple[int, int, int]:
        data = pack_segment(docs_, ids_, percentile)
        out.write(data)
        rows.append((at, n, k))
        return at + len(data), n + held, k + len(docs_)

    def closed(out, rows, name, part, seq, at, n, k) -> pa.RecordBatch:
        out.write(b"".join(struct.pack(ROW, *r) for r in rows) + struct.pack(TAIL, len(rows), b"PFTF"))
        out.close()
        size = at + len(rows) * struct.calcsize(ROW) + struct.calcsize(TAIL)
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        values = [f"{folder}/{name}", part, seq, k, n, size]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(values, kinds, strict=True)], NAMES
        )

    bound_batches(docs)
    rows = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(spread, *order).sortWithinPartitions(*order)
    written = materialize(placed.mapInArrow(write, MANIFEST), "token-files")
    # A window without a partition over one row a file.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, ids)`` of every document in the files that
    ``manifest`` lists: ``start`` counts the ids of all documents before it,
    ``ids`` are little-endian unsigned 32-bit numbers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files, path = open_folder(name)
                with files.open_input_file(path) as source:
                    rows = _footer(source, name)
                    for (at, first, _), (stop, *_) in zip(rows, rows[1:], strict=False):
                        source.seek(at)
                        segment = Segment(source.read(stop - at), name)
                        yield from documents(segment, start + first)

    def documents(segment: Segment, start: int) -> Iterator[pa.RecordBatch]:
        raw = segment.ids.read().astype("<u4")
        ends = np.cumsum(segment.lengths)
        i = 0
        while i < segment.docs:  # about 4 MB of ids at once, one document at least
            base = int(ends[i] - segment.lengths[i])
            j = max(i + 1, int(np.searchsorted(ends, base + (1 << 20), "right")))
            offsets = np.concatenate([[base], ends[i:j]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(segment.doc_ids[i:j], pa.int64()),
                    pa.array(start + offsets[:-1], pa.int64()),
                    pa.Array.from_buffers(
                        pa.binary(), j - i,
                        [
                            None,
                            pa.py_buffer(((offsets - base) * 4).astype(np.int32)),
                            pa.py_buffer(np.ascontiguousarray(raw[base : ends[j - 1]])),
                        ],
                    ),
                ],
                ["doc_id", "start", "ids"],
            )
            i = j

    files = manifest.select("file", "start")
    files = files.repartition(max(1, files.count()))  # a file is a task's work
    return files.mapInArrow(read, "doc_id long, start long, ids binary")
