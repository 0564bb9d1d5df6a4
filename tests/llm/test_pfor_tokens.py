from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from sparkmart.llm.pfor_tokens import (
    BLOCK,
    Encoder,
    Section,
    Segment,
    encode,
    pack_segment,
    read_range,
    read_tokens,
    write_tokens,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(PATH)
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


def test_sections_come_back():
    rng = np.random.default_rng(1)
    for _ in range(120):
        n = int(rng.integers(0, 700))
        high = int(rng.choice([1, 2, 100, 50_257, 2**32, 2**63]))
        v = rng.integers(0, high, n, dtype=np.uint64)
        if n:
            v[rng.integers(0, n, 3)] = 2**64 - 1  # outliers
        for percentile in (0.01, 0.5, 0.8, 1.0):
            s = Section(encode(v, percentile))
            assert (s.read() == v).all()
            a, b = (int(x) for x in rng.integers(0, n + 1, 2))
            assert (s.read(a, b) == v[a : a + b]).all()


def test_outliers_are_patched_not_packed():
    v = np.full(BLOCK * 100, 7, np.uint64)
    v[1::2] = 10
    plain = len(encode(v))
    v[::BLOCK] = 2**40
    # Five or six bytes a block for its one exception; width stays 2 bits.
    assert len(encode(v)) - plain <= 100 * (1 + 6)
    ids = np.random.default_rng(2).integers(0, 50_257, 1 << 16)
    assert len(encode(ids)) < 2.3 * len(ids)


def test_segment_damage_is_noticed():
    data = pack_segment([1, None, -5], [b"\1\0\0\0", b"", b"\2\0\0\0\3\0\0\0"], 0.8)
    got = Segment(data, "x")
    assert got.doc_ids == [1, None, -5] and got.lengths.tolist() == [1, 0, 2]
    assert got.ids.read().tolist() == [1, 2, 3]
    for i in range(len(data)):
        bad = bytearray(data)
        bad[i] ^= 64
        if 4 <= i < 44:  # counts and sizes in the head
            continue
        with pytest.raises(ValueError):
            Segment(bytes(bad), "x")


def test_units_equal_the_library(library):
    encoder = Encoder(open(PATH, encoding="utf-8").read())
    assert encoder.cuts
    rng = random.Random(5)
    bits = ["1 ", "2", "a'b", "'", "'top", "\nOn", " .", "%%%", "α", "日本", "×", "\n\n", "\r\n"]
    bits += [" ", "  ", "\t", "'s", " 's", " the", "<|endoftext|>", "\x1c", "\x85", "　", "b\n c"]
    for _ in range(3000):
        s = "".join(
            rng.choice([chr(rng.randrange(0xD800)), *bits, *bits]) for _ in range(rng.randrange(30))
        )
        assert encoder.encode([s])[0] == np.array(library(s), "<u4").tobytes(), repr(s)


def test_long_text_equals_the_library(library):
    encoder = Encoder(open(PATH, encoding="utf-8").read())
    for s in ["go far, he said. " * 150_000, "x\n" * 700_000, "ab" * 40_000]:
        assert encoder.encode([s])[0] == np.array(library(s), "<u4").tobytes()


def test_round_trip(spark, make_docs, awkward, library, tmp_path):
    rows = [*awkward, (-3, "before zero", "a"), (6, "<|endoftext|>", "b"), (2**40, "far", "c")]
    docs = make_docs(rows, extra=["start", "ids", "part"])
    manifest = write_tokens(docs, str(tmp_path / "t"), PATH, end_id=2)
    got = read_tokens(manifest).orderBy("start").collect()
    rank = lambda r: (r[0] is not None, r[0] or 0)
    want = sorted(rows, key=rank)
    assert [r["doc_id"] for r in got] == [r[0] for r in want]
    at = 0
    for row, (_, text, _) in zip(got, want, strict=True):
        assert row["start"] == at
        assert np.frombuffer(row["ids"], "<u4").tolist() == [*library(text), 2]
        at += len(row["ids"]) // 4
    assert read_tokens(manifest).agg(F.max("start")).first()[0] < at
    assert read_tokens(write_tokens(docs.limit(0), str(tmp_path / "e"), PATH)).count() == 0


def test_files_roll_and_ranges(spark, library, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    manifest = write_tokens(docs, str(tmp_path / "t"), PATH, end_id=2, roll_ids=1)
    files = manifest.orderBy("part", "seq").collect()
    assert sum(f["documents"] for f in files) == docs.count()
    stream = []
    for r in docs.orderBy("doc_id").collect():
        stream += [*library(r["text"]), 2]
    for f in files:
        own = stream[f["start"] : f["start"] + f["ids"]]
        assert read_range(f["file"], 0, f["ids"]).tolist() == own
        assert read_range(f["file"], 130, 300).tolist() == own[130:430]
        assert read_range(f["file"], f["ids"] - 1, 10).tolist() == own[-1:]
    with open(files[0]["file"], "r+b") as f:
        f.truncate(100)
    with pytest.raises(ValueError, match="not a whole token file"):
        read_range(files[0]["file"], 0, 1)


def test_query_equals_the_library(spark, library):
    from sparkmart.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_pfor_tokens"](spark, sf).collect()}
    at = 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = [*library(r["text"]), 2]
        assert got.pop(r["doc_id"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert not got
