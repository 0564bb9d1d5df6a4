from __future__ import annotations

import gzip
import hashlib
import json
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkmart.llm import warc as W

SCHEMA = "page_id long, url string, html string, digest string"


def page_rows():
    same = "<p>" + "x" * 200
    rows = [(i, f"http://h/{i}", f"<html>{i} é" + "y" * (i * 7)) for i in range(40)]
    rows += [(100, "http://a", same), (90, "http://b", same), (95, None, same), (90, "http://b", same)]
    rows += [(50, "u", "short"), (51, "u", "short"), (52, "u\r\nX: y", None), (53, "u", "")]
    rows += [(60, "u", "z" * 3_000_000), (61, "u", "a\r\n\r\nWARC/1.1\r\n\r\n" * 30)]
    rows += [(None, "u", "nobody"), (70, "u", "e" * 99), (71, "u", "e" * 99), (72, "u", "f" * 100), (73, "u", "f" * 100)]
    return [(*r, "clash") for r in rows]


def test_round_trip(spark, tmp_path):
    rows = page_rows()
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = W.archive_pages(pages).withColumn("page", W.page_of(F.col("record_id"))).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, html, _ in rows:
        raw = (html or "").encode()
        if len(raw) >= 100:
            first[raw] = min(first.get(raw, i), i)
    want = Counter()
    for i, _, html, _ in rows:
        raw = (html or "").encode()
        ref = first.get(raw, i)
        want[(i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if ref == i else "revisit",
              None if ref == i else f"<urn:page:{ref}>")] += 1
    assert Counter((r.page, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    for r in got:
        if r.record_type == "response":
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest
    assert {r.page: r.target_uri for r in got}[52] == "u%0D%0AX:%20y"
    assert {r.page: r.target_uri for r in got}[95] is None


def test_members_index_and_sidecar(spark, tmp_path):
    pages = spark.createDataFrame(page_rows(), SCHEMA).coalesce(1)
    files = W.write_archives(W.mark_revisits(pages).coalesce(1), f"file://{tmp_path}/in")
    (f,) = files.collect()
    raw = open(f.archive.removeprefix("file://"), "rb").read()
    whole = zlib.decompressobj(31)
    plain = whole.decompress(raw)
    assert whole.eof and not whole.unused_data and len(plain) == f.bytes  # one member
    index = W.normalise(files, f"file://{tmp_path}/out").orderBy("offset").collect()
    assert len(index) == f.records
    new = open(index[0].archive.removeprefix("file://"), "rb").read()
    assert gzip.decompress(new) == plain
    at = 0
    for r in index:
        assert r.offset == at
        one = zlib.decompressobj(31)
        assert one.decompress(new[at : at + r.length]).startswith(b"WARC/1.1\r\n")
        assert one.eof and not one.unused_data
        at += r.length
    assert at == len(new)
    side = index[0].archive.removeprefix("file://").replace(".warc.gz", ".idx")
    assert [(x["offset"], x["length"]) for x in map(json.loads, open(side))] == [(r.offset, r.length) for r in index]


def test_rolls_and_many_members(spark, tmp_path):
    pages = spark.createDataFrame(page_rows(), SCHEMA).coalesce(1)
    files = W.write_archives(
        W.mark_revisits(pages).coalesce(1), f"{tmp_path}/in", monolithic=False, roll_bytes=2000
    )
    assert files.count() > 3
    index = W.normalise(files, f"{tmp_path}/out")
    assert W.read_records(index, with_payload=False).count() == len(page_rows())


@pytest.mark.parametrize("damage", ["cut", "junk"])
def test_damaged_archives_are_named(spark, tmp_path, damage):
    record = b"".join(W.record_parts(1, "u", b"x" * 5000, "0", None, "d"))
    raw = gzip.compress(record)[:-20] if damage == "cut" else gzip.compress(b"no record\r\n\r\n" + record)
    (tmp_path / "bad.warc.gz").write_bytes(raw)
    names = spark.createDataFrame([(f"{tmp_path}/bad.warc.gz",)], "archive string")
    with pytest.raises(Exception, match="bad.warc.gz"):
        W.normalise(names, f"{tmp_path}/out")


def test_empty(spark):
    assert W.archive_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_null_id_that_repeats_a_payload_and_a_long_url(spark):
    from sparkmart.llm.warc import archive_pages, page_of

    body = "<p>" + "x" * 200
    rows = [(1, "http://a", body), (None, "http://b", body), (None, "http://c", "y" * 300),
            (2, "http://d/" + "e" * (2 << 20), "z" * 150)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = archive_pages(pages, with_payload=False)
    found = sorted(
        (r["target_uri"][:8], r["record_type"], r["to"], r["payload_bytes"], r["payload"])
        for r in got.withColumn("to", page_of(got["refers_to"])).collect()
    )
    assert found == [("http://a", "response", None, 203, None), ("http://b", "revisit", 1, 203, None),
                     ("http://c", "response", None, 300, None), ("http://d", "response", None, 150, None)]
