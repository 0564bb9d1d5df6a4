from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm.periodic_runs import (
    PRIME,
    find_runs,
    first_scale,
    inverse,
    periodic_runs,
    text_runs,
    transform,
    zero_mismatch,
)


def brute(w, least=24, repeats=3):
    """Every run, period by period; the smallest period of equal stretches."""
    n, out = len(w), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, repeats * q):
                out.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in out.items())


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    for n in (1, 2, 8, 64, 1024):
        a = rng.integers(0, PRIME, (n, 3), dtype=np.uint64)
        assert (inverse(transform(a.copy())) == a).all()
    a, b = (rng.integers(0, PRIME, (16, 1), dtype=np.uint64) for _ in range(2))
    pad = lambda v: np.concatenate([v, np.zeros_like(v)])
    product = transform(pad(a)) * transform(pad(b)) % np.uint64(PRIME)
    got = inverse(product)[:, 0].tolist()
    for k in range(31):
        want = sum(int(a[i, 0]) * int(b[k - i, 0]) for i in range(16) if 0 <= k - i < 16)
        assert got[k] == want % PRIME


def test_zero_mismatch_equals_comparison():
    rng = np.random.default_rng(2)
    for size in (1, 4, 8, 32):
        x = rng.integers(0, 2, 40 * size, dtype=np.uint64)
        starts = np.arange(0, 36 * size, size)
        got = set(zip(*(v.tolist() for v in zero_mismatch(x, starts, size)), strict=True))
        want = {
            (int(i), d) for i in starts for d in range(1, 2 * size + 1)
            if (x[i : i + size] == x[i + d : i + d + size]).all()
        }
        assert got == want


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(700):
        k, w = rng.choice([1, 2, 3, 5, 50]), []
        for _ in range(rng.randrange(1, 6)):
            if rng.random() < 0.3:
                w += [rng.randrange(k) for _ in range(rng.randrange(60))]
            else:
                p = [rng.randrange(k + 1) for _ in range(rng.randrange(1, 40))]
                w += (p * rng.randrange(1, 9))[: rng.randrange(1, 200)]
        least, repeats = rng.choice([(24, 3), (24, 3), (6, 3), (10, 4), (3, 3)])
        got = find_runs(np.array(w, np.int64), len(w), least, repeats) if w else []
        assert got == brute(w, least, repeats), w


def test_runs_do_not_cross_texts_and_bounds():
    docs = [["x"] * 23, ["x"] * 24, ["x"] * 23, [], "a b c".split() * 8, list("abcdefghij") * 3]
    got = [r for r, _ in text_runs([" ".join(w).encode() for w in docs])]
    assert got == [[], [(0, 24, 1)], [], [], [(0, 24, 3)], [(0, 30, 10)]]
    # A tail of the tenth period short of three, and words that differ in case only.
    assert next(text_runs([" ".join((list("abcdefghij") * 3)[:29]).encode()]))[0] == []
    assert next(text_runs([b"A a " * 11 + b"A A " * 1]))[0] == []
    with pytest.raises(ValueError):
        first_scale(24, 2)


def test_long_texts():
    n = 300_000
    assert next(text_runs([b"long " * n]))[0] == [(0, n, 1)]
    text = b" ".join(b"%d" % (i % (n // 3)) for i in range(n))
    assert next(text_runs([text])) == (
        [(0, n, n // 3)], b" ".join(b"%d" % i for i in range(n // 3))
    )


def test_operator_cases(make_docs, awkward):
    rows = [*awkward, (20, "go " * 30 + "end", "a"), (20, "go " * 30 + "end", "a")]
    docs = make_docs(rows, extra=["Start", "__found"])
    got = periodic_runs(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert [tuple(x) for x in by[20]["runs"]] == [(0, 30, 1)]
    assert by[20]["collapsed"] == "go end" and by[20]["Start"] == "x"
    assert by[2]["runs"] == [] and by[3]["collapsed"] == "" and by[4]["collapsed"] == ""
    assert [tuple(x) for x in by[8]["runs"]] == [(1, 30_000, 1)]
    assert by[8]["collapsed"] == "w" * 70_000 + " long"
    assert periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(docs.withColumn("Runs", F.lit(1)))


def test_query_equals_brute_force(spark):
    from sparkmart.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    planted = 0
    for doc, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(w), zlib.crc32(str(doc).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute(w)
        planted += bool(runs)
        dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
        top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert tuple(got[doc]) == (
            doc, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in dropped)),
        )
    assert planted >= 5
