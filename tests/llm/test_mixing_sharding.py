from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest

from sparkmart.llm.mixing import mix, plan_copies, source_targets
from sparkmart.llm.sharding import interleave_shards



def brute_targets(sizes, weights=(5, 2, 1), budget=1.5, stop=2.0):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), budget * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > stop * sizes[s]}
        if not full:
            target |= {s: level * w[s] for s in open_}
            break
        target |= {s: stop * sizes[s] for s in full}
        left -= sum(stop * sizes[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100, None: 50},
        {"a": 1, "b": 1000, "c": 7, "d": 0, "é": 300},
        {"only": 12},
        {"a": 0, "b": 0},
        {"a": 10, "b": 10},
    ],
)
def test_targets_equal_repeated_resharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mix_counts_and_awkward_rows(spark, make_docs, awkward):
    docs = make_docs(awkward, extra=("size", "copies", "rate"))
    planned, names = plan_copies(docs)
    rows = planned.collect()
    assert len(rows) == len(awkward)
    for r in rows:
        assert r[names["size"]] == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert 0 <= r[names["copies"]] <= 2
    again = Counter((r.doc_id, r[names["copies"]]) for r in plan_copies(docs)[0].collect())
    assert again == Counter((r.doc_id, r[names["copies"]]) for r in rows)
    out = mix(docs)
    assert out.columns == docs.columns
    emitted = Counter(r.doc_id for r in out.collect())
    want = Counter()
    for r in rows:
        want[r.doc_id] += r[names["copies"]]
    assert emitted == +want


def test_mix_meets_targets(make_docs):
    docs = make_docs([(i, "w " * (1 + i % 9), f"s{i % 3}" if i % 5 else "hot") for i in range(6000)])
    planned, _ = plan_copies(docs)
    got = planned.groupBy("source").agg({"target": "max", "source_size": "max"}).collect()
    taken = {
        r.source: r.t
        for r in planned.selectExpr("source", "copies * size x").groupBy("source").agg({"x": "sum"})
        .withColumnRenamed("sum(x)", "t").collect()
    }
    for r in got:
        assert taken[r.source] == pytest.approx(r["max(target)"], rel=0.05)


def test_mix_empty(make_docs):
    assert mix(make_docs([])).count() == 0


def test_shards_are_even_gapless_and_proportional(make_docs):
    rows = [(i, f"text {i}", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(2405)]
    out = interleave_shards(make_docs(rows), n_shards=24).collect()
    assert sorted(r.doc_id for r in out) == list(range(2405))
    per = Counter(r.shard for r in out)
    assert set(per) == set(range(24)) and max(per.values()) - min(per.values()) <= 1
    for k, n in per.items():
        assert sorted(r.slot for r in out if r.shard == k) == list(range(n))
    n_src = Counter(s for _, _, s in rows)
    mixed = Counter((r.shard, r.source) for r in out)
    for k in range(24):
        for s, n in n_src.items():
            assert abs(mixed[k, s] - n / 24) <= 2
    for r in out:
        assert r.size == len(f"text {r.doc_id}") + 8
        assert r.text_crc32 == zlib.crc32(f"text {r.doc_id}".encode())
    # brute force: the same order from plain sorting
    import hashlib

    ranked, by = [], {}
    for i, _, s in rows:
        by.setdefault(s, []).append((hashlib.md5(f"shard-1:{i}".encode()).hexdigest(), i))
    for s, xs in by.items():
        ranked += [((j + 0.5) / len(xs), s, j, i) for j, (_, i) in enumerate(sorted(xs))]
    order = [i for *_, i in sorted(ranked)]
    assert [r.doc_id for r in sorted(out, key=lambda r: (r.shard, r.slot))] == order


def test_shards_awkward(make_docs, awkward):
    out = interleave_shards(make_docs(awkward, extra=("shard", "slot"))).collect()
    assert len(out) == len(awkward) and len({(r.shard, r.slot) for r in out}) == len(awkward)
    assert {r.doc_id: r.size for r in out}[3] == 8
    assert interleave_shards(make_docs([])).count() == 0
