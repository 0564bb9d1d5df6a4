"""Each stage of the pipeline against a brute-force version, at sf0.001."""

from __future__ import annotations

import os
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as P
from sparkmart.adapter import table

from test_decontaminate import brute as edit_brute
from test_decontaminate import words_of
from test_near_dedup import brute as dup_brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    base, docs, out = tmp_path_factory.mktemp("stages"), table(spark, SF, "documents"), []
    for name, stage in P.STAGES:
        result = stage(spark, docs, SF)
        result.write.parquet(f"{base}/{name}")
        after = spark.read.parquet(f"{base}/{name}")
        out.append((name, docs.collect(), after.collect(), docs.columns, after.columns))
        docs = after
    return {name: rest for name, *rest in out}


def test_all_but_the_last_keep_the_columns(stages):
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    for name in list(stages)[:-1]:
        assert stages[name][2] == stages[name][3]


def test_toxicity_keeps_rows_unchanged(stages, spark):
    before, after, *_ = stages["toxicity"]
    assert not Counter(after) - Counter(before)
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert not [i for i in gone if labels.get(i) == 0]


def test_near_duplicates(stages):
    before, after, *_ = stages["near_duplicates"]
    want = dup_brute([(r.doc_id, r.text, r.source) for r in before], 5, 80)
    assert sorted(r.doc_id for r in after) == sorted(i for i, c in want.items() if i == c)


def test_decontamination(stages, spark):
    before, after, *_ = stages["decontamination"]
    items = [words_of(r.text) for r in table(spark, SF, "benchmark").collect()]
    leaks = set()
    for r in before:
        text = words_of(r.text)
        have = set(text)
        for item in items:
            # An item within its error budget shares nine tenths of its words.
            if len(item) >= 5 and sum(w in have for w in item) >= 0.85 * len(item):
                if edit_brute(item, text) <= len(item) // 10:
                    leaks.add(r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if r.doc_id not in leaks)


def test_mixing(stages):
    before, after, *_ = stages["mixing"]
    n = Counter(r.doc_id for r in after)
    assert set(n) <= {r.doc_id for r in before} and max(n.values()) <= 2


def test_sharding(stages):
    before, after, *_ = stages["sharding"]
    assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before)
    slots = defaultdict(list)
    for r in after:
        slots[r.shard].append(r.slot)
        assert r.law == "rows"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(24)]
    assert max(sizes) - min(sizes) <= 1


def test_run_is_the_stages_in_order(spark, stages):
    assert Counter(r.doc_id for r in P.run(spark, SF).collect()) == Counter(
        r.doc_id for r in stages["sharding"][1]
    )
