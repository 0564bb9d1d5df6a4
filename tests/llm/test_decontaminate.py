from __future__ import annotations

import random
import re

import pytest

from sparkmart.llm import decontaminate as D


def words_of(text):
    return re.findall(r"[^\x00-\x20!-/:-@\[-`{-~]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(p, t):
    """Least edit distance of p to a stretch of t, by the full table."""
    row = [0] * (len(t) + 1)
    for i, a in enumerate(p):
        new = [i + 1]
        for j, b in enumerate(t):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_myers_is_the_edit_distance():
    rng = random.Random(3)
    for _ in range(1500):
        p = [rng.randrange(4) for _ in range(rng.randrange(1, 90))]
        t = [rng.randrange(4) for _ in range(rng.randrange(0, 40))]
        best, end = D.myers(D.bit_masks(p), len(p), t)
        assert best == brute(p, t)
        assert best == brute(p, t[:end])


@pytest.fixture(scope="module")
def case():
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([3, 7, 12, 25, 40])))) for i in range(30)]
    items += [(100, None), (101, ""), (4, items[4][1])]
    docs = []
    for i in range(400):
        body = rng.choices(vocab, k=rng.randrange(0, 150))
        if i % 3 == 0:
            item = words_of(rng.choice(items[:30])[1])
            for _ in range(rng.randrange(0, 6)):
                at, kind = rng.randrange(len(item)), rng.randrange(3)
                if kind == 0:
                    item[at] = "zzz"
                elif kind == 1:
                    item.insert(at, "yyy")
                elif len(item) > 1:
                    del item[at]
            at = rng.randrange(len(body) + 1)
            body[at:at] = item
        docs.append((i, ", ".join(body).upper() if i % 2 else "\n".join(body), "s"))
    return items, docs


@pytest.mark.parametrize("block", [D.BLOCK_BYTES, 600])
def test_finds_exactly_what_brute_force_finds(spark, make_docs, case, awkward, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    items, docs = case
    docs = docs + [(1000 + (i or 0), t, s) for i, t, s in awkward]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found, name = D.find_leaks(make_docs(docs, extra=("matches",)), bench)
    assert name == "matches_"
    got = sorted((r.doc_id, m.item_id, m.distance) for r in found.collect() for m in r[name])
    want = []
    for i, text, _ in docs:
        for k, item in items:
            p = words_of(item)
            if len(p) >= 5 and (d := brute(p, words_of(text))) <= len(p) // 10:
                want.append((i, k, d))
    assert got == sorted(want) and len(got) > 40
    kept = {r.doc_id for r in D.decontaminate(make_docs(docs), bench).collect()}
    assert kept == {i for i, *_ in docs} - {i for i, *_ in want}


def test_spans_and_empty_tables(spark, make_docs):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    docs = make_docs([(1, "x y " + item.replace("zeta", "oops") + " z", "s")])
    found, _ = D.find_leaks(docs, bench)
    (m,) = found.first().matches
    assert (m.item_id, m.distance, m.start_word, m.end_word) == (7, 1, 2, 12)
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.decontaminate(docs, none).count() == 1
    assert D.find_leaks(make_docs([]), bench)[0].count() == 0


def test_long_text_is_searched_whole(spark, make_docs):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    filler = "lorem ipsum dolor " * 150_000
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    found, _ = D.find_leaks(make_docs([(1, filler + item, "s"), (2, filler, "s")]), bench)
    assert {r.doc_id: len(r.matches) for r in found.collect()} == {1: 1, 2: 0}
