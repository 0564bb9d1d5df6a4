from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from sparkmart.llm import near_dedup as N
from sparkmart.llm.common import connected_components, shingle_sets


def shingles(text, k):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, t):
    sets = defaultdict(list)
    for i, text, _ in rows:
        if i is not None:
            sets[i].append(shingles(text, k))
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(
                len(x & y) and 100 * len(x & y) >= t * len(x | y) for x in sets[a] for y in sets[b]
            ):
                ra, rb = root(a), root(b)
                up[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in ids}


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(900)]
    base = [rng.choices(vocab, k=rng.randrange(1, 160)) for _ in range(60)]
    star = rng.choices(vocab, k=150)  # a crowd of edited copies, many too far apart
    hot = rng.choices(vocab, k=40)  # a passage that many documents share
    rows = []
    for i in range(420):
        if i % 3 == 0:
            words = star[:]
            for _ in range(rng.randrange(0, 9)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        elif i % 3 == 1:
            words = hot + rng.choices(vocab, k=rng.randrange(5, 60))
        else:
            words = rng.choice(base)[:]
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
        text = " ".join(words)
        rows.append((1000 - i, text.upper() if i % 5 == 0 else text.replace(" ", "\n", 2), "s"))
    return rows


@pytest.mark.parametrize("few", [N.FEW, 0])
@pytest.mark.parametrize("k", [4, 5])
def test_components_equal_brute_force(make_docs, awkward, monkeypatch, k, few):
    monkeypatch.setattr(N, "FEW", few)  # 0: every open bucket goes through all levels
    rows = corpus(k) + [(None if i is None else 2000 + i, t, s) for i, t, s in awkward]
    docs = make_docs(rows, extra=("component", "kept", "n"))
    got = N.near_duplicates(docs, k=k).collect()
    assert len(got) == len(rows)
    want = brute(rows, k, 80)
    sizes = {i: len(shingles(t, k)) for i, t, _ in rows}
    for r in got:
        if r.id is None:
            assert r.component is None and r.kept
        else:
            assert (r.component, r.kept) == (want[r.id], want[r.id] == r.id)
        assert r.n_shingles == sizes[r.id]
    kept = sorted(r.doc_id or -1 for r in N.deduplicate(docs, k=k).collect())
    assert kept == sorted((i or -1) for i, *_ in rows if i is None or want[i] == i)


def test_empty_table(make_docs):
    assert N.near_duplicates(make_docs([])).count() == 0


def test_register_estimate():
    rng = np.random.default_rng(0)
    errors = []
    for j in (0.5, 0.8, 0.95):
        for _ in range(40):
            n = 4000
            same = int(2 * n * j / (1 + j))
            pool = rng.integers(0, 2**63, 2 * n, dtype=np.uint64) * np.uint64(2)
            a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:same], pool[n : 2 * n - same]]))
            ra, rb = N.registers(a)[None], N.registers(b)[None]
            est, used = N.estimate(ra, rb, np.array([n]), np.array([n]))
            assert used[0] == N.BUCKETS
            errors.append(est[0] - j)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_registers_pack_and_unpack():
    a = N.registers(next(shingle_sets([b"one two three four five six seven"], 3)))
    assert (N.unpacked(N.packed(a)[None])[0] == a).all()


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, i) for i in range(501, 560)] + [(7, 7), (3, 2)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.component for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 500 for i in range(500, 560)}}


def test_pairs_at_the_threshold_in_a_crowd(make_docs):
    """Copies of one text whose only links are pairs of exactly 0.8."""
    rng = random.Random(11)
    star, rows = [f"w{i}" for i in range(139)], []
    for i in range(300):
        # One edit of both, one of the first and two of the second document.
        at = [5 + 6 * x + rng.randrange(2) for x in rng.sample(range(21), 4)]
        first, second = star[:], star[:]
        first[at[0]] = second[at[0]] = f"both{i}"
        first[at[1]], second[at[2]], second[at[3]] = f"a{i}", f"b{i}", f"c{i}"
        rows += [(2 * i, " ".join(first), "s"), (2 * i + 1, " ".join(second), "s")]
    x, y = shingles(rows[0][1], 5), shingles(rows[1][1], 5)
    assert len(x & y) * 100 == 80 * len(x | y)
    got = N.near_duplicates(make_docs(rows), k=5).collect()
    assert {r.id: r.component for r in got} == brute(rows, 5, 80)


def test_an_id_with_several_texts(make_docs):
    a = " ".join(f"a{i}" for i in range(40))
    b = " ".join(f"b{i}" for i in range(40))
    docs = make_docs([(1, b, "s"), (5, a, "s"), (5, b, "s"), (6, a, "s"), (6, a, "s")])
    got = sorted((r["id"], r["component"], r["kept"]) for r in N.near_duplicates(docs).collect())
    assert got == [(1, 1, True), (5, 1, False), (5, 1, False), (6, 1, False), (6, 1, False)]
    kept = sorted((r["doc_id"], r["text"]) for r in N.deduplicate(docs).collect())
    assert kept == [(1, b), (5, a)]  # neither text is lost
