from __future__ import annotations

import random
import re

import pytest

from sparkmart.llm.quotations import link_quotations, with_quotes

SCHEMA = "conv_id long, turn long, role string, text string, depth string, hash string"


def link(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    return {(r.conv_id, r.turn): r for r in link_quotations(df).collect()}


def test_nested_levels_announcements_and_order(spark):
    got = link(spark, [
        (1, 0, "a", "Shall we meet?\nI am free on Monday."),
        (1, 1, "b", "On Friday Ann wrote:\n> Shall we   MEET?\n> I am free on Monday.\nYes, at noon."),
        (1, 2, "c", "A new topic altogether"),
        (1, 3, "a", "> > Shall we meet?\n> > I am free on Monday.\n> Yes, at noon.\nFine\n\nSee you"),
        (1, 4, "d", "above\n> a new topic altogether\nbelow"),
        (1, 5, "e", "> I am free on Monday.\n> something never said\nonly one line is known"),
        (1, 6, "f", "> never said by anyone\nhello"),
        (2, 1, "b", "> Shall we meet?\nother conversation"),
    ])
    parent = {k: (r.parent_turn, r.root_turn, r.depth) for k, r in got.items()}
    assert parent == {
        (1, 0): (None, 0, 0), (1, 1): (0, 0, 1), (1, 2): (None, 2, 0), (1, 3): (1, 0, 2),
        (1, 4): (2, 2, 1), (1, 5): (0, 0, 1), (1, 6): (None, 6, 0), (2, 1): (None, 1, 0),
    }
    assert got[1, 1].text == "Yes, at noon." and got[1, 3].text == "Fine\n\nSee you"
    assert got[1, 4].text == "above\nbelow"
    assert (got[1, 3].n_quoted, got[1, 3].n_linked) == (2, 2)
    assert (got[1, 6].n_quoted, got[1, 6].n_linked) == (1, 0)
    order = sorted((r.position, r.turn) for (c, _), r in got.items() if c == 1)
    assert [t for _, t in order] == [0, 1, 3, 5, 2, 4, 6]
    assert [p for p, _ in order] == list(range(7))


def test_awkward_messages(spark):
    rows = [
        (None, 0, "a", "> x\ny"), (1, None, "a", "> x\ny"), (1, 0, None, None), (1, 1, "a", ""),
        (1, 2, "a", ">\n> \n  \nbody"), (1, 3, "a", "> body\nsame"), (1, 3, "b", "> other\nsame"),
        (1, 4, "a", "> same\n>>> deep\n" + "word " * 50_000),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    out = link_quotations(df).collect()
    assert len(out) == len(rows)
    by = {(r.conv_id, r.turn, r.role): r for r in out}
    assert by[1, 3, "a"].parent_turn == by[1, 3, "b"].parent_turn == 2
    assert by[1, 4, "a"].parent_turn == 3 and by[1, 4, "a"].depth == 2
    assert by[1, 0, None].text == "" and by[1, None, "a"].depth == 0
    assert len(by[1, 4, "a"].text) == 250_000
    assert link_quotations(df.limit(0)).count() == 0


def test_long_chain_and_hot_conversation(spark):
    n = 200
    rows = [(7, 0, "u", "message number 0")] + [
        (7, i, "u", f"> message number {i - 1}\nmessage number {i}") for i in range(1, n)
    ]
    got = link(spark, rows)
    assert all(got[7, i].depth == i and got[7, i].root_turn == 0 for i in range(n))
    same = link(spark, [(8, 0, "u", "ok")] + [(8, i, "u", "> ok\nok") for i in range(1, n)])
    assert all(same[8, i].parent_turn == 0 and same[8, i].depth == 1 for i in range(1, n))


@pytest.mark.parametrize("seed", range(2))
def test_round_trip_of_rendered_replies(spark, seed):
    rng = random.Random(seed)
    rows = [
        (c, t, "u", "\n".join(" ".join(rng.choices("alpha beta gamma delta".split(), k=4)) + f" {c} {t} {i}"
                              for i in range(rng.randrange(1, 4))))
        for c in range(15) for t in range(rng.randrange(1, 7))
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    sent = with_quotes(df)
    assert sent.columns == df.columns
    texts = {(r.conv_id, r.turn): r.text for r in sent.collect()}
    assert all(len(re.findall(r"(?m)^> ", texts[c, t])) > 0 for c, t, *_ in rows if t > 0)
    got = {(r.conv_id, r.turn): r for r in link_quotations(sent).collect()}
    for c, t, _, text in rows:
        r = got[c, t]
        assert r.text == text and r.parent_turn == (t - 1 if t else None) and r.depth == t
        assert r.position == t and r.n_linked == r.n_quoted == min(t, 2)
