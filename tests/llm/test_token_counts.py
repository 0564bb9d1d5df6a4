from __future__ import annotations

import random

import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from sparkmart.llm.token_counts import Merges, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(PATH)
    return lambda s: len(t.encode(s, add_special_tokens=False).ids)


def test_counts_equal_the_library(library):
    count = Merges(open(PATH, encoding="utf-8").read()).count
    rng = random.Random(5)
    bits = ["a", "  ", "\n", "\t", "'s", "'ll", " the", "<|endoftext|>", "123", "\x1c", "\x85", "!!"]
    for _ in range(400):
        s = "".join(
            rng.choice([chr(rng.randrange(0xD800)), chr(rng.randrange(0xE000, 0x110000)), *bits])
            for _ in range(rng.randrange(80))
        )
        assert count(s) == library(s), s
    for s in ["", "a" * 30_000, "ab" * 9_000, " " * 5_000, "é" * 5_000, "<|endoftext|" * 3, "x<|endoftext|> y"]:
        assert count(s) == library(s)


def test_letters_newer_than_the_library(library):
    count = Merges(open(PATH, encoding="utf-8").read()).count
    from sparkmart.llm.token_counts import NEWER

    for part in NEWER:
        ch = chr(int(part.split("-")[0], 16))
        for s in (f"a{ch}a", f"1{ch}1", f".{ch}.", f" {ch} b"):
            assert count(s) == library(s)


def test_frame(make_docs, awkward, library):
    docs = make_docs(awkward, extra=("n_tokens_", "tokens"))
    out = count_tokens(docs, PATH)
    assert out.columns == [*docs.columns, "n_tokens"]
    for r in out.collect():
        assert r.n_tokens == library(r.text or "")
    assert count_tokens(make_docs([]), PATH).agg(F.count("n_tokens")).first()[0] == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        Merges(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
