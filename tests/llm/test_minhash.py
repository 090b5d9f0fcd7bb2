"""Near-duplicates against all pairs."""

from __future__ import annotations

import random

import pytest

from chartweave.llm import minhash, queries
from chartweave.llm.components import components
from chartweave.llm.minhash import match_threshold, near_duplicates

from . import brute
from .conftest import collected, prose

DATA = "/root/testdata/sf0.001"


def _family(seed: int, copies: int, words: int, edits: int, chain: bool):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out, last = [], base
    for _ in range(copies):
        text = list(last if chain else base)
        for _ in range(edits):
            text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(text))
        last = text
    return out


def _docs():
    texts = [None, "", "  \n", "one", "One", "one two", "one two three", "A b\tc d", "a B c\x0bd", "x " * 30_000]
    texts += _family(1, 12, 200, 2, True) + _family(2, 12, 150, 3, False) + _family(3, 10, 60, 1, True)
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{passage} {prose(n, 50)}" for n in range(12)]
    texts += [texts[12], texts[12], texts[30]]
    random.Random(4).shuffle(texts)
    return [*enumerate(texts), (3, texts[3]), (None, texts[5]), (None, texts[5])]


@pytest.mark.parametrize("group,part", [(4096, 2048), (4, 5)])
def test_components_of_near_copies(spark, documents, monkeypatch, group, part):
    monkeypatch.setattr(minhash, "GROUP", group)
    monkeypatch.setattr(minhash, "PART", part)
    docs = _docs()
    got = near_duplicates(documents(docs), shingle=3, similarity=(85, 100))
    assert collected(got) == sorted(brute.near_components(docs), key=repr)


def test_other_shingles_and_empty_table(documents):
    docs = _docs()
    got = near_duplicates(documents(docs))
    assert collected(got) == sorted(brute.near_components(docs, 5, 80), key=repr)
    assert near_duplicates(documents([])).count() == 0


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    assert collected(queries.op3_minhash(spark, DATA)) == sorted(brute.near_components(docs), key=repr)


def test_match_threshold():
    assert match_threshold(64, 0.85) == 41 or 38 <= match_threshold(64, 0.85) <= 44
    assert match_threshold(64, 1.0) == 64


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(links, "a LONG, b LONG")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
