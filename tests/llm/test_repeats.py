"""Substring and byte-run dedup against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from chartweave.llm import queries, repeats
from chartweave.llm.run_index import RunIndex, cut_earlier_bytes
from chartweave.llm.seed_extend import cut_repeated_words

from . import brute
from .conftest import collected, prose

DATA = "/root/testdata/sf0.001"


def _docs():
    rng = random.Random(3)
    passages = [prose(900 + n, rng.randrange(30, 120)) for n in range(5)]
    texts = [None, "", " ", "one", "x " * 36, "y " * 35, "z " * 34, "ab" * 300, "q" * 49, "q" * 50, "q" * 51]
    for n in range(60):
        parts = [prose(n, rng.randrange(80))]
        for _ in range(rng.randrange(3)):
            words = rng.choice(passages).split(" ")
            a = rng.randrange(len(words))
            parts += [" ".join(words[a : a + rng.randrange(90)]), prose(300 + n, rng.randrange(40))]
        texts.append(" ".join(parts))
    near = prose(77, 150).split(" ")
    for n in range(12):
        copy = list(near)
        for _ in range(n // 2):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(99)}"
        texts.append(" ".join(copy))
    texts += [texts[20], texts[20], prose(5, 30_000) + passages[0]]
    rng.shuffle(texts)
    return [*enumerate(texts), (3, texts[3]), (5, texts[30]), (None, texts[21]), (None, texts[40])]


@pytest.mark.parametrize("bucket", [8 << 20, 2000])
def test_repeated_words(documents, monkeypatch, bucket):
    monkeypatch.setattr(repeats, "BUCKET_BYTES", bucket)
    docs = _docs()
    got = cut_repeated_words(documents(docs))
    assert collected(got) == sorted(brute.cut_words(docs), key=repr)


def test_other_windows_and_empty_table(documents):
    docs = _docs()
    got = cut_repeated_words(documents(docs), window=12, seed=5)
    assert collected(got) == sorted(brute.cut_words(docs, 12), key=repr)
    assert cut_repeated_words(documents([])).count() == 0


def test_word_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, gone, brute.sha(kept)) for i, n, gone, kept in brute.cut_words(docs)]
    assert collected(queries.op7_seed_extend(spark, DATA)) == sorted(want, key=repr)




@pytest.mark.parametrize("bucket", [8 << 20, 2000])
def test_earlier_bytes(documents, monkeypatch, bucket):
    monkeypatch.setattr(repeats, "BUCKET_BYTES", bucket)
    docs = _docs()
    got = [(i, n, gone, spans, bytes(kept)) for i, n, gone, spans, kept in collected(cut_earlier_bytes(documents(docs)))]
    assert sorted(got, key=repr) == sorted(brute.cut_bytes(docs), key=repr)


def test_earlier_bytes_of_other_length_and_empty_table(documents):
    docs = _docs()
    got = [tuple(r[:4]) for r in collected(cut_earlier_bytes(documents(docs), window=20, anchor=7))]
    assert sorted(got, key=repr) == sorted((r[:4] for r in brute.cut_bytes(docs, 20)), key=repr)
    assert cut_earlier_bytes(documents([])).count() == 0


def test_byte_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*r[:4], brute.sha(r[4])) for r in brute.cut_bytes(docs)]
    assert collected(queries.op1_run_index(spark, DATA)) == sorted(want, key=repr)


@pytest.mark.parametrize("earlier", [True, False])
def test_fragments_settle_on_all_bits_of_their_content(monkeypatch, earlier):
    class LowBits(repeats.RangeHash):
        def __call__(self, start, end):
            return super().__call__(start, end) & np.uint64((1 << 24) - 1)

    monkeypatch.setattr(repeats, "RangeHash", LowBits)
    phrase = b"The same frequent phrase of many documents. "
    texts = [b"%03d " % (n * 7) * 10 + phrase + b" %03d" % (n * 11) * 10 for n in range(40)]
    columns = {
        "block": pa.array([0]), "ids": pa.array([list(range(40))]), "ends": pa.array([np.cumsum([len(t) for t in texts]).tolist()]),
        "body": pa.array([zstandard.compress(b"".join(texts))]),
    }
    rule = repeats.Rule(words=False, size=50, span=20, earlier=earlier)
    rows = [r for b in repeats._fragment_rows(rule, 1)([pa.record_batch(columns)]) for r in b.to_pylist()]
    block = repeats.Block(pa.record_batch(columns), 0, rule)
    known = {}
    for doc, text in enumerate(texts):
        for k in range(len(text) - 49):
            known.setdefault(text[k : k + 50], []).append(doc)
    for row in rows:
        if row["kind"] == repeats.DONE:
            for first, count in zip(*repeats.unpacked(row["data"], 2)):
                for at in range(first, first + count):
                    copies = known[block.raw[at : at + 50].tobytes()]
                    assert min(copies) < block.owner(np.array([at]))[0] if earlier else len(copies) > 1


def test_index_gives_first_documents():
    rng = random.Random(1)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 40))).encode() for _ in range(60)]
    docs = np.sort(np.array([rng.randrange(20) for _ in strings]))
    lengths = np.array([len(s) for s in strings])
    index = RunIndex(np.frombuffer(b"".join(strings), np.uint8), lengths, docs, 9)
    seen = 0
    for which, distance, first in index.stream(lengths):
        for n, doc in zip(which.tolist(), first.tolist()):
            string = strings[n][len(strings[n]) - distance :][:9]
            assert doc == min(d for s, d in zip(strings, docs) if string in s)
            seen += 1
    assert seen == sum(max(0, len(s) - 8) for s in strings)
    assert len(index.starts) < len(index.run_of)
