"""Periodic runs against a scan of every period, and the query against a plain version of its contract."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from chartweave.llm import periodic_runs
from chartweave.llm.periodic_runs import collapse_runs, runs_of
from chartweave.llm.runs_query import op12_periodic_runs

from .conftest import collected

DATA = "/root/testdata/sf0.001"


def plain_runs(words, exponent=4, shortest=6):
    found: dict = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(shortest, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_report(words):
    runs = plain_runs(words)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    return len(runs), *best, milli, lines, " ".join(w for i, w in enumerate(words) if i not in gone)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("exponent", [2, 3, 4, 7])
def test_runs_equal_a_scan_of_every_period(exponent):
    rng = random.Random(exponent)
    for _ in range(400):
        texts = []
        for _ in range(rng.randrange(1, 6)):
            n, k = rng.choice([0, 1, 5, 6, 7, 20, 60, 200]), rng.choice([1, 2, 2, 3, 5])
            words = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.5:
                a, p = rng.randrange(n), rng.randrange(1, n + 1)
                words = [words[i if i < a else a + (i - a) % p % (n - a)] for i in range(n)]
            texts.append(words)
        assert runs_of(texts, exponent) == [plain_runs(t, exponent) for t in texts]


def test_long_periods_and_long_runs():
    rng = random.Random(3)
    period = [rng.randrange(5) for _ in range(997)]
    words = [9] * 50 + period * 5 + period[:400] + [7] * 20001
    assert runs_of([words, ["a"] * 30000]) == [[(0, 50, 1), (50, 5 * 997 + 400, 997), (50 + 5 * 997 + 400, 20001, 1)], [(0, 30000, 1)]]


def test_colliding_names_are_noticed(monkeypatch):
    real, words = periodic_runs._scrambled, [1, 2, 3, 4] * 6 + list(range(30))
    monkeypatch.setattr(periodic_runs, "_scrambled", lambda v, seed: real(v, seed) if seed > 3 else v * 0)
    assert runs_of([words]) == [[(0, 24, 4)]]
    with pytest.raises(ValueError):
        runs_of([words], exponent=1)


def test_rows(spark, documents):
    rng = random.Random(8)
    texts = [None, "", " \n\t ", "x", "a " * 6, "ab  cd\n" * 9 + "ab é", "\x1ca\x85b " * 8, "w " * 50_000, "数据 " * 7]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(80))) for _ in range(150)]
    rows = [*enumerate(texts), (None, "q " * 8), (4, "a " * 6), (4, "a " * 6)]
    found = collapse_runs(documents(rows))
    got = collected(found, "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed")
    want = [(i, *plain_report(re.findall("[^\x20\x09-\x0d]+", t or ""))) for i, t in rows]
    assert got == sorted(want, key=repr)
    assert collapse_runs(documents([])).collect() == []


def test_query_equals_its_contract(spark):
    want = []
    for row in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        words = re.findall("[^\x20\x09-\x0d]+", row.text or "")
        h, n = zlib.crc32(str(row.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        *report, lines, kept = plain_report(words)
        want.append((row.doc_id, *report, sha(lines), sha(kept)))
    got = collected(op12_periodic_runs(spark, DATA))
    assert got == sorted(want, key=repr)
    assert sum(1 for r in got if r[1]) > 5
