"""The hash forest against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartweave.llm import ann_forest, queries
from chartweave.llm.ann_forest import nearest

DATA = "/root/testdata/sf0.01"
DDL = "vec_id LONG, embedding ARRAY<FLOAT>, norm STRING, tree INT"


def _brute(rows, k, asks):
    good = {
        i: np.array(v, float) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    out = {}
    for q, vector in good.items():
        if asks(q):
            scores = sorted((-(v * vector).sum(), i) for i, v in good.items() if i != q and len(v) == len(vector))
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def _rows(n: int, seed: int = 1, spread: float = 0.3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, 24))
    vectors = centres[rng.integers(0, 12, n)] + spread * rng.standard_normal((n, 24))
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]


def _recall(got, want):
    hit = sum(len({i for i, _ in want[q]} & {r.vec_id for r in got if r.query_id == q}) for q in want)
    return hit / sum(map(len, want.values()))


@pytest.mark.parametrize("shard_rows", [8192, 150])
def test_clustered_vectors(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(ann_forest, "SHARD_ROWS", shard_rows)
    rows = _rows(1500)
    rows += [(2000 + i, rows[40][1]) for i in range(700)]  # a hot vector
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], DDL).repartition(3)
    got = nearest(table, F.col("vec_id") % 20 == 0, 10).collect()
    want = _brute(rows, 10, lambda i: i % 20 == 0)
    assert {r.query_id for r in got} == set(want)
    assert _recall(got, want) >= 0.95
    vectors = {i: np.array(v, float) for i, v in rows}
    for q in list(want)[:20]:
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        assert all(m[2] == pytest.approx(float(vectors[m[1]] @ vectors[q]), abs=1e-12) for m in mine)
    tied = [r.vec_id for r in sorted((r for r in got if r.query_id == 40), key=lambda r: r.rank)]
    assert tied == [i for i, _ in want[40]]


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (20, None), (40, [0.0, 0.0]), (60, [1.0, None]), (80, [float("nan"), 1.0]), (None, [1.0, 1.0]),
        (1, [2.0, 0.5]), (2, [float("inf"), 1.0]), (3, [-1.0, 0.25]), (4, [1.0, 2.0, 3.0]), (100, [1.0, 2.0, 3.0]), (120, []),
        (3, [-1.0, 0.25]),
    ]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], DDL)
    got = nearest(table, F.col("vec_id") % 20 == 0, 5).collect()
    want = _brute(dict(rows).items(), 5, lambda i: i % 20 == 0)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(
        (q, n + 1, i, s) for q, found in want.items() for n, (i, s) in enumerate(found)
    )
    assert nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_blocks_of_queries_give_the_same_rows(spark, monkeypatch):
    table = spark.createDataFrame([(*r, "x", 1) for r in _rows(900)], DDL).repartition(3)
    whole = sorted(map(tuple, nearest(table, F.col("vec_id") % 5 == 0, 10).collect()))
    monkeypatch.setattr(ann_forest, "QUERY_ROWS", 7)
    assert sorted(map(tuple, nearest(table, F.col("vec_id") % 5 == 0, 10).collect())) == whole


@pytest.mark.parametrize("spread, most", [(0.1, 0.6), (3.0, 1.0)])
def test_no_row_is_scored_by_two_trees(spark, spread, most):
    n = 6000
    rows = _rows(n, spread=spread)
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], DDL).repartition(3)
    got = nearest(table, F.col("vec_id") % 50 == 0, 10).collect()
    assert _recall(got, _brute(rows, 10, lambda i: i % 50 == 0)) >= 0.9
    first = ann_forest.TREES * 2 * ann_forest.LEAF  # of the first visit, at most
    scored = {r.query_id: r.n_scored for r in got}
    assert max(scored.values()) <= n + first and sum(scored.values()) / len(scored) < most * n


def test_query_recall(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = _brute(random.sample(rows, len(rows)), 20, lambda i: i % 20 == 0)
    assert _recall(queries.op4_hash_forest(spark, DATA).collect(), want) >= 0.9


