from __future__ import annotations

import random

import pytest


@pytest.fixture()
def documents(spark):
    """Rows of (doc_id, text) as a table that also has columns whose names the operators use inside."""

    def make(rows, partitions: int = 3):
        full = [(i, t, "x", 1, None) for i, t in rows]
        ddl = "doc_id BIGINT, text STRING, id STRING, n_words INT, block STRING"
        return spark.createDataFrame(full, ddl).repartition(partitions)

    return make


WORDS = "alpha Beta gamma delta, epsilon zeta. eta theta iota kappa été straße 数据 x 42".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return "".join(rng.choice(WORDS) + rng.choice([" ", " ", "  ", "\n"]) for _ in range(n))


def collected(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*(columns or frame.columns)).collect()), key=repr)
