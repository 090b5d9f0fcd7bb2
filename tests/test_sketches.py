"""Merged profiles against a rescan of all rows, within the stated errors."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest

from chartweave.operators.sketches import merge_profiles, profile_batch, profile_report
from chartweave.plans.profiles import read_profile, update_profiles
from chartweave.sinks.layers import write_detail
from chartweave.sources.layers import Lake

DDL = "id STRING, code STRING, amount DOUBLE, day DATE, tags ARRAY<STRING>, none STRING"


def batch(seed, n):
    rng = random.Random(seed)
    codes = [f"c{min(int(rng.paretovariate(0.8)), 5000)}" for _ in range(n)]
    start = dt.date(2020, 1, 1)
    return [
        (
            f"{seed}-{i}",
            codes[i] if rng.random() < 0.9 else None,
            rng.gauss(10 * seed, 5) if rng.random() < 0.8 else None,
            start + dt.timedelta(days=rng.randrange(400)),
            [rng.choice("ab")],
            None,
        )
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def profiles(spark):
    batches = [batch(seed, 3000) for seed in range(5)] + [[]]
    frames = [profile_batch(spark.createDataFrame(rows, DDL), top=20) for rows in batches]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    report = profile_report(merge_profiles(merged, top=20), (0.1, 0.5, 0.9))
    return [row for rows in batches for row in rows], {r.column_name: r for r in report.collect()}


def test_counts_are_exact(profiles):
    rows, found = profiles
    for place, name in enumerate(["id", "code", "amount", "day", "tags", "none"]):
        assert found[name].n_rows == len(rows)
        assert found[name].n_values == sum(row[place] is not None for row in rows)
    assert found["amount"].data_type == "double" and found["tags"].data_type == "array<string>"


def test_distinct_values_within_the_error(profiles):
    rows, found = profiles
    for place, name in enumerate(["id", "code", "amount", "day"]):
        real = len({row[place] for row in rows if row[place] is not None})
        assert abs(found[name].n_distinct - real) <= 0.05 * real, name
    assert (found["tags"].n_distinct, found["none"].n_distinct) == (2, 0)


def test_quantiles_within_the_error(profiles):
    rows, found = profiles
    for place, name in ((2, "amount"), (3, "day")):
        values = sorted((v - dt.date(1970, 1, 1)).days if name == "day" else v for v in (r[place] for r in rows) if v is not None)
        for asked, got in zip((0.1, 0.5, 0.9), found[name].quantiles):
            below = sum(v <= got for v in values) / len(values)
            assert abs(below - asked) <= 0.02, (name, asked, below)
    assert found["id"].quantiles is None and found["none"].quantiles is None


def test_frequent_values_within_the_cut(profiles):
    rows, found = profiles
    for place, name in ((1, "code"), (0, "id")):
        real, listed = Counter(row[place] for row in rows if row[place] is not None), found[name]
        assert len(listed.frequent) == 20
        for value, n in listed.frequent:
            assert real[value] - listed.cut <= n <= real[value]
        assert {v for v, n in real.items() if n > listed.cut} <= {v for v, _ in listed.frequent}
    assert [tuple(f) for f in found["tags"].frequent] != [] and found["tags"].cut == 0
    assert sum(f.n for f in found["tags"].frequent) == len(rows)


def test_only_new_batches_are_profiled(spark, tmp_path):
    lake, profiles = Lake(str(tmp_path)), str(tmp_path / "profiles")
    for batch_id in range(2):
        write_detail(spark.createDataFrame(batch(batch_id, 50), DDL), lake, "t", "s", batch_id)
    assert update_profiles(spark, lake.detail("t"), profiles) == 2
    write_detail(spark.createDataFrame(batch(7, 30), DDL), lake, "t", "u", 0)
    assert update_profiles(spark, lake.detail("t"), profiles) == 1
    assert update_profiles(spark, lake.detail("t"), profiles) == 0
    found = {r.column_name: r for r in read_profile(spark, profiles).collect()}
    assert found["id"].n_rows == 130 and set(found) == {"id", "code", "amount", "day", "tags", "none"}
    assert all("profiles" in f for f in read_profile(spark, profiles).inputFiles())
