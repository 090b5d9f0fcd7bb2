"""Merged rows of keyed tables: equal to a replay of all batches, and read without their history."""

from __future__ import annotations

import random

import pytest

from chartweave.plans.jobs import merge
from chartweave.plans.ledger import Ledger
from chartweave.plans.star import STAR, current_rows
from chartweave.sinks import snapshot
from chartweave.sinks.layers import write_star
from chartweave.sinks.snapshot import merge_batches
from chartweave.sources.layers import Lake, read_batches, read_star
from chartweave.sources.snapshot import Manifest, latest, versions
from conftest import rows

CODES = STAR["dim_condition_code"]  # keeps the first category
FACTS = STAR["fact_encounter"]


def load(spark, lake, table, source, batch_id, number, seed, n=40, keys=25):
    rng = random.Random(seed)
    data = [
        (None if rng.random() < 0.05 else f"k{rng.randrange(keys)}", rng.choice([None, "a", "b", "c"]), rng.choice([None, "x", "y"]))
        for _ in range(n)
    ]
    columns = [table.key, *[c for c in table.columns if c != table.key and table.fields[c].type == "string"][:2]]
    frame = spark.createDataFrame(data, ", ".join(f"{c} STRING" for c in columns))
    rest = [f"CAST(NULL AS {f.type}) AS {c}" for c, f in table.fields.items() if c not in columns]
    write_star(frame.selectExpr("*", *rest).select(*table.columns), lake, table, source, batch_id, number)


def replayed(spark, lake, table):
    return rows(current_rows(read_batches(spark, lake.star(table)), table))


@pytest.mark.parametrize("table", [CODES, FACTS])
def test_any_order_of_merges_equals_the_replay(spark, tmp_path, table):
    rng = random.Random(table.name)
    lake = Lake(str(tmp_path))
    loads = [("local", 0), ("stream", 0), ("local", 1), ("stream", 1), ("local", 4)]
    for number, (source, batch_id) in enumerate(loads, 1):
        load(spark, lake, table, source, batch_id, number, rng.random())
    want = replayed(spark, lake, table)
    assert rows(read_star(spark, lake, table)) == want
    rng.shuffle(loads)
    for upto in range(1, len(loads) + 1):
        merge_batches(spark, lake, table, loads[:upto], first_buckets=4)
        assert rows(read_star(spark, lake, table)) == want
    manifest = latest(spark, lake.merged(table))
    assert manifest.batches == {"local": [[0, 1], [4, 4]], "stream": [[0, 1]]} and manifest.version == 4
    assert sum(manifest.rows.values()) == len(want)
    assert merge_batches(spark, lake, table, loads).version == 4  # nothing left to do


def test_reads_list_merged_rows_and_newer_batches_only(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for batch_id in range(4):
        load(spark, lake, FACTS, "local", batch_id, batch_id + 1, batch_id)
    merge_batches(spark, lake, FACTS, [("local", b) for b in range(3)])
    files = read_star(spark, lake, FACTS).inputFiles()
    assert {f.split("/batch_id=")[1][0] for f in files if "/batch_id=" in f} == {"3"}
    merge_batches(spark, lake, FACTS, [("local", 3)])
    whole = read_star(spark, lake, FACTS)
    assert all("/merged/" in f for f in whole.inputFiles())
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan and "Sort" not in plan


def test_few_newer_rows_do_not_shuffle_the_merged_ones(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for batch_id in range(2):
        load(spark, lake, FACTS, "local", batch_id, batch_id + 1, batch_id)
    merge_batches(spark, lake, FACTS, [("local", 0)])
    frame = read_star(spark, lake, FACTS)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 1


def test_only_touched_buckets_are_written(spark, tmp_path):
    lake = Lake(str(tmp_path))
    load(spark, lake, FACTS, "local", 0, 1, 1, n=400, keys=300)
    load(spark, lake, FACTS, "local", 1, 2, 2, n=2, keys=300)
    first = merge_batches(spark, lake, FACTS, [("local", 0)], first_buckets=32)
    second = merge_batches(spark, lake, FACTS, [("local", 1)])
    moved = [b for b in second.folders if second.folders[b] != first.folders.get(b)]
    assert 1 <= len(moved) <= 2 and len(second.folders) >= 30
    assert rows(read_star(spark, lake, FACTS)) == replayed(spark, lake, FACTS)


def test_buckets_grow_with_the_table(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for batch_id in range(3):
        load(spark, lake, FACTS, "local", batch_id, batch_id + 1, batch_id, n=300, keys=4000)
        manifest = merge_batches(spark, lake, FACTS, [("local", batch_id)], first_buckets=2, rows_per_bucket=40)
    assert manifest.buckets == 16
    assert rows(read_star(spark, lake, FACTS)) == replayed(spark, lake, FACTS)


def test_the_loser_of_two_merges_starts_again(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    for batch_id in range(3):
        load(spark, lake, FACTS, "local", batch_id, batch_id + 1, batch_id)
    real, calls = snapshot.publish, []

    def late(*arguments):
        if not calls:  # another merge publishes while this one writes
            calls.append(1)
            merge_batches(spark, lake, FACTS, [("local", 0), ("local", 1)])
        return real(*arguments)

    monkeypatch.setattr(snapshot, "publish", late)
    assert merge_batches(spark, lake, FACTS, [("local", 0), ("local", 2)]).batches == {"local": [[0, 2]]}
    assert versions(spark, lake.merged(FACTS)) == [0, 1]
    assert rows(read_star(spark, lake, FACTS)) == replayed(spark, lake, FACTS)


def test_old_versions_go_and_a_lost_merge_changes_nothing(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    load(spark, lake, FACTS, "local", 0, 1, 1)
    merge_batches(spark, lake, FACTS, [("local", 0)])
    want = rows(read_star(spark, lake, FACTS))
    monkeypatch.setattr(snapshot, "publish", lambda *_: (_ for _ in ()).throw(ConnectionError("gone")))
    load(spark, lake, FACTS, "local", 1, 2, 2)
    with pytest.raises(ConnectionError):
        merge_batches(spark, lake, FACTS, [("local", 1)])
    monkeypatch.undo()
    after = replayed(spark, lake, FACTS)
    assert rows(read_star(spark, lake, FACTS)) == after != want
    monkeypatch.setattr(snapshot, "UNUSED_HOURS", -1)
    monkeypatch.setattr(snapshot, "KEPT_VERSIONS", 1)
    merge_batches(spark, lake, FACTS, [("local", 1)])
    kept = {place.split("/")[0] for place in latest(spark, lake.merged(FACTS)).folders.values()}
    assert set(p.name for p in (tmp_path / "merged" / FACTS.full_name / "rows").iterdir() if p.is_dir()) == kept
    assert rows(read_star(spark, lake, FACTS)) == after


def test_the_job_merges_recorded_batches(spark, tmp_path):
    lake, ledger = Lake(str(tmp_path)), Ledger(spark, str(tmp_path))
    assert len(merge(spark, lake)) == 17 and latest(spark, lake.merged(FACTS)) is None
    load(spark, lake, FACTS, "local", 0, 1, 1)
    load(spark, lake, FACTS, "local", 1, 2, 2)
    ledger.record("gold", 0, "local")
    merge(spark, lake)
    assert latest(spark, lake.merged(FACTS)).batches == {"local": [[0, 0]]}
    assert rows(read_star(spark, lake, FACTS)) == replayed(spark, lake, FACTS)


def test_manifest_text():
    manifest = Manifest(3, 8, {1: "a/bucket=1"}, {1: 5}, {"s": [[0, 2]]})
    assert Manifest.of(manifest.text()) == manifest
    assert manifest.with_batches([("s", 4), ("s", 3), ("t", 0)]) == {"s": [[0, 4]], "t": [[0, 0]]}
    assert manifest.has("s", 2) and not manifest.has("s", 3) and not manifest.has("t", 0)
