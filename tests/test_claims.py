"""Several writers at once: files that only one of them can create, and the ledger on top of them."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest

from chartweave.plans import claims
from chartweave.plans.jobs import ingest, transform
from chartweave.plans.ledger import Ledger
from chartweave.sources.layers import Lake, read_bronze
from conftest import rows


def at_once(n, work):
    """The results of ``n`` calls that start together."""
    start = Barrier(n)

    def run(i):
        start.wait()
        return work(i)

    with ThreadPoolExecutor(n) as pool:
        return list(pool.map(run, range(n)))


def test_one_writer_wins(spark, tmp_path):
    path = str(tmp_path / "new folder" / "claim")
    won = at_once(12, lambda i: claims.publish(spark, path, f"text of {i}"))
    assert sum(won) == 1
    assert claims.text_of(spark, path) == f"text of {won.index(True)}"
    assert list(claims.names(spark, str(tmp_path / "new folder"))) == ["claim"]
    assert claims.names(spark, str(tmp_path / "none")) == {}


def test_other_file_systems_rename(spark, tmp_path, monkeypatch):
    """The way of distributed file systems, tried on a local folder."""
    monkeypatch.setattr(claims, "_is_local", lambda files: False)
    path = str(tmp_path / "claim")
    assert claims.publish(spark, path, "é first") and claims.text_of(spark, path) == "é first"


def test_load_numbers_are_taken_once(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    ledger.record("gold", 7, "old")  # a load from before there were numbers
    numbers = at_once(8, lambda i: ledger.load_number(i % 4, "s"))
    assert numbers[:4] == numbers[4:] and len(set(numbers[:4])) == 4 and min(numbers) > 1
    later = ledger.next_load()
    assert later > max(numbers) and ledger.next_load() > later
    assert [ledger.load_number(i, "s") for i in range(4)] == numbers[:4]


def test_planned_folders_go_to_one_batch(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    ledger.read("bronze")
    names = [f"f{i}" for i in range(10)]

    def choose(taken):
        gone = {row["outer"] for row in taken.select("outer").collect()}
        return [n for n in names if n not in gone][:3]

    plans = at_once(4, lambda _: ledger.claim_folders("local", choose))
    assert sorted(p[0] for p in plans) == [0, 1, 2, 3]
    assert sorted(n for _, outer in plans for n in outer) == names
    assert ledger.claim_folders("local", choose) is None  # all are in someone's hands
    assert Ledger(spark, str(tmp_path), lease_hours=0).claim_folders("local", choose)[0] == 0


def test_the_loser_of_a_race_takes_the_next_id(spark, tmp_path, monkeypatch):
    """Another job plans batch 0 between this one's look at the plans and its own claim."""
    ledger, other = Ledger(spark, str(tmp_path)), Ledger(spark, str(tmp_path))

    def choose(taken):
        if taken.isEmpty():
            assert other.take_folders(0, "local", ["a"]) and other.claim("bronze", 0, "local")
            return ["a"]
        return ["b"]

    assert ledger.claim_folders("local", choose) == (1, ["b"])
    assert rows(ledger.folders("local")) == [(0, "local", "a"), (1, "local", "b")]


def test_work_is_given_back_after_a_failure_only(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    assert ledger.claim("silver", 3, "s") and not ledger.claim("silver", 3, "s")
    with pytest.raises(RuntimeError):
        with ledger.working("silver", 3, "s"):
            raise RuntimeError("lost")
    assert ledger.claim("silver", 3, "s")
    with ledger.working("silver", 3, "s"):
        pass
    assert not Ledger(spark, str(tmp_path), lease_hours=0).claim("silver", 3, "s")  # it is recorded
    assert rows(ledger.read("silver"), "batch_id", "source") == [(3, "s")]


def test_two_jobs_share_the_folders(spark, tmp_path):
    root, lake = tmp_path / "input", Lake(str(tmp_path / "lake"))
    for n in range(6):
        inner = root / f"f{n}" / "000"
        inner.mkdir(parents=True)
        entry = {"resource": {"resourceType": "Patient", "id": f"p{n}"}}
        (inner / "b.json").write_text(json.dumps({"entry": [entry]}))
    done = at_once(3, lambda _: ingest(spark, lake, str(root), folders_per_batch=2))
    assert sorted(done) == [0, 1, 2] and ingest(spark, lake, str(root)) is None
    found = rows(read_bronze(spark, lake, "local"), "batch_id", "data.id")
    assert sorted(i for _, i in found) == [f"p{n}" for n in range(6)]
    assert sorted(at_once(2, lambda _: transform(spark, lake))) in ([0, 1], [0, 2], [1, 2])
