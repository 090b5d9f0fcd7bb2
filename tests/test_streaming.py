from __future__ import annotations

import json

from pyspark.sql import functions as F

from chartweave.plans.details import build
from chartweave.plans.jobs import store_bundles
from chartweave.plans.ledger import Ledger
from chartweave.plans.star import STAR, star_table
from chartweave.sources.bundles import bundle_entries, bundle_rows, read_bundles
from chartweave.sinks.layers import write_star
from chartweave.sources.layers import Lake, read_bronze, read_rejects, read_star
from chartweave.streaming.ingest import bundle_file_stream, ingest_stream, upsert_stream
from conftest import rows


def write(folder, number, status):
    entry = {"resourceType": "Encounter", "id": f"e{number % 3}", "status": status, "type": [{"text": "t", "coding": [{"code": "k"}]}]}
    (folder / f"{number:03d}.json").write_text(json.dumps({"entry": [{"resource": entry}]}, indent=1))


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    folder, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))
    folder.mkdir()
    for n in range(5):
        write(folder, n, f"s{n}")

    def run():
        stream = bundle_file_stream(spark, str(folder), files_per_batch=2)
        ingest_stream(spark, stream, lake, str(tmp_path / "progress"))
        return rows(read_bronze(spark, lake, "stream"), "resource_type", "data.id", "data.status")

    want = rows(bundle_entries(read_bundles(spark, str(folder))), "resource_type", "data.id", "data.status")
    assert run() == want
    assert run() == want
    write(folder, 5, "s5")
    assert len(run()) == 6
    assert rows(Ledger(spark, lake.root).read("bronze"), "batch_id", "source") == [(i, "stream") for i in range(4)]


def test_upserts_keep_the_last_write(spark, tmp_path):
    folder, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))
    folder.mkdir()
    for n in range(3):
        write(folder, n, "first")
    tables = ["fact_encounter", "dim_encounter_type"]

    def run():
        upsert_stream(spark, bundle_file_stream(spark, str(folder)), tables, lake, str(tmp_path / "progress"))

    run()
    write(folder, 4, "second")
    run()
    got = rows(read_star(spark, lake, "fact_encounter"), "encounter_key", "encounter_status")
    assert got == [("e0", "first"), ("e1", "second"), ("e2", "first")]
    assert rows(read_star(spark, lake, "dim_encounter_type")) == [("k", "t")]


def test_star_of_a_stream_batch_matches_the_batch_plan(spark, tmp_path):
    folder, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))
    folder.mkdir()
    for n in range(7):
        write(folder, n, f"s{n}")
    upsert_stream(spark, bundle_file_stream(spark, str(folder)), ["fact_encounter"], lake, str(tmp_path / "p"))
    bronze = bundle_entries(read_bundles(spark, str(folder))).withColumn("batch_id", F.lit(0))
    assert rows(read_star(spark, lake, "fact_encounter")) == rows(star_table(build("encounter", bronze), STAR["fact_encounter"]))


def test_upserts_keep_and_count_broken_bundles(spark, tmp_path):
    folder, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))
    folder.mkdir()
    for n in range(100):
        entry = {"resourceType": "Encounter", "id": f"e{n}", "status": "s", "type": [{"coding": [{"code": "k"}]}]}
        text = json.dumps({"entry": [{"resource": entry}]})
        (folder / f"{n:03d}.json").write_text(text[:-9] if n % 5 == 0 else text)

    def run():
        stream = bundle_file_stream(spark, str(folder), files_per_batch=40)
        upsert_stream(spark, stream, ["fact_encounter"], lake, str(tmp_path / "progress"))
        return read_star(spark, lake, "fact_encounter").count()

    assert run() == run() == 80
    ledger = Ledger(spark, lake.root)
    assert sum(n for _, _, n in rows(ledger.rejects("stream"))) == 20
    kept = read_rejects(spark, lake, "stream")
    assert sorted(p.rsplit("/", 1)[1] for p, in rows(kept, "path")) == [f"{n:03d}.json" for n in range(0, 100, 5)]
    assert kept.where("length(text) > 20").count() == 20


def test_a_replayed_epoch_stays_behind_later_loads(spark, tmp_path):
    """The driver is lost after epoch 0 was written and before its commit; a newer batch load comes in between."""
    folder, lake, progress = tmp_path / "in", Lake(str(tmp_path / "lake")), tmp_path / "progress"
    folder.mkdir()
    write(folder, 0, "from the stream")
    ledger, table = Ledger(spark, lake.root), STAR["fact_encounter"]

    def run():
        upsert_stream(spark, bundle_file_stream(spark, str(folder)), ["fact_encounter"], lake, str(progress))
        return rows(read_star(spark, lake, table), "encounter_key", "encounter_status")

    assert run() == [("e0", "from the stream")]
    newer = read_star(spark, lake, table).withColumn("encounter_status", F.lit("newer"))
    write_star(newer, lake, table, "local", 0, ledger.load_number(0, "local"))
    ledger.record("gold", 0, "local")
    for name in ("0", ".0.crc"):
        (progress / "commits" / name).unlink()
    assert run() == [("e0", "newer")]
    assert ledger.load_number(0, "stream") < ledger.load_number(0, "local")


def test_each_file_is_parsed_once(spark, tmp_path):
    """Entries, rejects and their number come from one scan of the bundle files."""
    folder, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))
    folder.mkdir()
    for n in range(6):
        write(folder, n, "s")
    (folder / "broken.json").write_text('{"entry": [')
    ledger, read = Ledger(spark, lake.root), spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    bundles = read_bundles(spark, str(folder))
    store_bundles(bundles.mapInArrow(seen, bundles.schema), lake, "local", 0, ledger)
    assert read.value == 7
    assert read_bronze(spark, lake, "local", 0).count() == 6
    assert rows(ledger.rejects("local")) == [(0, "local", 1)]
    assert bundle_rows(bundles)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
