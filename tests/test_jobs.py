"""Files to star tables, with bundles as they arrive: one multi-line JSON object per file."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from chartweave.__main__ import main
from chartweave.plans.jobs import batch_rows, export, ingest, merged_with, model, transform
from chartweave.plans.ledger import Ledger
from chartweave.plans.profiles import read_profile
from chartweave.plans.star import STAR, create_star_tables, load_rows
from chartweave.sinks.layers import save_detail_table, save_image_table, write_star
from chartweave.sources.bundles import bundle_entries, list_files, read_bundles, read_json_inferred, schema_rows
from chartweave.sources.file_batches import list_outer, next_folders, outer_folder
from chartweave.sources.layers import Lake, read_bronze, read_detail, read_rejects, read_star
from conftest import rows


def bundle(number: int, name: str) -> dict:
    who = {"reference": f"urn:uuid:p{number}"}
    kind = [{"coding": [{"code": "chk", "display": name, "system": "s"}], "text": f"Check {name}"}]
    return {
        "resourceType": "Bundle",
        "type": "collection",
        "entry": [
            {"fullUrl": "urn:uuid:x", "resource": {"resourceType": "Patient", "id": f"p{number}", "birthDate": "1970-01-02"}},
            {"resource": {"resourceType": "Encounter", "id": "shared", "patient": who, "type": kind, "status": name}},
            {"resource": {"resourceType": "AllergyIntolerance", "type": "allergy", "category": ["food"], "patient": who}},
            {
                "resource": {
                    "resourceType": "Procedure",
                    "subject": who,
                    "reasonReference": {"reference": "urn:uuid:c1"},
                    "performedDateTime": "2011-01-02T03:04:05-04:00",
                }
            },
            {
                "resource": {
                    "resourceType": "CarePlan",
                    "subject": who,
                    "category": [{"coding": [{"code": "cat", "display": "Category"}]}],
                    "activity": [{"detail": {"status": "s"}}],
                    "addresses": [{"reference": "urn:uuid:c2"}],
                }
            },
            {"resource": {"id": "no type"}},
        ],
    }


@pytest.fixture()
def folder(tmp_path):
    root = tmp_path / "in put[1]"
    for outer in range(5):
        inner = root / f"{outer:02d}" / "000"
        inner.mkdir(parents=True)
        (inner / f"b{outer}.json").write_text(json.dumps(bundle(outer, f"n{outer}"), indent=2))
    (root / "00" / "000" / "empty.json").write_text('{"resourceType": "Bundle"}')
    (root / "stray.json").write_text("{}")
    return str(root)


def test_batches_of_folders(spark, folder, tmp_path):
    ledger, planned = Ledger(spark, str(tmp_path / "ledger")), []
    outer = list_outer(spark, folder)
    while claimed := ledger.claim_folders("local", lambda taken: next_folders(outer, taken, 2)):
        planned.append(claimed)
    assert planned == [(0, ["00", "01"]), (1, ["02", "03"]), (2, ["04"])]
    files = list_files(spark, folder.replace("[", "\\[").replace("]", "\\]"))
    placed = files.select("path", outer_folder(F.col("path"), folder).alias("outer"))
    got = rows(placed.join(ledger.folders("local"), "outer"), "batch_id", "path")
    assert [(b, p.rsplit("/", 1)[1]) for b, p in got] == [
        (0, "b0.json"), (0, "empty.json"), (0, "b1.json"), (1, "b2.json"), (1, "b3.json"), (2, "b4.json"),
    ]


def test_polymorphic_fields_keep_their_json(spark, folder):
    entries = bundle_entries(read_bundles(spark, folder.replace("[", "\\[").replace("]", "\\]") + "/03/000/*"))
    data = {kind: row for kind, row in entries.collect()}
    assert set(data) == {"Patient", "Encounter", "AllergyIntolerance", "Procedure", "CarePlan"}
    assert json.loads(data["Encounter"]["type"])[0]["text"] == "Check n3"
    assert data["AllergyIntolerance"]["type"] == "allergy"
    assert data["AllergyIntolerance"]["category"] == ["food"]
    assert json.loads(data["CarePlan"]["category"][0])["coding"][0]["code"] == "cat"
    assert json.loads(data["Procedure"]["reasonReference"]) == {"reference": "urn:uuid:c1"}


def test_inferred_schema(spark, tmp_path):
    path = tmp_path / "one.json"
    path.write_text('{"a": 1,\n "b": ["x"]}')
    assert rows(schema_rows(read_json_inferred(spark, str(path)))) == [("a", "bigint"), ("b", "array<string>")]


def test_all_layers(spark, tmp_path):
    root = tmp_path / "input"
    for outer in range(5):
        inner = root / f"{outer:02d}" / "000"
        inner.mkdir(parents=True)
        (inner / f"b{outer}.json").write_text(json.dumps(bundle(outer, f"n{outer}"), indent=2))
    lake = Lake(str(tmp_path / "lake"))
    assert transform(spark, lake) is None
    assert model(spark, lake) is None
    assert [ingest(spark, lake, str(root), folders_per_batch=2) for _ in range(4)] == [0, 1, 2, None]
    assert [transform(spark, lake) for _ in range(4)] == [0, 1, 2, None]
    assert [model(spark, lake) for _ in range(4)] == [0, 1, 2, None]

    assert read_bronze(spark, lake, "local", 1).count() == 10
    assert rows(read_detail(spark, lake, "patient", "local", 2), "patient_id") == [("p4",)]
    assert rows(read_star(spark, lake, "dim_patient"), "patient_key") == [(f"p{i}",) for i in range(5)]
    assert rows(read_star(spark, lake, "fact_encounter"), "encounter_key", "encounter_status") == [("shared", "n4")]
    assert rows(read_star(spark, lake, "dim_encounter_type")) == [("chk", "Check n4")]
    assert rows(read_star(spark, lake, "fact_procedure"), "patient_key", "reason_reference") == [(f"p{i}", "c1") for i in range(5)]
    assert rows(read_star(spark, lake, "dim_careplan_category")) == [("cat", "Category")]
    assert read_star(spark, lake, "fact_observation").count() == 0

    ledger = Ledger(spark, lake.root)
    ledger.record("gold", 2, "local")
    assert rows(ledger.read("gold"), "batch_id", "source") == [(0, "local"), (1, "local"), (2, "local")]
    with pytest.raises(ValueError):
        ledger.path("copper")

    updates = spark.createDataFrame([("chk", "new name", 9)], "encounter_type_key STRING, encounter_type_name STRING, batch_id INT")
    assert rows(merged_with(spark, lake, "dim_encounter_type", updates)) == [("chk", "new name")]


def test_command_line_and_reruns(spark, tmp_path):
    root = tmp_path / "input" / "00" / "000"
    root.mkdir(parents=True)
    (root / "b.json").write_text(json.dumps(bundle(1, "n")))
    lake = Lake(str(tmp_path / "lake"))
    assert main(["ingest", "--lake", lake.root, "--input", str(tmp_path / "input")]) == 0
    assert main(["transform", "--lake", lake.root]) == 0
    assert main(["model", "--lake", lake.root]) == 0
    assert main(["model", "--lake", lake.root]) is None
    assert main(["merge", "--lake", lake.root]) == 17
    assert main(["profile", "--lake", lake.root]) == 60 and main(["profile", "--lake", lake.root]) == 0
    found = {r.column_name: r for r in read_profile(spark, lake.profiles("clinical.fact_procedure")).collect()}
    assert found["reason_reference"].n_values == 1 and [tuple(f) for f in found["reason_reference"].frequent] == [("c1", 1)]
    with pytest.raises(SystemExit):
        main(["ingest", "--lake", lake.root, "--source", "kafka"])

    table = STAR["fact_careplan"]
    before = rows(read_star(spark, lake, table))
    write_star(load_rows(read_detail(spark, lake, "careplan", "local", 0), table), lake, table, "local", 0)
    assert rows(read_star(spark, lake, table)) == before
    assert rows(batch_rows(spark, lake, table.name, "local", 0)) == before


def test_star_tables_can_be_defined(spark, tmp_path):
    names = create_star_tables(spark, str(tmp_path), "test_")
    assert len(names) == 30
    for name, table in zip(names, STAR.values()):
        assert spark.table(name).columns == table.columns
    for group in ("patient", "encounter", "clinical", "care"):
        spark.sql(f"DROP DATABASE test_{group} CASCADE")


def test_catalog_tables_replace_a_batch(spark, tmp_path):
    spark.sql(f"CREATE DATABASE details LOCATION '{tmp_path}/details'")
    frame = spark.createDataFrame([("a",), ("b",)], "code STRING")
    save_detail_table(frame, "details.codes", 0)
    save_detail_table(frame.limit(1), "details.codes", 1)
    save_detail_table(frame.where("code = 'b'"), "details.codes", 0)
    assert rows(spark.table("details.codes"), "batch_id", "code") == [(0, "b"), (1, "a")]
    save_image_table(frame, "details.images")
    save_image_table(frame, "details.images")
    assert spark.table("details.images").count() == 2
    spark.sql("DROP DATABASE details CASCADE")


def put(root, outer: str, number: int, text: str | None = None):
    inner = root / outer / "000"
    inner.mkdir(parents=True, exist_ok=True)
    (inner / f"b{number}.json").write_text(text or json.dumps(bundle(number, f"n{number}"), indent=2))


def test_folders_that_arrive_late_or_sort_earlier_are_loaded_once(spark, tmp_path):
    root, lake = tmp_path / "input", Lake(str(tmp_path / "lake"))
    for n in range(10, 20):
        put(root, f"f{n}", n)
    assert [ingest(spark, lake, str(root)) for _ in range(3)] == [0, 1, None]
    for n in range(6):
        put(root, f"{'a' if n % 2 else 'z'}{n}", n)
    assert [ingest(spark, lake, str(root)) for _ in range(2)] == [2, None]
    ids = read_bronze(spark, lake, "local").where("resource_type = 'Patient'").select("data.id")
    assert sorted(r.id for r in ids.collect()) == sorted(f"p{n}" for n in [*range(6), *range(10, 20)])
    taken = rows(Ledger(spark, lake.root).folders("local"), "batch_id", "outer")
    assert len(taken) == len({outer for _, outer in taken}) == 16


def test_a_batch_that_failed_takes_the_same_folders_again(spark, tmp_path):
    root, lake = tmp_path / "input", Lake(str(tmp_path / "lake"))
    put(root, "m", 1)
    ledger = Ledger(spark, lake.root)
    ledger.next_id("local")
    ledger.take_folders(0, "local", ["m"])  # and then the job was lost
    put(root, "a", 2)
    assert [ingest(spark, lake, str(root), folders_per_batch=1) for _ in range(3)] == [0, 1, None]
    patients = read_bronze(spark, lake, "local").where("resource_type = 'Patient'")
    assert rows(patients, "batch_id", "data.id") == [(0, "p1"), (1, "p2")]


def test_broken_bundles_are_kept_and_counted(spark, tmp_path):
    root, lake = tmp_path / "input", Lake(str(tmp_path / "lake"))
    put(root, "a", 1)
    put(root, "a", 2, json.dumps(bundle(2, "n"))[:-30])
    put(root, "a", 3, '{"resourceType": "Bundle", "entry": "none"}')
    assert ingest(spark, lake, str(root)) == 0
    assert rows(read_bronze(spark, lake, "local").where("resource_type = 'Patient'"), "data.id") == [("p1",)]
    assert rows(Ledger(spark, lake.root).rejects("local")) == [(0, "local", 2)]
    kept = read_rejects(spark, lake, "local", 0)
    assert [p.rsplit("/", 1)[1] for p, in rows(kept, "path")] == ["b2.json", "b3.json"]
    assert any('"entry": "none"' in t for t, in rows(kept, "text"))


def test_the_later_load_wins_across_sources(spark, tmp_path):
    lake, ledger = Lake(str(tmp_path / "lake")), Ledger(spark, str(tmp_path / "lake"))
    table = STAR["dim_encounter_type"]
    ddl = "encounter_type_key STRING, encounter_type_name STRING"

    def load(source, batch_id, name):
        rows_ = spark.createDataFrame([("k", name)], ddl)
        write_star(rows_, lake, table, source, batch_id, ledger.next_load())
        ledger.record("gold", batch_id, source)

    load("local", 5, "old")
    load("stream", 0, "new")
    assert rows(read_star(spark, lake, table)) == [("k", "new")]
    load("local", 6, "newest")
    assert rows(read_star(spark, lake, table)) == [("k", "newest")]


def test_failed_exports_are_sent_again(spark, tmp_path):
    root, lake = tmp_path / "input", Lake(str(tmp_path / "lake"))
    put(root, "a", 1)
    ingest(spark, lake, str(root)), transform(spark, lake), model(spark, lake)
    sent, broken = [], {"on": True}

    def send(frame, url, name, properties):
        if broken["on"] and name.endswith("fact_careplan"):
            raise ConnectionError("gone")
        sent.append((name, frame.count()))

    with pytest.raises(ConnectionError):
        export(spark, lake, "jdbc:x", {}, send=send)
    broken["on"] = False
    assert export(spark, lake, "jdbc:x", {}, send=send) == [0]
    assert sorted(name for name, _ in sent) == sorted(t.full_name for t in STAR.values())  # no table twice
    assert ("patient.dim_patient", 1) in sent
    assert export(spark, lake, "jdbc:x", {}, send=send) == []


def test_jobs_keep_catalog_tables(spark, tmp_path):
    root, lake = tmp_path / "input", Lake(str(tmp_path / "lake"))
    put(root, "a", 1)
    put(root, "b", 2)
    spark.sql(f"CREATE DATABASE silver_cat LOCATION '{tmp_path}/silver_cat'")
    for group in ("patient", "encounter", "clinical", "care"):
        spark.sql(f"CREATE DATABASE cat_{group} LOCATION '{tmp_path}/cat_{group}'")
    for _ in range(2):
        ingest(spark, lake, str(root), folders_per_batch=1)
        transform(spark, lake, database="silver_cat")
        model(spark, lake, prefix="cat_")
    assert rows(spark.sql("SELECT batch_id, patient_id FROM silver_cat.patient")) == [(0, "p1"), (1, "p2")]
    assert rows(spark.sql("SELECT patient_key FROM cat_patient.dim_patient")) == [("p1",), ("p2",)]
    for name in ("silver_cat", *(f"cat_{g}" for g in ("patient", "encounter", "clinical", "care"))):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_shared_folder(spark, monkeypatch):
    from chartweave import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.shared_folder(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError):
        session.shared_folder(Session())
    Context.master = "local[2]"
    assert session.shared_folder(Session()) == session.shared_folder(Session())
