"""What queries write, shuffle and keep in memory at most."""

from __future__ import annotations

import time
from pathlib import Path

from pyspark.sql import functions as F

from chartweave.functions.scalars import parse_timestamp
from chartweave.operators.joins import KEYS_PER_ROW, fk_report
from chartweave.plans.details import build
from chartweave.session import SHUFFLE_CLEANUP, shuffles_released
from chartweave.sinks.layers import WRITERS, write_bronze
from chartweave.sources.layers import Lake, read_bronze
from conftest import rows
from workload import scan_queries
from workload.records import RECORDS, Tables, bundles


def test_bronze_is_written_without_a_sort(spark, records, tmp_path):
    spark.conf.unset(WRITERS)
    lake = Lake(str(tmp_path / "lake"))
    kinds = [{"resourceType": kind, "id": f"{kind}{n}"} for n in range(20) for kind in ("A", "B", "C")]
    write_bronze(records(*kinds).coalesce(1), lake, "local")
    assert rows(read_bronze(spark, lake, "local"), "resource_type", "data.id") == sorted(
        (k["resourceType"], k["id"]) for k in kinds
    )
    spark.sql(f"CREATE TABLE parts (v INT, k STRING) USING parquet PARTITIONED BY (k) LOCATION '{tmp_path}/parts'")
    try:
        plan = spark.sql("EXPLAIN INSERT INTO parts SELECT v, k FROM VALUES (1, 'a'), (2, 'b') AS t(v, k)").first()[0]
    finally:
        spark.sql("DROP TABLE parts")
    assert "WriteFiles" in plan and "Sort" not in plan


def test_bundles_of_a_stream_are_written_compressed(spark, tmp_path, monkeypatch):
    orders = spark.range(2000).selectExpr(
        "id AS o_orderkey", "id % 100 AS o_custkey", "'O' AS o_orderstatus", "1.5D AS o_totalprice",
        "TIMESTAMP'2020-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority",
    )
    orders.write.parquet(f"{tmp_path}/tables/orders.parquet")
    t = Tables(spark, f"{tmp_path}/tables")
    monkeypatch.setattr(scan_queries, "scratch", lambda t: f"{tmp_path}/work")
    stored = scan_queries.stream_upsert(t)
    assert stored.where("encounter_status = 'O'").count() == stored.count() == 2000
    text = bundles(t).agg(F.sum(F.length("value"))).first()[0]
    assert sum(f.stat().st_size for f in Path(tmp_path, "work/in").glob("part-*")) < text / 2


def test_key_report_counts_few_keys_beside_each_other(spark):
    dimension = spark.createDataFrame([("x",), ("y",), (None,)], "id STRING")
    facts = {f"f{n}": spark.createDataFrame([("x",), ("gone",), ("gone",), (f"lost{n}",), (None,)], "k STRING") for n in range(6)}
    facts["f5"] = dimension.withColumnRenamed("id", "k")
    keys = [(name, "k", "d", "id") for name in facts] + [("d", "id", "f0", "k")]
    report = fk_report({**facts, "d": dimension}, keys)
    want = [(name, "k", "d", 2, 3) for name in list(facts)[:5]] + [("f5", "k", "d", 0, 0), ("d", "id", "f0", 1, 1)]
    assert rows(report) == sorted(want)
    plan = report._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert 0 < below[: below.index("Union")].count("partial_count(") <= KEYS_PER_ROW + 1


def test_columns_are_counted_on_their_own(spark):
    a = spark.createDataFrame([("k1", 1, None), ("k2", 1, None), ("k3", None, None)], "k STRING, v INT, w DOUBLE")
    empty = spark.createDataFrame([], "x STRING")
    counts = scan_queries.column_counts({"a": a, "empty": empty}, {"a": "k", "empty": None})
    want = [("a", "k", 3, 3, 3), ("a", "v", 3, 2, 1), ("a", "w", 3, 0, 0), ("empty", "x", 0, 0, 0)]
    assert rows(counts, "table_name", "column_name", "n_rows", "n_values", "n_distinct") == want
    assert "Expand" not in counts._jdf.queryExecution().executedPlan().toString()


def test_patterns_are_only_tried_on_fractions(spark):
    texts = ["2020-01-02T03:04:05-04:00", "2020-01-02T03:04:05.1234567Z", "2020-01-02T03:04:05.x", "none", None]
    got = spark.createDataFrame([(t,) for t in texts], "t STRING").select(parse_timestamp("t").cast("string").alias("at"))
    assert [r.at for r in got.collect()] == ["2020-01-02 07:04:05", "2020-01-02 03:04:05.123456", None, None, None]
    plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "contains(" in plan and plan.index("contains(") < plan.index("regexp_")


def test_records_build_only_the_fields_a_plan_uses(spark, tmp_path):
    lines = spark.range(30).selectExpr(
        "id AS l_orderkey", "id % 7 AS l_partkey", "IF(id = 5, NULL, id) AS l_suppkey", "CAST(id % 8 AS INT) AS l_linenumber",
        "1.5D AS l_quantity", "0.5D AS l_tax", "'R' AS l_returnflag", "'O' AS l_linestatus", "TIMESTAMP'2020-01-01' AS l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    t = Tables(spark, str(tmp_path))
    requests = build("medication_request", RECORDS["MedicationRequest"](t))
    plan = requests._jdf.queryExecution().optimizedPlan().toString()
    assert "resourceType" not in plan and "med-" not in plan and "tablet" not in plan
    assert rows(requests.where("patient_id IS NULL"), "medication_request_id", "batch_id") == [("enc-5_M5", 2)]
    whole = RECORDS["MedicationRequest"](t).where("data.id = 'med-7-7'")
    assert rows(whole, "data.dispenseRequest.quantity.unit", F.size("data.dosageInstruction")) == [("tablet", 2)]


def test_shuffles_of_written_tables_are_released(spark, tmp_path):
    def shuffled() -> set[str]:
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        files = manager.getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(SHUFFLE_CLEANUP, "false")
    with shuffles_released(spark):
        spark.range(1000).selectExpr("id % 10 AS k").distinct().write.parquet(f"{tmp_path}/kept")
    end = time.time() + 20
    while shuffled() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(SHUFFLE_CLEANUP, "false") == setting
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 10


def test_stored_columns_are_counted_one_table_after_the_other(spark, tmp_path, monkeypatch):
    orders = spark.range(40).selectExpr(
        "id % 30 AS o_orderkey", "id % 3 AS o_custkey", "'O' AS o_orderstatus", "TIMESTAMP'2020-01-01' AS o_orderdate",
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    names = ("dim_procedure_type", "fact_procedure")
    monkeypatch.setattr(scan_queries, "STAR", {name: scan_queries.STAR[name] for name in names})
    monkeypatch.setattr(scan_queries, "scratch", lambda t: f"{tmp_path}/work")
    counts = scan_queries.sink_modeled_all(Tables(spark, str(tmp_path)))
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()  # what is left is read
    got = {(table, column): tuple(n) for table, column, *n in rows(counts)}
    assert got["dim_procedure_type", "procedure_type_key"] == got["dim_procedure_type", "procedure_type_name"] == (20, 20, 20)
    assert got["fact_procedure", "encounter_key"] == (30, 30, 30) and got["fact_procedure", "patient_key"] == (30, 30, 3)
    assert got["fact_procedure", "reason_reference"] == (30, 10, 10) and len(got) == 9


def test_key_report_stores_the_counts_of_one_table_after_the_other(spark, tmp_path):
    a = spark.createDataFrame([("x", "p"), ("y", None), ("y", "q"), (None, "z"), ("x", "q")], "id STRING, other STRING")
    b = spark.createDataFrame([("p", "x"), ("r", "gone"), ("s", "gone"), ("s", "gone")], "key STRING, id STRING")
    empty = spark.createDataFrame([], "key STRING")
    keys = [("a", "other", "b", "key"), ("b", "id", "a", "id"), ("b", "key", "empty", "key"), ("empty", "key", "b", "key")]
    stored = {}

    def store(name, counted):
        counted.write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.schema(counted.schema).parquet(f"{tmp_path}/{name}")
        return stored[name]

    tables = {"a": a, "b": b, "empty": empty}
    report = fk_report(tables, keys, store)
    want = [("a", "other", "b", 2, 3), ("b", "id", "a", 1, 3), ("b", "key", "empty", 3, 4), ("empty", "key", "b", 0, 0)]
    assert rows(report) == rows(fk_report(tables, keys)) == sorted(want)
    assert report.schema.simpleString() == fk_report(tables, keys).schema.simpleString()
    assert list(stored) == list(tables) and stored["b"].where("value = 'gone'").count() == 1
