"""The plans themselves: no Python rows, pruned scans, reductions before shuffles."""

from __future__ import annotations

import pytest

from chartweave.plans.details import DETAILS, build
from chartweave.plans.star import STAR, star_table
from chartweave.sinks.layers import write_bronze
from chartweave.sources.layers import Lake, read_bronze
from workload.records import RECORDS, Tables, bronze

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("lake")))
    write_bronze(bronze(Tables(spark, DATA), "Observation", "Condition", "Patient").drop("batch_id"), lake, "local", 3)
    return read_bronze(spark, lake, "local", 3)


def test_no_python_in_details(spark):
    t = Tables(spark, DATA)
    for name, table in DETAILS.items():
        assert "Python" not in plan(build(name, RECORDS[table.resource](t))), name


@pytest.mark.parametrize("name", ["observation_result", "condition", "patient_extension"])
def test_scans_are_pruned(spark, stored, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    text = plan(build(name, stored))
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "batch_id" in filters and "resource_type" in filters
    schema = text.split("ReadSchema: ")[1]
    unused = {"observation_result": "issued", "condition": "telecom", "patient_extension": "telecom"}[name]
    assert unused not in schema and "resourceType" not in schema
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_results_are_read_in_one_scan(stored):
    assert plan(build("observation_result", stored)).count("FileScan") == 1


def test_detail_rows_need_no_shuffle(stored):
    for name in ("observation", "observation_result", "condition", "patient_name", "patient_address"):
        assert "Exchange" not in plan(build(name, stored)), name


def test_codes_are_reduced_before_the_shuffle(stored):
    text = plan(build("condition_code", stored))
    below = text[text.rindex("Exchange"):]
    assert "HashAggregate" in below
    merged = plan(star_table(build("condition_code", stored), STAR["dim_condition_code"]))
    assert "Window" not in merged and "HashAggregate" in merged


def test_facts_are_shuffled_and_sorted_once(stored):
    text = plan(star_table(build("observation", stored), STAR["fact_observation"]))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count(" Sort [") <= 1


def test_bronze_is_written_from_the_scan(spark):
    rows = bronze(Tables(spark, DATA), "Observation", "Condition")
    assert "Exchange" not in plan(rows)
