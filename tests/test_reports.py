"""Reports that follow merges, against the full report after each batch."""

from __future__ import annotations

import random

import pytest

from chartweave.plans.reports import Report, read_report, refresh_report
from chartweave.plans.star import STAR
from chartweave.sinks.layers import write_star
from chartweave.sinks.snapshot import merge_batches
from chartweave.sources.layers import Lake, read_star
from conftest import rows

FACTS = STAR["fact_encounter"]
REPORT = Report(
    "by_type",
    FACTS,
    {"encounter_type_key": "encounter_type_key", "month": "date_format(period_start, 'yyyy-MM')"},
    {"n": ("count", "1"), "n_ended": ("count", "period_end"), "last": ("max", "period_end"), "least": ("min", "patient_key")},
)


def load(spark, lake, batch_id, n, keys):
    rng = random.Random(batch_id)
    ddl = "encounter_key STRING, patient_key STRING, encounter_type_key STRING, start STRING, finish STRING"
    data = [
        (f"e{rng.randrange(keys)}", f"p{rng.randrange(9)}", rng.choice("abc"), f"2020-0{rng.randrange(1, 6)}-01", rng.choice([None, f"2021-0{rng.randrange(1, 9)}-02"]))
        for _ in range(n)
    ]
    frame = spark.createDataFrame(data, ddl).selectExpr(
        "encounter_key", "patient_key", "CAST(NULL AS STRING) AS encounter_status", "CAST(NULL AS STRING) AS encounter_class",
        "encounter_type_key", "CAST(NULL AS STRING) AS encounter_reason_key", "CAST(start AS TIMESTAMP) AS period_start",
        "CAST(finish AS TIMESTAMP) AS period_end",
    )
    write_star(frame, lake, FACTS, "local", batch_id, batch_id + 1)


def test_equal_to_the_full_report_after_every_batch(spark, tmp_path):
    lake = Lake(str(tmp_path))
    with pytest.raises(ValueError):
        read_report(spark, lake, REPORT)
    names = spark.createDataFrame([("a", "A"), ("b", "B")], "encounter_type_key STRING, type_name STRING")
    for batch_id, n in enumerate((200, 150, 3, 1, 60)):
        load(spark, lake, batch_id, n, keys=120)  # later batches overwrite facts of earlier ones
        merge_batches(spark, lake, FACTS, [("local", batch_id)], first_buckets=16)
        got = read_report(spark, lake, REPORT, {"encounter_type_key": names})
        full = REPORT.of_rows(read_star(spark, lake, FACTS)).join(names, "encounter_type_key", "left")
        assert rows(got, *sorted(got.columns)) == rows(full, *sorted(full.columns))
        assert sum(r.n for r in got.collect()) == read_star(spark, lake, FACTS).count()


def test_only_the_buckets_of_a_merge_are_counted_again(spark, tmp_path):
    lake = Lake(str(tmp_path))
    load(spark, lake, 0, 400, keys=300)
    load(spark, lake, 1, 1, keys=300)
    merge_batches(spark, lake, FACTS, [("local", 0)], first_buckets=32)
    assert refresh_report(spark, lake, REPORT) >= 30
    merge_batches(spark, lake, FACTS, [("local", 1)])
    assert refresh_report(spark, lake, REPORT) == 1
    assert refresh_report(spark, lake, REPORT) == 0
    files = read_report(spark, lake, REPORT).inputFiles()
    assert files and all("/reports/" in f for f in files)
