from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from chartweave.operators.joins import (
    fk_report,
    fk_violations,
    full_outer_coalesce,
    left_join_child,
    star_join,
    star_report,
)
from chartweave.operators.profile import (
    convert_dtypes,
    frame_profile,
    prune_all_frames,
    typed_extension_columns,
    unique_values,
    value_counts,
)
from chartweave.plans.ledger import last_batch, next_batch, oldest, pending_batches
from conftest import rows


def test_counts_and_uniques(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "v STRING")
    assert rows(value_counts(df, "v")) == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in value_counts(df, "v", top=1).collect()] == [("a", 2)]
    assert rows(unique_values(df, "v")) == [("a",), ("b",), (None,)]


def test_profile_and_prune(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (2, "x")], "a INT, `b.c` STRING")
    assert rows(frame_profile(df)) == [("a", "int", 3), ("b.c", "string", 1)]
    assert rows(prune_all_frames({"t": df})["t"], "a", "`b.c`") == [(1, None), (2, "x")]


def test_convert_dtypes(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "true", "x", 2.0, 2.5, None, "007"), ("-7", "2.25", "false", "1", 4.0, 1.0, None, "12")],
        "i STRING, d STRING, b STRING, s STRING, w DOUBLE, f DOUBLE, n STRING, zeros STRING",
    )
    kinds = [f.dataType.simpleString() for f in convert_dtypes(df).schema.fields]
    assert kinds == ["bigint", "double", "boolean", "string", "bigint", "double", "string", "string"]


def test_extension_columns(spark):
    df = spark.createDataFrame([([("http://x/yes", True)],), ([],), (None,)], "e ARRAY<STRUCT<url: STRING, v: BOOLEAN>>")
    out = typed_extension_columns(df, F.col("e"), "v", ["yes", "no"])
    assert [(r["yes"], r["no"]) for r in out.collect()] == [(True, None), (None, None), (None, None)]


def test_extension_columns_from_the_data(spark):
    ddl = "e ARRAY<STRUCT<url: STRING, valueInt: INT, valueText: STRING, valuePlace: STRUCT<city: STRING>>>"
    rows_ = [([("http://x/n", 3, None, None), ("http://x/p", None, None, ("A",))],), ([("y/t", None, "text", None)],), (None,)]
    out = typed_extension_columns(spark.createDataFrame(rows_, ddl), F.col("e"))
    assert [(r["n"], r["p"], r["t"]) for r in out.collect()] == [("3", '{"city":"A"}', None), (None, None, "text"), (None, None, None)]


def test_joins(spark):
    parent = spark.createDataFrame([(1, "p"), (2, "q")], "id INT, name STRING")
    child = spark.createDataFrame([(1, "x"), (1, "y")], "parent_id INT, item STRING")
    assert rows(left_join_child(parent, child, "id", "parent_id")) == [(1, "p", "x"), (1, "p", "y"), (2, "q", None)]
    left = spark.createDataFrame([(1, None), (2, "l")], "id INT, v STRING")
    right = spark.createDataFrame([(1, "r"), (3, "s")], "id INT, w STRING")
    assert rows(full_outer_coalesce(left, right, "id", {"v": ("v", "w")})) == [(1, "r"), (2, "l"), (3, "s")]
    assert rows(star_join(child.withColumnRenamed("parent_id", "id"), {"id": parent}), "id", "name") == [(1, "p"), (1, "p")]
    report = star_report(child, {"id": F.col("parent_id")}, {"n": F.count("*")}, {"id": parent})
    assert rows(report, "id", "n", "name") == [(1, 2, "p")]
    fact = spark.createDataFrame([(1,), (5,), (5,), (None,)], "id INT")
    assert rows(fk_violations(fact, "id", parent)) == [(5, 2)]


def test_key_report(spark):
    a = spark.createDataFrame([("x", "p"), ("y", None), ("y", "q"), (None, "z")], "id STRING, other STRING")
    b = spark.createDataFrame([("p", "x"), ("r", "gone"), ("s", "gone")], "key STRING, id STRING")
    empty = spark.createDataFrame([], "key STRING")
    keys = [("a", "other", "b", "key"), ("b", "id", "a", "id"), ("b", "key", "empty", "key"), ("empty", "key", "b", "key")]
    want = [
        ("a", "other", "b", 2, 2), ("b", "id", "a", 1, 2), ("b", "key", "empty", 3, 3), ("empty", "key", "b", 0, 0),
    ]
    assert rows(fk_report({"a": a, "b": b, "empty": empty}, keys)) == sorted(want)


def test_key_report_has_one_exchange_for_all_tables(spark):
    ids = spark.range(1000).selectExpr("CAST(id AS STRING) AS id", "CAST(id % 7 AS STRING) AS k")
    tables = {name: ids for name in ("a", "b", "c")}
    keys = [("a", "k", "b", "id"), ("a", "id", "c", "id"), ("b", "k", "c", "id"), ("c", "k", "a", "id")]
    plan = fk_report(tables, keys)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "HashAggregate" in below  # reduced before it


@pytest.mark.parametrize("hot", ["left", "right", "both"])
def test_a_hot_key_of_an_outer_join_is_split(spark, hot):
    """No task holds the hot key: its partition is split, and the rows are those of a full outer join."""
    n = {"left": (30_000, 300), "right": (300, 30_000), "both": (3_000, 2_000)}[hot]

    def side(rows_, other, name):
        key = f"IF(id % 3 = 0, NULL, IF(id % 3 = 1, {other}, 7))" if rows_ > 1000 else f"IF(id = 0, 7, id + {other})"
        return spark.range(rows_).selectExpr(f"CAST({key} AS BIGINT) AS id", f"sha2(concat('{name}', id), 256) AS {name}")

    left, right = side(n[0], "id", "v").cache(), side(n[1], "id + 100000", "w").cache()
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = full_outer_coalesce(left, right, "id", {"v": ("v", "w")})
        got = joined.groupBy("id", "v").count().collect()
        plain = joined.select("id", "v")
        plain.collect()
        assert "skew=true" in plain._jdf.queryExecution().executedPlan().toString()
        both = left.withColumnRenamed("id", "a").join(right.withColumnRenamed("id", "b"), F.expr("a = b"), "full_outer")
        want = both.selectExpr("coalesce(a, b) AS id", "coalesce(v, w) AS v").groupBy("id", "v").count().collect()
    finally:
        for name in settings:
            spark.conf.unset(name)
        left.unpersist(), right.unpersist()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)


def test_ledger_rules(spark):
    ddl = "batch_id INT, save_ts TIMESTAMP, source STRING"
    import datetime as d

    at = d.datetime(2024, 1, 1)
    later = d.datetime(2024, 1, 2)
    bronze = spark.createDataFrame([(0, later, "local"), (1, at, "local"), (1, later, "local"), (2, at, "stream")], ddl)
    silver = spark.createDataFrame([(0, later, "stream")], ddl)
    assert rows(pending_batches(bronze, silver, "local"), "batch_id") == [(0,), (1,)]
    assert rows(pending_batches(bronze, silver, "local", match_source=False), "batch_id") == [(1,)]
    assert oldest(pending_batches(bronze, silver, "local")).first()["batch_id"] == 1
    assert last_batch(bronze, "stream").first()[0] == 2
    assert next_batch(bronze, "other").first()[0] == 0
