"""Queries of joins, star reports and key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartweave.operators.joins import fk_report, fk_violations, full_outer_coalesce, left_join_child, star_report
from chartweave.operators.keyed import rows_without_key
from chartweave.plans.details import DETAILS, build
from chartweave.plans.reports import Report, read_report, refresh_report
from chartweave.plans.star import FOREIGN_KEYS, STAR, load_rows, model_table, star_table
from chartweave.session import scratch_folder, shuffles_released
from chartweave.sinks.layers import write_star
from chartweave.sinks.snapshot import merge_batches
from chartweave.sources.layers import Lake

from .oracle_star import STAR_SQL
from .records import RECORDS, Tables
from .register import query


def star(t: Tables, name: str) -> DataFrame:
    table = STAR[name]
    return star_table(build(table.source, RECORDS[DETAILS[table.source].resource](t)), table)


@query(
    "star_join_report",
    f"""SELECT f.encounter_type_key, d.encounter_type_name, f.encounter_month, f.n_encounters, f.n_hours
        FROM (SELECT encounter_type_key, strftime(period_start, '%Y-%m') AS encounter_month, count(*) AS n_encounters,
                CAST(sum(date_diff('hour', period_start, period_end)) AS BIGINT) AS n_hours
              FROM ({STAR_SQL['fact_encounter']}) GROUP BY 1, 2) f
        LEFT JOIN ({STAR_SQL['dim_encounter_type']}) d USING (encounter_type_key)""",
)
def star_join_report(t: Tables) -> DataFrame:
    """Encounters per type and month."""
    hours = (F.unix_timestamp("period_end") - F.unix_timestamp("period_start")) / 3600
    return star_report(
        star(t, "fact_encounter"),
        {"encounter_type_key": F.col("encounter_type_key"), "encounter_month": F.date_format("period_start", "yyyy-MM")},
        {"n_encounters": F.count("*"), "n_hours": F.sum(hours.cast("bigint"))},
        {"encounter_type_key": star(t, "dim_encounter_type")},
    )


@query(
    "star_report_incremental",
    f"""SELECT f.encounter_type_key, d.encounter_type_name, f.encounter_month, f.n_encounters, f.n_hours
        FROM (SELECT encounter_type_key, strftime(period_start, '%Y-%m') AS encounter_month, count(*) AS n_encounters,
                CAST(sum(date_diff('hour', period_start, period_end)) AS BIGINT) AS n_hours
              FROM ({STAR_SQL['fact_encounter']}) GROUP BY 1, 2) f
        LEFT JOIN ({STAR_SQL['dim_encounter_type']}) d USING (encounter_type_key)""",
)
def star_report_incremental(t: Tables) -> DataFrame:
    """The same report, kept up with three batches of which each overwrites facts of an older state."""
    lake, table = Lake(scratch_folder(t.spark)), STAR["fact_encounter"]
    rows = load_rows(build(table.source, RECORDS["Encounter"](t)), table)
    older = rows.withColumn("encounter_type_key", F.lit("older")).withColumn("batch_id", F.lit(-1))
    write_star(older, lake, table, "local", -1, 0)
    write_star(rows, lake, table, "local")
    hours = "CAST((unix_timestamp(period_end) - unix_timestamp(period_start)) / 3600 AS BIGINT)"
    report = Report(
        "encounters_by_month",
        table,
        {"encounter_type_key": "encounter_type_key", "encounter_month": "date_format(period_start, 'yyyy-MM')"},
        {"n_encounters": ("count", "1"), "n_hours": ("sum", hours)},
    )
    for batch_id in range(-1, 3):
        merge_batches(t.spark, lake, table, [("local", batch_id)])
        refresh_report(t.spark, lake, report)
    return read_report(t.spark, lake, report, {"encounter_type_key": star(t, "dim_encounter_type")})


@query(
    "star_conditions_by_category",
    f"""SELECT condition_category, gender, CAST(sum(n) AS BIGINT) AS n_conditions
        FROM (SELECT condition_code_key, patient_key, count(*) AS n FROM ({STAR_SQL['fact_condition']}) GROUP BY 1, 2)
        LEFT JOIN ({STAR_SQL['dim_condition_code']}) USING (condition_code_key)
        LEFT JOIN ({STAR_SQL['dim_patient']}) USING (patient_key)
        GROUP BY 1, 2""",
)
def star_conditions_by_category(t: Tables) -> DataFrame:
    """Conditions per category and gender, counted per code and patient before the joins."""
    joined = star_report(
        star(t, "fact_condition"),
        {"condition_code_key": F.col("condition_code_key"), "patient_key": F.col("patient_key")},
        {"n": F.count("*")},
        {"condition_code_key": star(t, "dim_condition_code"), "patient_key": star(t, "dim_patient")},
    )
    return joined.groupBy("condition_category", "gender").agg(F.sum("n").alias("n_conditions"))


@query(
    "fk_violations",
    """SELECT l_partkey AS missing_key, count(*) AS n_rows FROM lineitem
       WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1""",
)
def broken_references(t: Tables) -> DataFrame:
    """A key checked against a table that lacks most of it, so that there is something to find; ``fk_report``
    checks the keys of the star schema."""
    return fk_violations(t.lineitem, "l_partkey", t.supplier, "s_suppkey")


@query(
    "fk_report",
    " UNION ALL ".join(
        f"""SELECT '{fact}' AS fact, '{key}' AS fact_key, '{dimension}' AS dimension,
              count(DISTINCT f."{key}") AS n_missing, count(f."{key}") AS n_rows
            FROM ({STAR_SQL[fact]}) f
            WHERE f."{key}" IS NOT NULL AND f."{key}" NOT IN
              (SELECT "{other}" FROM ({STAR_SQL[dimension]}) WHERE "{other}" IS NOT NULL)"""
        for fact, key, dimension, other in FOREIGN_KEYS
    ),
)
def key_report(t: Tables) -> DataFrame:
    """All declared foreign keys of the star schema, one table's rows after the other's."""
    folder = scratch_folder(t.spark)

    def store(name: str, counted: DataFrame) -> DataFrame:
        counted.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return t.spark.read.schema(counted.schema).parquet(f"{folder}/{name}")

    tables = {name for fact, _, dimension, _ in FOREIGN_KEYS for name in (fact, dimension)}
    with shuffles_released(t.spark):
        return fk_report({name: star(t, name) for name in sorted(tables)}, FOREIGN_KEYS, store)


@query(
    "pk_violations",
    "SELECT 'enc-' || o_orderkey AS encounter_key, CAST(NULL AS VARCHAR) AS encounter_reason_key FROM orders WHERE o_orderkey % 4 = 0 "
    "UNION ALL SELECT 'enc-' || o_orderkey, NULL FROM orders WHERE o_orderkey % 12 = 0",
)
def refused_rows(t: Tables) -> DataFrame:
    """Rows a table keyed by reason would refuse."""
    facts = model_table(build("encounter", RECORDS["Encounter"](t)), STAR["fact_encounter"])
    return rows_without_key(facts, "encounter_reason_key").select("encounter_key", "encounter_reason_key")


@query(
    "left_join_child",
    """SELECT o_orderkey AS id, o_orderpriority, l_linenumber AS child_line
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
)
def left_join(t: Tables) -> DataFrame:
    parent = t.orders.select(F.col("o_orderkey").alias("id"), "o_orderpriority")
    child = t.lineitem.select(F.col("l_orderkey").alias("parent_id"), F.col("l_linenumber").alias("child_line"))
    return left_join_child(parent, child, "id", "parent_id")


@query(
    "full_outer_coalesce",
    """WITH q AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS value,
                    o_orderstatus AS unit FROM orders),
            c AS (SELECT l_orderkey * 2 AS id, sum(l_quantity) AS value, max(l_returnflag) AS unit FROM lineitem GROUP BY 1)
       SELECT coalesce(q.id, c.id) AS id, coalesce(c.value, q.value) AS value, coalesce(c.unit, q.unit) AS unit
       FROM q FULL OUTER JOIN c ON q.id = c.id""",
)
def outer_join(t: Tables) -> DataFrame:
    """Component values first, the parent's own value where there is no component."""
    own = t.orders.selectExpr(
        "o_orderkey AS id", "IF(o_orderkey % 2 = 0, o_totalprice, NULL) AS value", "o_orderstatus AS unit"
    )
    lines = t.lineitem.groupBy((F.col("l_orderkey") * 2).alias("id"))
    parts = lines.agg(F.sum("l_quantity").alias("value"), F.max("l_returnflag").alias("unit"))
    return full_outer_coalesce(parts, own, "id", {"value": ("value", "value"), "unit": ("unit", "unit")})
