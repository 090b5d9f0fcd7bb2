"""Queries of profiling and cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartweave.operators.profile import (
    convert_dtypes,
    frame_profile,
    prune_all_frames,
    typed_extension_columns,
    unique_values,
    value_counts,
)
from chartweave.operators.sketches import profile_report
from chartweave.plans.profiles import read_profile, update_profiles
from chartweave.session import scratch_folder
from chartweave.sinks.layers import write_detail
from chartweave.sources.layers import Lake

from .records import Tables
from .register import query
from .shape_queries import data


@query("value_counts", "SELECT l_shipdate, count(*) AS n FROM lineitem GROUP BY 1")
def counts(t: Tables) -> DataFrame:
    return value_counts(t.lineitem, "l_shipdate")


@query("top_values_head", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 5")
def head(t: Tables) -> DataFrame:
    return value_counts(t.lineitem, "l_partkey", top=5)


@query("unique_values", "SELECT DISTINCT l_suppkey FROM lineitem")
def uniques(t: Tables) -> DataFrame:
    return unique_values(t.lineitem, "l_suppkey")


@query(
    "frame_profile",
    """SELECT * FROM (
         SELECT 'id' AS column_name, 'string' AS data_type, count(*) AS non_null FROM customer
         UNION ALL SELECT 'birthDate', 'string', count(*) FROM customer
         UNION ALL SELECT 'deceasedDateTime', 'string', count(*) FROM customer WHERE c_custkey % 9 = 0
         UNION ALL SELECT 'multipleBirthBoolean', 'boolean', count(*) FROM customer WHERE c_custkey % 10 <> 0
         UNION ALL SELECT 'multipleBirthInteger', 'bigint', count(*) FROM customer WHERE c_custkey % 10 = 0)""",
)
def profile(t: Tables) -> DataFrame:
    return frame_profile(
        data(t, "Patient").select("id", "birthDate", "deceasedDateTime", "multipleBirthBoolean", "multipleBirthInteger")
    )


@query(
    "convert_dtypes",
    """SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus = 'F' AS done
       FROM orders""",
)
def best_types(t: Tables) -> DataFrame:
    return convert_dtypes(
        t.orders.selectExpr(
            "CAST(o_orderkey AS STRING) AS o_orderkey",
            "CAST(o_totalprice AS STRING) AS o_totalprice",
            "o_orderstatus",
            "CAST(o_custkey AS DOUBLE) AS o_custkey",
            "CAST(o_orderstatus = 'F' AS STRING) AS done",
        )
    )


@query(
    "typed_extension_columns",
    """SELECT 'pat-' || c_custkey AS id, CASE WHEN c_custkey % 6 <> 0 THEN c_custkey % 4 = 0 END AS "okayToLeaveMessage"
       FROM customer WHERE c_custkey % 13 <> 0""",
)
def extension_columns(t: Tables) -> DataFrame:
    contacts = data(t, "Patient").select("id", F.explode("telecom").alias("contact"))
    rows = typed_extension_columns(contacts, F.col("contact.extension"), "valueBoolean", ["okayToLeaveMessage"])
    return rows.select("id", "okayToLeaveMessage")


@query(
    "extension_columns",
    """SELECT 'pat-' || c_custkey AS id, '{"city":"' || n_name || '","state":"' || r_name || '"}' AS "birthPlace",
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS "us-core-birthsex", 'Maiden-' || (c_custkey % 100) AS "mothersMaidenName"
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def all_extension_columns(t: Tables) -> DataFrame:
    """Names and value fields as the data has them."""
    rows = typed_extension_columns(data(t, "Patient").select("id", "extension"), F.col("extension"))
    return rows.select("id", "birthPlace", "us-core-birthsex", "mothersMaidenName")


@query(
    "prune_all_frames",
    """SELECT 'flags' AS frame, l_returnflag AS first, l_linestatus AS second
       FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem)
       UNION ALL SELECT 'kinds', kind, CAST(user_id AS VARCHAR) FROM (
         SELECT DISTINCT CASE WHEN event_id % 2 = 0 THEN event_type END AS kind,
           CASE WHEN event_id % 3 = 0 THEN user_id END AS user_id FROM events)
       WHERE kind IS NOT NULL OR user_id IS NOT NULL""",
)
def pruned(t: Tables) -> DataFrame:
    """All rows that are left of both frames."""
    frames = prune_all_frames(
        {
            "kinds": t.events.selectExpr("IF(event_id % 2 = 0, event_type, NULL) AS kind", "IF(event_id % 3 = 0, user_id, NULL) AS user_id"),
            "flags": t.lineitem.select("l_returnflag", "l_linestatus"),
        }
    )
    rows = [
        frame.select(F.lit(name).alias("frame"), *(F.col(c).cast("string").alias(n) for c, n in zip(frame.columns, ("first", "second"))))
        for name, frame in frames.items()
    ]
    return reduce(DataFrame.unionByName, rows)


_CODES = ("l_returnflag", "l_linestatus", "l_linenumber")


@query(
    "profile_merged",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n, 0 AS cut,
              (SELECT count(*) FROM lineitem) AS n_rows, (SELECT count({c}) FROM lineitem) AS n_values,
              (SELECT count(DISTINCT {c}) FROM lineitem) AS n_distinct
            FROM lineitem WHERE {c} IS NOT NULL GROUP BY 2"""
        for c in _CODES
    ),
)
def profile_merged(t: Tables) -> DataFrame:
    """Columns of codes, profiled per batch and read from the merged profiles: with fewer values than a profile lists,
    nothing in it is estimated."""
    folder = scratch_folder(t.spark)
    rows = t.lineitem.select(*_CODES, (F.col("l_orderkey") % 5).cast("int").alias("batch_id"))
    write_detail(rows, Lake(folder), "codes", "local")
    update_profiles(t.spark, Lake(folder).detail("codes"), f"{folder}/profiles")
    found = profile_report(read_profile(t.spark, f"{folder}/profiles"))
    return found.select("column_name", F.explode("frequent").alias("entry"), "cut", "n_rows", "n_values", "n_distinct").select(
        "column_name", "entry.value", "entry.n", "cut", "n_rows", "n_values", "n_distinct"
    )
