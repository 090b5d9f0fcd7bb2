"""Queries of projections, filters, generators, set operations and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartweave.functions import first_of, url_tail
from chartweave.operators.keyed import dedupe_full_row, distinct_rows, latest_per_key, one_per_key, upsert_merge
from chartweave.operators.nested import (
    explode_flatten_all,
    extract_ids,
    first_array_line,
    flatten_struct,
    pair_coordinates,
    split_by_type,
    split_child_tables,
    unnest,
    unnest_cross,
    unnest_zip,
)
from chartweave.plans.details import build
from chartweave.plans.star import STAR, model_table

from .oracle_details import DETAIL_SQL, moment
from .records import RECORDS, Tables, bronze
from .register import query


def data(t: Tables, kind: str) -> DataFrame:
    """Record fields as top-level columns."""
    return RECORDS[kind](t).select("data.*")


# --- projections ---------------------------------------------------------------------------------
@query(
    "nested_field_select",
    """SELECT 'enc-' || o_orderkey AS encounter_id,
         CASE o_orderkey % 3 WHEN 0 THEN 'ambulatory' WHEN 1 THEN 'emergency' ELSE 'inpatient' END AS class_code,
         'urn:uuid:pat-' || o_custkey AS patient_reference
       FROM orders""",
)
def nested_field_select(t: Tables) -> DataFrame:
    return RECORDS["Encounter"](t).select(
        F.col("data.id").alias("encounter_id"),
        F.col("data.class.code").alias("class_code"),
        F.col("data.patient.reference").alias("patient_reference"),
    )


@query(
    "array_first_element",
    """SELECT 'rep-' || o_orderkey AS id,
         CASE WHEN o_orderkey % 4 > 0 THEN 'urn:uuid:obs-' || o_orderkey || '-1' END AS first_result
       FROM orders""",
)
def array_first_element(t: Tables) -> DataFrame:
    return data(t, "DiagnosticReport").select("id", first_of("result")["reference"].alias("first_result"))


@query(
    "array_of_struct_field",
    """SELECT 'rep-' || o_orderkey AS id,
         CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'Line 1' WHEN 2 THEN 'Line 1;Line 2'
           ELSE 'Line 1;Line 2;Line 3' END AS displays
       FROM orders""",
)
def array_of_struct_field(t: Tables) -> DataFrame:
    return data(t, "DiagnosticReport").select("id", F.array_join("result.display", ";").alias("displays"))


@query("select_expr_rename", """SELECT o_orderkey AS encounter_key, o_custkey AS patient_key, o_orderstatus AS status FROM orders""")
def select_expr_rename(t: Tables) -> DataFrame:
    return t.orders.selectExpr("o_orderkey AS encounter_key", "o_custkey AS patient_key", "o_orderstatus AS status")


@query(
    "add_literal_column",
    """SELECT s_suppkey, 'concept' AS unit, CAST(7 AS INTEGER) AS batch_id, CAST(NULL AS VARCHAR) AS note FROM supplier""",
)
def add_literal_column(t: Tables) -> DataFrame:
    return t.supplier.select(
        "s_suppkey", F.lit("concept").alias("unit"), F.lit(7).alias("batch_id"), F.lit(None).cast("string").alias("note")
    )


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def drop_columns(t: Tables) -> DataFrame:
    return t.orders.drop("o_totalprice", "o_orderdate", "o_orderpriority")


@query("rename_columns", "SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey, s_acctbal FROM supplier")
def rename_columns(t: Tables) -> DataFrame:
    return t.supplier.withColumnsRenamed({"s_suppkey": "supplier_id", "s_name": "supplier_name"})


@query("model_table", f"""
    SELECT batch_id, encounter_id AS encounter_key, patient_id AS patient_key, status AS encounter_status,
      class AS encounter_class, type_code AS encounter_type_key, reason_code AS encounter_reason_key,
      CAST(substr("periodStart", 1, 19) AS TIMESTAMP) + INTERVAL 4 HOUR AS period_start,
      CAST(substr("periodEnd", 1, 19) AS TIMESTAMP) + INTERVAL 4 HOUR AS period_end
    FROM ({DETAIL_SQL['encounter']})""")
def modelled(t: Tables) -> DataFrame:
    return model_table(build("encounter", RECORDS["Encounter"](t)), STAR["fact_encounter"])


# --- filters -------------------------------------------------------------------------------------
@query("filter_resource_type", "SELECT 'plan-' || c_custkey AS id FROM customer")
def filter_resource_type(t: Tables) -> DataFrame:
    rows = bronze(t, "Patient", "CarePlan", "AllergyIntolerance")
    return rows.where(F.col("resource_type") == "CarePlan").select(F.col("data.id").alias("id"))


@query(
    "filter_nested_url",
    """SELECT 'pat-' || c_custkey AS id, -(c_nationkey + 0.25::DOUBLE) AS longitude
       FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 11 <> 0""",
)
def filter_nested_url(t: Tables) -> DataFrame:
    homes = data(t, "Patient").select("id", F.explode("address").alias("home"))
    parts = homes.select("id", F.explode("home.extension").alias("ext")).select("id", F.explode("ext.extension").alias("item"))
    return parts.where(F.col("item.url") == "longitude").select("id", F.col("item.valueDecimal").alias("longitude"))


@query("filter_ref_not_null", "SELECT 'proc-' || o_orderkey AS id FROM orders WHERE o_orderkey % 3 = 0")
def filter_ref_not_null(t: Tables) -> DataFrame:
    return data(t, "Procedure").where(F.col("reasonReference").isNotNull()).select("id")


@query("dropna_column", "SELECT event_id, event_type AS kind FROM events WHERE event_id % 3 <> 0")
def dropna_column(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("kind"))
    return rows.dropna(subset=["kind"])


def _gaps(t: Tables) -> DataFrame:
    """Rows with NULL in one, both or no column."""
    key = F.col("event_id")
    return t.events.select(
        F.when(key % 2 == 0, F.col("event_type")).alias("kind"), F.when(key % 3 == 0, F.col("user_id")).alias("user_id")
    )


_GAPS_SQL = """(SELECT CASE WHEN event_id % 2 = 0 THEN event_type END AS kind,
                  CASE WHEN event_id % 3 = 0 THEN user_id END AS user_id FROM events)"""


@query("dropna_all", f"SELECT * FROM {_GAPS_SQL} WHERE kind IS NOT NULL OR user_id IS NOT NULL")
def dropna_all(t: Tables) -> DataFrame:
    return _gaps(t).dropna(how="all")


@query("dropna_subset", f"SELECT * FROM {_GAPS_SQL} WHERE user_id IS NOT NULL")
def dropna_subset(t: Tables) -> DataFrame:
    return _gaps(t).dropna(subset=["user_id"])


# --- generators ----------------------------------------------------------------------------------
@query("explode_coding", "SELECT 'proc-' || o_orderkey AS id, 'P' || (o_orderkey % 20) AS code FROM orders")
def explode_coding(t: Tables) -> DataFrame:
    return unnest(data(t, "Procedure").select("id", "code"), "coding", "code.coding").select("id", "coding.code")


@query(
    "explode_child",
    """SELECT 'rep-' || o_orderkey AS id, 'Line ' || i AS display
       FROM orders JOIN (VALUES (1), (2), (3)) r(i) ON r.i <= o_orderkey % 4""",
)
def explode_child(t: Tables) -> DataFrame:
    return unnest(data(t, "DiagnosticReport").select("id", "result"), "item", "result").select("id", "item.display")


@query(
    "explode_nested",
    """SELECT 'obs-' || l_orderkey || '-' || l_linenumber AS id, p.code,
         CASE WHEN p.code = 'systolic' THEN l_quantity ELSE l_tax END AS value
       FROM lineitem CROSS JOIN (VALUES ('systolic'), ('diastolic')) p(code) WHERE l_linenumber % 3 = 0""",
)
def explode_nested(t: Tables) -> DataFrame:
    parts = unnest(data(t, "Observation").select("id", "component"), "part", "component")
    codes = unnest(parts, "coding", "part.code.coding")
    return codes.select("id", "coding.code", F.col("part.valueQuantity.value").alias("value"))


@query(
    "explode_cross",
    """SELECT 'plan-' || c_custkey AS id, (c_custkey + a.i) % 10 AS activity, c_custkey * 10 + d.j AS address
       FROM customer JOIN (VALUES (1), (2)) a(i) ON a.i <= c_custkey % 3
         JOIN (VALUES (1), (2)) d(j) ON d.j <= 1 + c_custkey % 2""",
)
def explode_cross(t: Tables) -> DataFrame:
    plans = data(t, "CarePlan").select("id", "activity", "addresses")
    rows = unnest_cross(plans, {"step": "activity", "target": "addresses"})
    code = first_of("step.detail.code.coding")["code"]
    return rows.select(
        "id",
        F.substring(code, 2, 10).cast("bigint").alias("activity"),
        F.substring_index("target.reference", "-", -1).cast("bigint").alias("address"),
    )


@query(
    "explode_outer",
    """SELECT 'rep-' || o_orderkey AS id, CASE WHEN i IS NOT NULL THEN 'Line ' || i END AS display
       FROM orders LEFT JOIN (VALUES (1), (2), (3)) r(i) ON r.i <= o_orderkey % 4""",
)
def explode_outer(t: Tables) -> DataFrame:
    rows = unnest(data(t, "DiagnosticReport").select("id", "result"), "item", "result", outer=True)
    return rows.select("id", "item.display")


@query(
    "explode_zip",
    """SELECT 'pat-' || c_custkey AS id, CASE i WHEN 1 THEN 'Given-' || c_custkey || 'a'
           ELSE CASE WHEN c_custkey % 2 = 0 THEN 'Given-' || c_custkey || 'b' END END AS given,
         CASE WHEN i = 1 THEN CASE WHEN c_custkey % 2 = 0 THEN 'Mr.' ELSE 'Ms.' END END AS prefix
       FROM customer JOIN (VALUES (1), (2)) n(i) ON n.i = 1 OR c_custkey % 2 = 0""",
)
def explode_zip(t: Tables) -> DataFrame:
    names = data(t, "Patient").select("id", F.explode("name").alias("name")).select("id", "name.given", "name.prefix")
    return unnest_zip(names, ["given", "prefix"])


@query(
    "join_latlon_pivot",
    """SELECT 'pat-' || c_custkey AS id, c_nationkey + 0.5::DOUBLE AS latitude,
         -(c_nationkey + 0.25::DOUBLE) AS longitude
       FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 11 <> 0""",
)
def latitude_longitude(t: Tables) -> DataFrame:
    homes = data(t, "Patient").select("id", F.explode("address").alias("home"))
    return homes.select("id", F.inline(pair_coordinates(F.col("home"))))


# --- whole-frame reshaping -----------------------------------------------------------------------
@query(
    "flatten_struct",
    f"""SELECT 'proc-' || o_orderkey AS id, 'urn:uuid:pat-' || o_custkey AS subject_reference,
          CASE WHEN o_orderkey % 2 = 0 THEN {moment('o_orderdate')} END AS "performedPeriod_start",
          CASE WHEN o_orderkey % 2 = 0 THEN {moment('o_orderdate + INTERVAL 2 HOUR')} END AS "performedPeriod_end"
        FROM orders""",
)
def flattened(t: Tables) -> DataFrame:
    return flatten_struct(data(t, "Procedure").select("id", "subject", "performedPeriod"))


@query(
    "explode_flatten_all",
    """SELECT 'plan-' || c_custkey AS id, CASE WHEN i IS NOT NULL
           THEN CASE WHEN (c_custkey + i) % 2 = 0 THEN 'in-progress' ELSE 'completed' END END AS "activity.detail.status",
         'A' || ((c_custkey + i) % 10) AS "activity.detail.code.coding.code",
         'Activity ' || ((c_custkey + i) % 10) AS "activity.detail.code.coding.display",
         CASE WHEN i IS NOT NULL THEN 'http://example.org/codes' END AS "activity.detail.code.coding.system",
         'urn:uuid:cond-' || (c_custkey * 10 + j) AS "addresses.reference"
       FROM customer LEFT JOIN (VALUES (1), (2)) a(i) ON a.i <= c_custkey % 3
         JOIN (VALUES (1), (2)) d(j) ON d.j <= 1 + c_custkey % 2""",
)
def flattened_fully(t: Tables) -> DataFrame:
    return explode_flatten_all(data(t, "CarePlan").select("id", "activity", "addresses"))


@query(
    "split_child_tables",
    """SELECT 'Patient' AS name, 'pat-' || c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS first,
         NULL AS second
       FROM customer
       UNION ALL
       SELECT 'Patient.identifier', 'pat-' || c_custkey, 'http://example.org/id/' || k.kind,
         CASE WHEN k.kind = 'mrn' THEN CAST(c_custkey AS VARCHAR) ELSE '999-' || c_custkey END
       FROM customer CROSS JOIN (VALUES ('mrn'), ('ssn')) k(kind)
       UNION ALL
       SELECT 'Patient.telecom', 'pat-' || c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'home' ELSE 'mobile' END,
         '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')
       FROM customer WHERE c_custkey % 13 <> 0""",
)
def child_tables(t: Tables) -> DataFrame:
    """The parent table and both child tables."""
    found = split_child_tables(data(t, "Patient").select("id", "gender", "identifier", "telecom"), "Patient")
    shown = {"Patient": ("id", "gender", None), "Patient.identifier": ("Patient_id", "system", "value"),
             "Patient.telecom": ("Patient_id", "use", "value")}
    rows = [
        found[name].select(
            F.lit(name).alias("name"), F.col(key).alias("id"), F.col(first).alias("first"),
            (F.col(second) if second else F.lit(None).cast("string")).alias("second"),
        )
        for name, (key, first, second) in shown.items()
    ]
    return rows[0].union(rows[1]).union(rows[2])


@query(
    "patient_identifier",
    """SELECT 'pat-' || c_custkey AS "Patient_id", k.kind AS type,
         CASE WHEN k.kind = 'mrn' THEN CAST(c_custkey AS VARCHAR) ELSE '999-' || c_custkey END AS value
       FROM customer CROSS JOIN (VALUES ('mrn'), ('ssn')) k(kind)""",
)
def patient_identifier(t: Tables) -> DataFrame:
    rows = split_child_tables(data(t, "Patient").select("id", "identifier"), "Patient")["Patient.identifier"]
    return rows.select("Patient_id", url_tail("system").alias("type"), "value")


@query(
    "extract_ids",
    """SELECT 'proc-' || o_orderkey AS id, 'pat-' || o_custkey AS subject_id,
         CASE WHEN o_orderkey % 3 = 0 THEN 'cond-' || o_orderkey END AS reason_id
       FROM orders""",
)
def extracted_ids(t: Tables) -> DataFrame:
    reason = F.get_json_object("reasonReference", "$.reference")
    rows = data(t, "Procedure").select("id", F.col("subject.reference").alias("subject.reference"), reason.alias("reason.reference"))
    return extract_ids(rows, "subject.reference", "reason.reference")


@query("split_by_type", "SELECT 'plan-' || c_custkey AS id FROM customer UNION ALL SELECT 'alg-' || s_suppkey FROM supplier")
def split_types(t: Tables) -> DataFrame:
    parts = split_by_type(bronze(t, "Patient", "CarePlan", "AllergyIntolerance"), ["CarePlan", "AllergyIntolerance"])
    return parts["CarePlan"].unionByName(parts["AllergyIntolerance"]).select(F.col("data.id").alias("id"))


@query(
    "first_array_line",
    "SELECT 'pat-' || c_custkey AS id, c_name AS line FROM customer",
)
def first_line(t: Tables) -> DataFrame:
    homes = data(t, "Patient").select("id", F.explode("address").alias("home")).select("id", "home.line")
    return first_array_line(homes, "line")


# --- sets, sorting, deduplication ----------------------------------------------------------------
@query(
    "union_by_name",
    """SELECT o_orderkey AS id, CAST(o_totalprice AS VARCHAR) AS value FROM orders
       UNION ALL SELECT event_id, event_type FROM events""",
)
def union_by_name(t: Tables) -> DataFrame:
    numbers = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("string").alias("value"))
    texts = t.events.select(F.col("event_type").alias("value"), F.col("event_id").alias("id"))
    return numbers.unionByName(texts)


@query(
    "concat_frames",
    """SELECT c_mktsegment AS code FROM customer UNION ALL SELECT p_type FROM part UNION ALL SELECT s_name FROM supplier""",
)
def concat_frames(t: Tables) -> DataFrame:
    return (
        t.customer.selectExpr("c_mktsegment AS code")
        .unionByName(t.part.selectExpr("p_type AS code"))
        .unionByName(t.supplier.selectExpr("s_name AS code"))
    )


@query("distinct_rows", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_pairs(t: Tables) -> DataFrame:
    return distinct_rows(t.part, "p_brand", "p_type")


@query(
    "distinct_resource_types",
    "SELECT * FROM (VALUES ('Patient'), ('CarePlan'), ('AllergyIntolerance')) v(resource_type) "
    "WHERE (SELECT count(*) FROM customer) > 0 AND (SELECT count(*) FROM supplier) > 0",
)
def distinct_resource_types(t: Tables) -> DataFrame:
    return distinct_rows(bronze(t, "Patient", "CarePlan", "AllergyIntolerance").dropna(subset=["resource_type"]), "resource_type")


@query(
    "dedupe_by_key",
    """SELECT DISTINCT ON (l_partkey) l_partkey, l_shipdate, l_quantity FROM lineitem
       ORDER BY l_partkey, l_shipdate, l_quantity""",
)
def dedupe_by_key(t: Tables) -> DataFrame:
    return one_per_key(t.lineitem.select("l_partkey", "l_shipdate", "l_quantity"), "l_partkey", repeats=False)


@query("dedupe_full_row", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def dedupe_rows(t: Tables) -> DataFrame:
    return dedupe_full_row(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"))


@query("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count("*").alias("n_rows"))


@query("sort_paths", "SELECT '/data/' || source || '/' || doc_id AS path FROM documents ORDER BY path")
def sort_paths(t: Tables) -> DataFrame:
    return t.documents.select(F.concat_ws("/", F.lit("/data"), "source", "doc_id").alias("path")).orderBy("path")


_UPDATES_SQL = """
    SELECT l_partkey * 2 AS code, l_linenumber AS batch_id,
      CASE WHEN l_linenumber % 3 <> 0 THEN 'upd ' || l_returnflag || CAST(l_quantity AS INTEGER) END AS name,
      'cat ' || l_linestatus AS category
    FROM lineitem"""


@query(
    "upsert_merge",
    f"""WITH u AS ({_UPDATES_SQL}),
         every_row AS (
           SELECT p_partkey AS code, 0 AS is_new, NULL::INTEGER AS batch_id, p_name AS name, p_type AS category
           FROM part
           UNION ALL SELECT code, 1, batch_id, name, category FROM u)
       SELECT l.code, l.name, f.category
       FROM (SELECT DISTINCT ON (code) code, name FROM every_row
             ORDER BY code, is_new DESC, batch_id DESC NULLS LAST, name DESC NULLS LAST, category DESC NULLS LAST) l
       JOIN (SELECT DISTINCT ON (code) code, category FROM every_row
             ORDER BY code, is_new, batch_id NULLS FIRST, name NULLS FIRST, category NULLS FIRST) f USING (code)""",
)
def upserted(t: Tables) -> DataFrame:
    """Parts merged with several batches of line updates; the category keeps its first value."""
    target = t.part.selectExpr("p_partkey AS code", "p_name AS name", "p_type AS category")
    updates = t.lineitem.selectExpr(
        "l_partkey * 2 AS code",
        "l_linenumber AS batch_id",
        "IF(l_linenumber % 3 <> 0, concat('upd ', l_returnflag, CAST(l_quantity AS INT)), NULL) AS name",
        "concat('cat ', l_linestatus) AS category",
    )
    return upsert_merge(target, updates, ["code"], ["batch_id"], update_cols=["name"])


@query(
    "latest_per_key",
    """SELECT DISTINCT ON (user_id) user_id, event_type, value FROM events
       ORDER BY user_id, ts DESC, event_type DESC, value DESC""",
)
def latest_events(t: Tables) -> DataFrame:
    return latest_per_key(t.events.select("user_id", "ts", "event_type", "value"), ["user_id"], ["ts"])
