"""Queries of scalar expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartweave.functions import (
    CONDITION_RULES,
    best_value,
    condition_category,
    dosage_class,
    dosage_class_of_flag,
    first_of,
    join_displays,
    multiple_birth,
    parse_date,
    parse_timestamp,
    path_tail,
    period_bound,
    ref_to_id,
    struct_from_json,
    url_tail,
)
from chartweave.functions.clinical import lower_contains

from .oracle_details import DETAIL_SQL, moment
from .records import Tables
from .register import query
from .shape_queries import data


@query(
    "ref_to_id",
    """SELECT page_id, regexp_extract(url, '([^:]*)$', 1) AS id, 'page-' || page_id AS own_id FROM pages""",
)
def reference_ids(t: Tables) -> DataFrame:
    own = F.concat(F.lit("urn:uuid:page-"), "page_id")
    return t.pages.select("page_id", ref_to_id("url").alias("id"), ref_to_id(own).alias("own_id"))


@query("path_tail", "SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS tail FROM pages")
def path_tails(t: Tables) -> DataFrame:
    return t.pages.select("page_id", path_tail("url").alias("tail"))


@query("regex_tail", "SELECT page_id, regexp_extract(url, '([^/]+)$', 1) AS tail FROM pages")
def url_tails(t: Tables) -> DataFrame:
    return t.pages.select("page_id", url_tail("url").alias("tail"))


@query(
    "join_displays",
    """SELECT 'pat-' || c_custkey AS id, c_mktsegment || ',' || r_name AS joined, c_mktsegment || r_name AS run_on
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def joined_displays(t: Tables) -> DataFrame:
    codings = first_of("extension")["valueCodeableConcept"]["coding"]
    return data(t, "Patient").select("id", join_displays(codings).alias("joined"), join_displays(codings, "").alias("run_on"))


@query(
    "concat_ws",
    """SELECT o_orderkey, concat_ws(', ', CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END,
         CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END) AS label FROM orders""",
)
def joined_text(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "o_orderkey",
        "concat_ws(', ', IF(o_orderkey % 2 = 0, o_orderstatus, NULL), IF(o_orderkey % 3 = 0, o_orderpriority, NULL)) AS label",
    )


@query("case_first_non_null", f"""SELECT patient_id, value FROM ({DETAIL_SQL['patient_extension']})""")
def first_filled_value(t: Tables) -> DataFrame:
    rows = data(t, "Patient").select(F.col("id").alias("patient_id"), F.explode("extension").alias("extra"))
    return rows.select("patient_id", best_value("extra").alias("value"))


@query(
    "case_dosage_class",
    """SELECT 'med-' || l_orderkey || '-' || l_linenumber AS id,
         CASE l_linenumber % 4 WHEN 0 THEN 'no instructions' WHEN 2 THEN 'as needed' ELSE 'scheduled' END AS class
       FROM lineitem""",
)
def dosage_classes(t: Tables) -> DataFrame:
    return data(t, "MedicationRequest").select("id", dosage_class("dosageInstruction").alias("class"))


@query(
    "dosage_class_of_flag",
    """SELECT 'med-' || l_orderkey || '-' || l_linenumber AS id,
         CASE l_linenumber % 4 WHEN 2 THEN 'as needed' WHEN 3 THEN 'scheduled' ELSE 'no instructions' END AS class
       FROM lineitem""",
)
def flag_classes(t: Tables) -> DataFrame:
    """The class by the first dosage's flag, which a missing list lacks as well as an empty one."""
    flag = first_of("dosageInstruction")["asNeededBoolean"]
    return data(t, "MedicationRequest").select("id", dosage_class_of_flag(flag).alias("class"))


@query(
    "last_filled_value",
    """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'text ' || c_custkey WHEN c_custkey % 3 = 0 THEN 'code'
         WHEN c_custkey % 2 = 0 THEN c_mktsegment || ', ' || c_custkey WHEN c_custkey % 7 = 0 THEN 'AB' END AS value
       FROM customer""",
)
def last_value(t: Tables) -> DataFrame:
    """Extensions with several filled-in values."""
    extension = F.expr(
        """named_struct(
          'valueCodeableConcept', IF(c_custkey % 7 = 0,
            named_struct('coding', array(named_struct('display', 'A'), named_struct('display', 'B'))), NULL),
          'valueAddress', IF(c_custkey % 2 = 0,
            named_struct('city', c_mktsegment, 'state', CAST(c_custkey AS STRING)), NULL),
          'valueCode', IF(c_custkey % 3 = 0, 'code', NULL),
          'valueString', IF(c_custkey % 5 = 0, concat('text ', c_custkey), NULL))"""
    )
    return t.customer.select("c_custkey", extension.alias("e")).select("c_custkey", best_value("e", last=True).alias("value"))


@query("case_multiple_birth", f"""SELECT patient_id AS id, "multipleBirth" AS multiple_birth FROM ({DETAIL_SQL['patient']})""")
def births(t: Tables) -> DataFrame:
    return data(t, "Patient").select("id", multiple_birth("multipleBirthBoolean", "multipleBirthInteger").alias("multiple_birth"))


@query(
    "coalesce_period",
    f"""SELECT 'proc-' || o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN {moment('o_orderdate + INTERVAL 2 HOUR')}
          ELSE {moment('o_orderdate')} END AS performed_end FROM orders""",
)
def period_ends(t: Tables) -> DataFrame:
    return data(t, "Procedure").select("id", period_bound("performedPeriod.end", "performedDateTime").alias("performed_end"))


@query("nullif_ref", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'cond-' || o_orderkey END AS reason_id FROM orders")
def optional_reference(t: Tables) -> DataFrame:
    reference = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("urn:uuid:cond-"), "o_orderkey"))
    return t.orders.select("o_orderkey", ref_to_id(reference).alias("reason_id"))


@query("json_parse_field", "SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events")
def json_field(t: Tables) -> DataFrame:
    return t.events.select("event_id", struct_from_json("props", "STRUCT<k: INT>")["k"].alias("k"))


_WORDS = ["asthma", "brain", "colon", "hand", "burn"]


@query(
    "lower_contains",
    "SELECT doc_id, " + " OR ".join(f"contains(lower(text), '{w}')" for w in _WORDS) + " AS mentioned FROM documents",
)
def mentioned_words(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", lower_contains("text", _WORDS).alias("mentioned"))


# Written out on purpose, not built from the rules it checks.
_CATEGORY_SQL = r"""CASE
  WHEN regexp_matches(lowered, 'diabetes|insulin|retinopathy|microalbuminuria') THEN 'Endocrine / Metabolic'
  WHEN regexp_matches(lowered, 'cardiac arrest|hypertension') THEN 'Cardiology'
  WHEN regexp_matches(lowered, 'fracture|injury|sprain|concussion|osteoarthritis|meniscus|laceration|rupture of patellar|thigh|hand|foot|burn|wound|rupture|bullet')
    THEN 'Trauma / Musculoskeletal'
  WHEN regexp_matches(lowered, 'cancer|neoplasm|tumor|carcinoma') THEN 'Oncology'
  WHEN regexp_matches(lowered, 'asthma|bronchitis|sinusitis|copd|pneumonia|emphysema|pharyngitis|sore throat|bronch') THEN 'Respiratory'
  WHEN regexp_matches(lowered, 'rheumatoid|gout|fibromyalgia') THEN 'Rheumatology'
  WHEN regexp_matches(lowered, 'rhinitis|otitis|allergic reaction') THEN 'ENT / Allergy'
  WHEN regexp_matches(lowered, 'migraine|stroke|brain|paralysis|alzheimer|dementia') THEN 'Neurological'
  WHEN regexp_matches(lowered, 'attention deficit|adhd|autism') THEN 'Mental / Behavioral'
  WHEN regexp_matches(lowered, 'pregnancy|miscarriage|eclampsia|infertility|uterine|ovum') THEN 'Reproductive / Obstetrics'
  WHEN regexp_matches(lowered, 'urinary|kidney|renal|cystitis|pyelonephritis') THEN 'Urology / Nephrology'
  WHEN regexp_matches(lowered, 'appendicitis|bleeding from anus|colon|diarrhea|rectal|polyp') THEN 'Gastroenterology'
  WHEN regexp_matches(lowered, 'history of appendectomy|history of amputation|history of cardiac arrest') THEN 'Post-surgical History'
  WHEN regexp_matches(lowered, 'overdose') THEN 'Toxicology'
  ELSE 'Other' END"""

# One display per category, and some that match two rules or none.
_DISPLAYS = [
    "Diabetes mellitus", "HYPERTENSION", "Sprain of ankle", "Lung cancer", "COPD", "Gout", "Otitis media", "Stroke",
    "ADHD", "Miscarriage", "Kidney stone", "Appendicitis", "History of appendectomy", "Drug overdose", "Normal",
    "History of cardiac arrest", "Acute bronchitis with injury", "Polyp of colon", "Perennial allergic rhinitis",
]
_DISPLAY_SQL = f"list_value({', '.join(repr(d) for d in _DISPLAYS)})[CAST(event_id % {len(_DISPLAYS)} AS INTEGER) + 1]"


@query(
    "categorize_keywords",
    f"""SELECT id, {_CATEGORY_SQL} AS category
        FROM (SELECT doc_id AS id, lower(text) AS lowered FROM documents
              UNION ALL SELECT -event_id, lower({_DISPLAY_SQL}) FROM events)""",
)
def categorized(t: Tables) -> DataFrame:
    """Texts of documents, and displays that reach every category."""
    names = F.array(*[F.lit(d) for d in _DISPLAYS])
    display = F.element_at(names, (F.col("event_id") % len(_DISPLAYS) + 1).cast("int"))
    texts = t.documents.select(F.col("doc_id").alias("id"), "text").union(t.events.select(-F.col("event_id"), display))
    return texts.select("id", condition_category("text").alias("category"))


@query(
    "conditional_assign",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE o_orderpriority END AS state FROM orders",
)
def conditional_assign(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "done").otherwise(F.col("o_orderpriority")).alias("state")
    )


@query(
    "string_concat",
    "SELECT o_orderkey, o_orderpriority || '_' || CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS key FROM orders",
)
def string_concat(t: Tables) -> DataFrame:
    return t.orders.selectExpr("o_orderkey", "concat(o_orderpriority, '_', IF(o_orderkey % 2 = 0, o_orderstatus, NULL)) AS key")


@query("size", "SELECT 'rep-' || o_orderkey AS id, CAST(o_orderkey % 4 AS INTEGER) AS n_results FROM orders")
def array_size(t: Tables) -> DataFrame:
    return data(t, "DiagnosticReport").select("id", F.size("result").alias("n_results"))


@query("cast_int", "SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS is_positive FROM supplier")
def cast_int(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", (F.col("s_acctbal") > 0).cast("int").alias("is_positive"))



@query("parse_date", "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(ts AS DATE) END AS day FROM events")
def dates(t: Tables) -> DataFrame:
    text = (
        F.when(F.col("event_id") % 7 == 0, "unknown")
        .when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-04:00")))
    )
    return t.events.select("event_id", parse_date(text).alias("day"))


_TIMES_SQL = """
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts)
      WHEN 1 THEN date_trunc('millisecond', ts) + INTERVAL 4 HOUR END AS at
    FROM events"""


def _times(t: Tables) -> DataFrame:
    """Text with zone letter, with offset and fraction, and without a time."""
    key = F.col("event_id") % 3
    text = (
        F.when(key == 0, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(key == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("-04:00")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    return t.events.select("event_id", text.alias("text"))


@query("parse_timestamp", _TIMES_SQL)
def timestamps(t: Tables) -> DataFrame:
    return _times(t).select("event_id", parse_timestamp("text").alias("at"))


@query(
    "pandas_to_datetime",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts)
         WHEN 1 THEN date_trunc('millisecond', ts) + INTERVAL 4 HOUR ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS at
       FROM events""",
)
def iso_moments(t: Tables) -> DataFrame:
    """Any ISO text to an instant: with a time and offset, or a bare date at midnight."""
    return _times(t).select("event_id", F.coalesce(parse_timestamp("text"), parse_date("text").cast("timestamp")).alias("at"))


@query(
    "array_join_category",
    """SELECT 'alg-' || s_suppkey AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'food,environment' ELSE 'food' END AS category
       FROM supplier""",
)
def joined_categories(t: Tables) -> DataFrame:
    return data(t, "AllergyIntolerance").select("id", F.array_join("category", ",").alias("category"))
