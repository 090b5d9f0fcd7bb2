"""Queries of sources, sinks and the batch ledger.

Queries that write use a new folder below the session's shared folder and read their own output back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartweave.functions import epoch_label
from chartweave.operators.imaging import dicom_images, dicom_metadata, imaging_inventory
from chartweave.plans.details import DETAILS, build
from chartweave.plans.jobs import run_each, store_bundles
from chartweave.plans.ledger import Ledger, last_batch, next_batch, of_source, oldest, pending_batches
from chartweave.plans.star import STAR, create_star_tables, load_rows, model_table, star_table
from chartweave.session import scratch_folder, shuffles_released
from chartweave.sinks.jdbc import jdbc_rows
from chartweave.sinks.layers import save_image_table, write_bronze, write_detail, write_star
from chartweave.sinks.snapshot import merge_batches
from chartweave.sources.bundles import (
    bundle_entries,
    parse_bundles,
    read_bundles,
    read_json_inferred,
    rejected_bundles,
    whole_bundles,
)
from chartweave.sources.file_batches import next_folders, outer_folder
from chartweave.sources.image_headers import read_image_headers
from chartweave.sources.images import read_images
from chartweave.sources.layers import Lake, read_bronze, read_detail, read_rejects, read_star
from chartweave.streaming.ingest import bundle_file_stream, ingest_stream, upsert_stream

from .oracle_details import DETAIL_SQL, moment
from .oracle_star import STAR_SQL
from .records import RECORDS, Tables, bronze, bundles, image_files, write_files
from .register import query

SOURCE = "local"
# size of the stream queries' files and epochs
BUNDLES_PER_FILE = 50_000
FILES_PER_EPOCH = 64
LINES_PER_FILE = 100_000
# bundles of a file that is one JSON array
BUNDLES_PER_ARRAY = 1000


def scratch(t: Tables) -> str:
    return scratch_folder(t.spark)


def write_bundles(texts: DataFrame, folder: str) -> None:
    """Bundles a line each, which repeat their field names over and over, in compressed files of bounded size: such a
    file is read by one task."""
    texts.write.mode("append").option("maxRecordsPerFile", BUNDLES_PER_FILE).option("compression", "gzip").text(folder)


ENTRY_SQL = """
    SELECT 'Encounter' AS resource_type, 'enc-' || o_orderkey AS id, o_orderstatus AS status,
      'urn:uuid:pat-' || o_custkey AS reference,
      CASE o_orderkey % 3 WHEN 0 THEN 'ambulatory' WHEN 1 THEN 'emergency' ELSE 'inpatient' END AS class,
      substr(o_orderpriority, 1, 1) AS code
    FROM orders
    UNION ALL SELECT 'Procedure', 'proc-' || o_orderkey, 'completed', 'urn:uuid:pat-' || o_custkey, NULL,
      'P' || (o_orderkey % 20)
    FROM orders"""


def entry_ids(entries: DataFrame) -> DataFrame:
    """Fields of both types, from plain, nested and text columns."""
    first_type = F.get_json_object("data.type", "$[0].coding[0].code")
    return entries.select(
        "resource_type",
        F.col("data.id").alias("id"),
        F.col("data.status").alias("status"),
        F.coalesce("data.patient.reference", "data.subject.reference").alias("reference"),
        F.col("data.class.code").alias("class"),
        F.coalesce(first_type, F.get("data.code.coding", 0)["code"]).alias("code"),
    )


# --- sources -------------------------------------------------------------------------------------
@query("scan_bundle_json", ENTRY_SQL)
def scan_bundle_json(t: Tables) -> DataFrame:
    folder = scratch(t)
    write_bundles(bundles(t), folder)
    return entry_ids(bundle_entries(read_bundles(t.spark, folder, multi_line=False)))


@query("scan_bundle_multiline", ENTRY_SQL)
def scan_bundle_multiline(t: Tables) -> DataFrame:
    """Files that hold their bundles as one JSON value over many lines."""
    folder = scratch(t)
    number = F.regexp_extract("value", "enc-([0-9]+)", 1).cast("bigint")
    spread = F.regexp_replace("value", '(?<="),(?=")', ",\n ")
    files = bundles(t).groupBy(F.floor(number / BUNDLES_PER_ARRAY).alias("part")).agg(F.collect_list(spread).alias("texts"))
    text = F.concat(F.lit("[\n"), F.array_join("texts", ",\n"), F.lit("\n]"))
    files.select("part", text.alias("value")).write.partitionBy("part").text(folder)
    return entry_ids(bundle_entries(read_bundles(t.spark, folder)))


@query(
    "sink_rejects",
    """SELECT 'entry' AS kind, 2 * count(*) FILTER (WHERE o_orderkey % 10 <> 3) AS n FROM orders
       UNION ALL SELECT 'rejected', count(*) FILTER (WHERE o_orderkey % 10 = 3) FROM orders
       UNION ALL SELECT 'in the ledger', count(*) FILTER (WHERE o_orderkey % 10 = 3) FROM orders""",
)
def sink_rejects(t: Tables) -> DataFrame:
    """Bundles of which some are cut off, parsed once into a batch of entries and rejects."""
    folder = scratch(t)
    number = F.regexp_extract("value", "enc-([0-9]+)", 1).cast("bigint")
    cut = F.expr("substring(value, 1, length(value) - 20)")
    write_bundles(bundles(t).select(F.when(number % 10 == 3, cut).otherwise(F.col("value")).alias("value")), f"{folder}/in")
    lake, ledger = Lake(f"{folder}/lake"), Ledger(t.spark, f"{folder}/lake")
    store_bundles(read_bundles(t.spark, f"{folder}/in", multi_line=False), lake, SOURCE, 0, ledger)
    entries = read_bronze(t.spark, lake, SOURCE, 0).where(F.col("data.id").isNotNull())
    counted = [
        entries.agg(F.count("*").alias("n")).select(F.lit("entry").alias("kind"), "n"),
        read_rejects(t.spark, lake, SOURCE, 0).agg(F.count("text").alias("n")).select(F.lit("rejected").alias("kind"), "n"),
        ledger.rejects(SOURCE).select(F.lit("in the ledger").alias("kind"), F.col("n_rejected").alias("n")),
    ]
    return reduce(DataFrame.unionByName, counted)


@query(
    "scan_bundle_rejects",
    """SELECT CASE WHEN o_orderkey % 10 IN (3, 7) THEN 'rejected' ELSE 'whole' END AS kind, count(*) AS n_bundles,
         2 * count(*) FILTER (WHERE o_orderkey % 10 NOT IN (3, 7)) AS n_entries
       FROM orders GROUP BY 1""",
)
def scan_bundle_rejects(t: Tables) -> DataFrame:
    """Some bundles are cut off and some have a field of another type: none of them gets lost."""
    folder = scratch(t)
    number = F.regexp_extract("value", "enc-([0-9]+)", 1).cast("bigint") % 10
    cut = F.expr("substring(value, 1, length(value) - 20)")
    other = F.regexp_replace("value", '^\\{"entry":', '{"entry":"none","was":')
    texts = F.when(number == 3, cut).when(number == 7, other).otherwise(F.col("value"))
    write_bundles(bundles(t).select(texts.alias("value")), folder)
    read = read_bundles(t.spark, folder, multi_line=False)
    good = whole_bundles(read).select(F.lit("whole").alias("kind"), F.size("entry").alias("n"))
    bad = rejected_bundles(read).where(F.length("text") > 0).select(F.lit("rejected").alias("kind"), F.col("n_entries").alias("n"))
    return good.union(bad).groupBy("kind").agg(F.count("*").alias("n_bundles"), F.sum("n").alias("n_entries"))


@query(
    "scan_json_infer",
    """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderpriority, o_totalprice FROM orders""",
)
def scan_json_infer(t: Tables) -> DataFrame:
    folder = scratch(t)
    t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice").write.json(folder)
    return read_json_inferred(t.spark, folder, multi_line=False)


@query(
    "plan_file_batches",
    """SELECT CAST((dense_rank() OVER (ORDER BY source) - 1) // 8 AS INTEGER) AS batch_id,
         '/data/' || source || '/' || lang || '/' || doc_id || '.json' AS path
       FROM documents""",
)
def plan_file_batches(t: Tables) -> DataFrame:
    """Batches planned one after another as the ingest job does, until no folder is left."""
    path = F.concat_ws("/", F.lit("/data"), "source", "lang", F.concat("doc_id", F.lit(".json")))
    files = t.documents.select(path.alias("path")).withColumn("outer", outer_folder(F.col("path"), "/data"))
    folders, ledger = files.select("outer").distinct(), Ledger(t.spark, scratch(t))
    while ledger.claim_folders(SOURCE, lambda taken: next_folders(folders, taken)):
        pass
    return files.join(ledger.folders(SOURCE), "outer").select("batch_id", "path")


#: table, id and key of every resource type
BRONZE_SQL = {
    "Patient": ("customer", "'pat-' || c_custkey", "c_custkey"),
    "Encounter": ("orders", "'enc-' || o_orderkey", "o_orderkey"),
    "Condition": ("events", "'cond-' || event_id", "event_id"),
    "Observation": ("lineitem", "'obs-' || l_orderkey || '-' || l_linenumber", "l_partkey"),
    "MedicationRequest": ("lineitem", "'med-' || l_orderkey || '-' || l_linenumber", "l_partkey"),
    "Immunization": ("events", "'imm-' || event_id", "event_id"),
    "Procedure": ("orders", "'proc-' || o_orderkey", "o_orderkey"),
    "CarePlan": ("customer", "'plan-' || c_custkey", "c_custkey"),
    "DiagnosticReport": ("orders", "'rep-' || o_orderkey", "o_orderkey"),
    "AllergyIntolerance": ("supplier", "'alg-' || s_suppkey", "s_suppkey"),
}


def bronze_sql(where: str = "true") -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({key} % 3 AS INTEGER) AS batch_id, '{kind}' AS resource_type, {identifier} AS id "
        f"FROM {table} WHERE {where.format(key=key)}"
        for kind, (table, identifier, key) in BRONZE_SQL.items()
    )


def write_all_bronze(t: Tables, *kinds: str) -> Lake:
    lake = Lake(scratch(t))
    write_bronze(bronze(t, *kinds), lake, SOURCE)
    return lake


@query("sink_bronze", bronze_sql())
def sink_bronze(t: Tables) -> DataFrame:
    lake = write_all_bronze(t, *BRONZE_SQL)
    return read_bronze(t.spark, lake, SOURCE).select("batch_id", "resource_type", F.col("data.id").alias("id"))


@query("scan_bronze_batch", bronze_sql("{key} % 3 = 1"))
def scan_bronze_batch(t: Tables) -> DataFrame:
    lake = write_all_bronze(t, *BRONZE_SQL)
    return read_bronze(t.spark, lake, SOURCE, 1).select("batch_id", "resource_type", F.col("data.id").alias("id"))


def write_details(t: Tables, name: str, kind: str) -> Lake:
    lake = Lake(scratch(t))
    write_detail(build(name, RECORDS[kind](t)), lake, name, SOURCE)
    return lake


@query("sink_silver", DETAIL_SQL["procedure"])
def sink_silver(t: Tables) -> DataFrame:
    return read_detail(t.spark, write_details(t, "procedure", "Procedure"), "procedure", SOURCE)


@query("scan_model_input", STAR_SQL["fact_procedure"])
def scan_model_input(t: Tables) -> DataFrame:
    """A star table as model training reads it: all batches, from its folder."""
    lake, table = Lake(scratch(t)), STAR["fact_procedure"]
    write_star(load_rows(build(table.source, RECORDS["Procedure"](t)), table), lake, table, SOURCE)
    return read_star(t.spark, lake, table)


@query("scan_silver_batch", f"SELECT * FROM ({DETAIL_SQL['immunization']}) WHERE batch_id = 2")
def scan_silver_batch(t: Tables) -> DataFrame:
    return read_detail(t.spark, write_details(t, "immunization", "Immunization"), "immunization", SOURCE, 2)


@query(
    "sink_jdbc",
    """SELECT DISTINCT CAST(o_orderkey % 3 AS INTEGER) AS batch_id, 'P' || (o_orderkey % 20) AS procedure_type_key,
         'Procedure ' || (o_orderkey % 20) || ' b' || (o_orderkey % 3) AS procedure_type_name
       FROM orders""",
)
def sink_jdbc(t: Tables) -> DataFrame:
    """What goes to the database: no server runs here, so the query ends at the deduplicated rows."""
    return jdbc_rows(model_table(build("procedure_type", RECORDS["Procedure"](t)), STAR["dim_procedure_type"]))


@query(
    "sink_modeled_all",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, count(*) AS n_rows, count(\"{column}\") AS n_values, "
        f"count(DISTINCT \"{column}\") AS n_distinct FROM ({STAR_SQL[name]})"
        for name, table in STAR.items()
        for column in table.columns
    ),
)
def sink_modeled_all(t: Tables) -> DataFrame:
    """Every star table written in batches and read back: what readers see of each of its columns."""
    lake = Lake(scratch(t))
    current = {}

    def load(name: str, table) -> None:
        write_star(load_rows(build(table.source, RECORDS[DETAILS[table.source].resource](t)), table), lake, table, SOURCE)
        current[name] = read_star(t.spark, lake, table)
        if table.key is not None:  # merged once, as each column is read on its own
            current[name].write.parquet(f"{lake.root}/current/{name}")
            current[name] = t.spark.read.parquet(f"{lake.root}/current/{name}")

    with shuffles_released(t.spark):
        run_each(STAR, load)
        for name, table in STAR.items():  # one table's shuffles at a time
            column_counts({name: current[name]}, {name: table.key}).write.parquet(f"{lake.root}/counts/{name}")
    return t.spark.read.parquet(*[f"{lake.root}/counts/{name}" for name in STAR])


def column_counts(tables: dict[str, DataFrame], keys: dict[str, str | None]) -> DataFrame:
    """``(table_name, column_name, n_rows, n_values, n_distinct)`` of every column.

    Each column is read and grouped on its own, so rows are not multiplied by their columns, a column of few values
    is reduced before its shuffle, and only the numbers go on from there. Values of a key, which do not repeat, are
    dealt out as they are.
    """
    names, groups = [], []
    for name, rows in tables.items():
        for column in rows.columns:
            values = rows.select(F.col(column).alias("value"))
            grouped = (values.repartition("value") if column == keys[name] else values).groupBy("value")
            texts = [F.lit(name).alias("table_name"), F.lit(column).alias("column_name")]
            names.append(F.struct(*texts, F.lit(0).cast("bigint").alias("n"), F.lit(False).alias("filled")))
            counted = grouped.agg(F.count(F.lit(1)).alias("n"))
            groups.append(counted.select(*texts, "n", F.col("value").isNotNull().alias("filled")))
    # columns of empty tables have no groups
    nothing = groups[0].sparkSession.range(1).select(F.inline(F.array(*names)))
    return reduce(DataFrame.union, groups, nothing).groupBy("table_name", "column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("filled"), F.col("n")).otherwise(0)).alias("n_values"),
        F.count_if("filled").alias("n_distinct"),
    )


@query(
    "gold_ddl_cast",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, '{field.type}' AS data_type, count(*) AS n_rows, "
        f"count(\"{column}\") AS n_values, CAST(min(\"{column}\") AS VARCHAR) AS least FROM ({STAR_SQL[name]})"
        if field.type in ("string", "int", "date")
        else f"SELECT '{name}', '{column}', '{field.type}', count(*), count(\"{column}\"), NULL FROM ({STAR_SQL[name]})"
        for name, table in STAR.items()
        for column, field in table.fields.items()
    ),
)
def gold_ddl_cast(t: Tables) -> DataFrame:
    """All tables of the defined star schema filled, and what they hold under their declared column types."""
    folder = scratch(t)
    prefix = folder.rsplit("/", 1)[1].replace("-", "_") + "_"
    create_star_tables(t.spark, folder, prefix)

    def fill(_: str, table) -> None:
        details = build(table.source, RECORDS[DETAILS[table.source].resource](t))
        star_table(details, table).write.insertInto(f"{prefix}{table.full_name}")

    def summary(name: str, table) -> DataFrame:
        stored = t.spark.read.schema(table.ddl).parquet(f"{folder}/{table.full_name}")
        counts, fields = [F.count(F.lit(1)).alias("n_rows")], []
        for place, (column, field) in enumerate(table.fields.items()):
            plain = field.type in ("string", "int", "date")
            least = F.min(column).cast("string") if plain else F.max(F.lit(None).cast("string"))
            counts += [F.count(column).alias(f"n{place}"), least.alias(f"l{place}")]
            texts = {"table_name": name, "column_name": column, "data_type": stored.schema[column].dataType.simpleString()}
            values = [F.col("n_rows"), F.col(f"n{place}").alias("n_values"), F.col(f"l{place}").alias("least")]
            fields.append(F.struct(*(F.lit(v).alias(k) for k, v in texts.items()), *values))
        return stored.agg(*counts).select(F.inline(F.array(*fields)))

    with shuffles_released(t.spark):
        run_each(STAR, fill)
    for group in dict.fromkeys(s.group for s in STAR.values()):
        t.spark.sql(f"DROP DATABASE {prefix}{group} CASCADE")  # the definitions; the files stay in their folder
    return reduce(DataFrame.unionByName, [summary(name, table) for name, table in STAR.items()])


def read_after_merges(t: Tables, name: str) -> DataFrame:
    """A keyed table of three batches: the second and then the first are merged, the third is not."""
    lake, table = Lake(scratch(t)), STAR[name]
    rows = load_rows(build(table.source, RECORDS[DETAILS[table.source].resource](t)), table)
    write_star(rows, lake, table, SOURCE)
    for batch_id in (1, 0):
        merge_batches(t.spark, lake, table, [(SOURCE, batch_id)])
    return read_star(t.spark, lake, table)


@query("merged_facts", STAR_SQL["fact_encounter"])
def merged_facts(t: Tables) -> DataFrame:
    return read_after_merges(t, "fact_encounter")


@query("merged_codes", STAR_SQL["dim_condition_code"])
def merged_codes(t: Tables) -> DataFrame:
    """Merged rows of a table in which one column keeps its first value."""
    return read_after_merges(t, "dim_condition_code")


# --- images --------------------------------------------------------------------------------------
HEADER_SQL = """
    SELECT 'images/' || (p_partkey % 50) || '/' || p_partkey || '.dcm' AS file_path,
      CASE WHEN p_partkey % 10 <> 9 THEN 'pat-' || p_partkey END AS patient_id,
      CASE WHEN p_partkey % 10 <> 9
        THEN strftime(DATE '2020-01-01' + CAST(p_partkey % 30 AS INTEGER), '%Y%m%d') END AS study_date,
      CASE WHEN p_partkey % 10 <> 9 THEN CASE WHEN p_size % 2 = 0 THEN 'CT' ELSE 'MR' END END AS modality,
      CASE WHEN p_partkey % 10 <> 9 THEN p_type END AS study_description,
      CASE WHEN p_partkey % 10 <> 9 AND p_partkey % 4 <> 0 THEN p_brand END AS series_description,
      p_partkey % 10 = 9 AS failed
    FROM part"""


def header_columns(metadata: DataFrame) -> DataFrame:
    return metadata.select(
        "file_path",
        F.col("metadata.PatientID").alias("patient_id"),
        F.col("metadata.StudyDate").alias("study_date"),
        F.col("metadata.Modality").alias("modality"),
        F.col("metadata.StudyDescription").alias("study_description"),
        F.col("metadata.SeriesDescription").alias("series_description"),
        F.col("error").isNotNull().alias("failed"),
    )


@query("dicom_metadata", HEADER_SQL)
def dicom_headers(t: Tables) -> DataFrame:
    return header_columns(dicom_metadata(image_files(t)))


@query("image_header_ranges", HEADER_SQL)
def image_header_ranges(t: Tables) -> DataFrame:
    """The same files in folders, each of them read up to its last wanted field."""
    folder = scratch(t)
    write_files(image_files(t), folder).write.format("noop").mode("overwrite").save()
    found = header_columns(read_image_headers(t.spark, folder))
    return found.withColumn("file_path", F.regexp_extract("file_path", "(images/.*)$", 1))


@query(
    "dicom_pixels",
    """SELECT 'images/' || (p_partkey % 50) || '/' || p_partkey || '.dcm' AS file_path,
         CASE WHEN p_partkey % 10 <> 9 THEN 'pat-' || p_partkey END AS patient_id,
         CASE WHEN p_partkey % 10 <> 9 THEN (p_partkey % 256) || ',0,1,255' END AS pixels, p_partkey % 10 = 9 AS failed
       FROM part""",
)
def image_pixels(t: Tables) -> DataFrame:
    rows = dicom_images(image_files(t))
    return rows.select(
        "file_path",
        F.col("metadata.PatientID").alias("patient_id"),
        F.array_join("image_data", ",").alias("pixels"),
        F.col("error").isNotNull().alias("failed"),
    )


@query("sink_binary_meta", HEADER_SQL)
def sink_binary_meta(t: Tables) -> DataFrame:
    folder = scratch(t)
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    save_image_table(dicom_metadata(image_files(t)), name, folder)
    stored = t.spark.read.parquet(folder)
    t.spark.sql(f"DROP TABLE {name}")  # the definition; the files stay in their folder
    return header_columns(stored)


@query(
    "scan_binary_files",
    """SELECT 'part-' || (o_orderkey % 7) AS folder, count(*) AS n_lines FROM orders GROUP BY 1""",
)
def scan_binary_files(t: Tables) -> DataFrame:
    """Text files of bounded size written per folder, read back as binary content; lines are counted from the bytes."""
    folder = scratch(t)
    lines = t.orders.select(F.concat(F.lit("part-"), F.col("o_orderkey") % 7).alias("folder"), F.col("o_orderpriority").alias("value"))
    lines.write.partitionBy("folder").option("maxRecordsPerFile", LINES_PER_FILE).text(folder)
    files = read_images(t.spark, folder, "*.txt")
    text = F.col("content").cast("string")
    return (
        files.select(F.regexp_extract("path", "folder=([^/]+)", 1).alias("folder"), (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))).alias("n"))
        .groupBy("folder")
        .agg(F.sum("n").alias("n_lines"))
    )


@query(
    "imaging_inventory",
    f"""SELECT modality, study_date, count(*) AS n_images,
          count(*) FILTER (WHERE patient_id IN (SELECT 'pat-' || c_custkey FROM customer)) AS n_known_patient
        FROM ({HEADER_SQL}) WHERE NOT failed GROUP BY 1, 2""",
)
def image_inventory(t: Tables) -> DataFrame:
    patients = build("patient", RECORDS["Patient"](t))
    return imaging_inventory(dicom_metadata(image_files(t)), patients)


# --- ledger --------------------------------------------------------------------------------------
def ledgers(t: Tables) -> dict[str, DataFrame]:
    """Ledger rows of the three layers from orders: 97 batches of two sources."""
    batch = F.col("o_orderkey") % 97
    rows = t.orders.select(
        batch.cast("int").alias("batch_id"),
        F.col("o_orderdate").cast("timestamp").alias("save_ts"),
        F.when(batch % 5 == 0, "stream").otherwise("local").alias("source"),
    )
    return {
        "bronze": rows,
        "silver": rows.where(F.col("batch_id") % 3 != 0),
        "gold": rows.where(F.col("batch_id") % 4 == 1),
    }


LEDGER_SQL = """(SELECT CAST(o_orderkey % 97 AS INTEGER) AS batch_id, o_orderdate AS save_ts,
                   CASE WHEN (o_orderkey % 97) % 5 = 0 THEN 'stream' ELSE 'local' END AS source FROM orders)"""


@query("ledger_max", f"SELECT max(batch_id) AS batch_id FROM {LEDGER_SQL} WHERE source = 'local'")
def ledger_max(t: Tables) -> DataFrame:
    return last_batch(ledgers(t)["bronze"], "local")


@query("ledger_next", f"SELECT coalesce(max(batch_id) + 1, 0) AS batch_id FROM {LEDGER_SQL} WHERE source = 'stream'")
def ledger_next(t: Tables) -> DataFrame:
    return next_batch(ledgers(t)["bronze"], "stream")


@query("filter_ledger_source", f"SELECT * FROM {LEDGER_SQL} WHERE source = 'stream'")
def filter_ledger_source(t: Tables) -> DataFrame:
    return of_source(ledgers(t)["bronze"], "stream")


PENDING_SILVER = f"""SELECT batch_id, min(save_ts) AS save_ts FROM {LEDGER_SQL}
    WHERE source = 'local' AND batch_id NOT IN
      (SELECT batch_id FROM {LEDGER_SQL} WHERE source = 'local' AND batch_id % 3 <> 0) GROUP BY 1"""


@query("anti_join_next_batch", PENDING_SILVER)
def anti_join_next_batch(t: Tables) -> DataFrame:
    layers = ledgers(t)
    return pending_batches(layers["bronze"], layers["silver"], "local")


@query(
    "anti_join_unmodeled",
    f"""SELECT batch_id, min(save_ts) AS save_ts FROM {LEDGER_SQL}
        WHERE source = 'local' AND batch_id % 3 <> 0 AND batch_id % 4 <> 1 GROUP BY 1""",
)
def anti_join_unmodeled(t: Tables) -> DataFrame:
    layers = ledgers(t)
    return pending_batches(layers["silver"], layers["gold"], "local", match_source=False)


@query("order_limit_one", f"SELECT * FROM ({PENDING_SILVER}) ORDER BY save_ts, batch_id LIMIT 1")
def order_limit_one(t: Tables) -> DataFrame:
    layers = ledgers(t)
    return oldest(pending_batches(layers["bronze"], layers["silver"], "local"))


@query("temp_views", f"SELECT * FROM ({PENDING_SILVER}) ORDER BY save_ts, batch_id LIMIT 1")
def temp_views(t: Tables) -> DataFrame:
    layers = ledgers(t)
    layers["bronze"].createOrReplaceTempView("ingested_batches")
    layers["silver"].createOrReplaceTempView("transformed_batches")
    return t.spark.sql(
        """
        WITH ready AS (
          SELECT batch_id, min(save_ts) AS save_ts FROM ingested_batches WHERE source = 'local' GROUP BY batch_id)
        SELECT ready.* FROM ready
        LEFT ANTI JOIN (SELECT DISTINCT batch_id FROM transformed_batches WHERE source = 'local') done
          ON ready.batch_id = done.batch_id
        ORDER BY save_ts, batch_id LIMIT 1
        """
    )


@query("ledger_create", f"SELECT batch_id, min(save_ts) AS save_ts FROM {LEDGER_SQL} WHERE source = 'local' GROUP BY 1")
def ledger_create(t: Tables) -> DataFrame:
    """Beside a new, empty ledger every batch is still to do."""
    ledger = Ledger(t.spark, scratch(t))
    return pending_batches(ledgers(t)["bronze"], ledger.read("silver"), "local")


@query(
    "ledger_claims",
    f"""SELECT batch_id, source, dense_rank() OVER (ORDER BY save_ts, batch_id, source) AS load
        FROM (SELECT batch_id, source, min(save_ts) AS save_ts FROM {LEDGER_SQL} GROUP BY 1, 2)""",
)
def ledger_claims(t: Tables) -> DataFrame:
    """Load numbers of all batches in the order of their first save; each is asked for twice."""
    ledger = Ledger(t.spark, scratch(t))
    first = ledgers(t)["bronze"].groupBy("batch_id", "source").agg(F.min("save_ts").alias("save_ts"))
    batches = [(r.batch_id, r.source) for r in first.orderBy("save_ts", "batch_id", "source").collect()]
    numbers = [(*batch, ledger.load_number(*batch)) for _ in range(2) for batch in batches]
    return t.spark.createDataFrame(numbers, "batch_id INT, source STRING, load BIGINT").distinct()


@query(
    "ledger_append",
    """SELECT CAST(max(o_orderkey % 97) AS INTEGER) AS batch_id, 'local' AS source, true AS has_time FROM orders
       UNION ALL SELECT CAST(min(o_orderkey % 97) AS INTEGER), 'local', true FROM orders""",
)
def ledger_append(t: Tables) -> DataFrame:
    ledger = Ledger(t.spark, scratch(t))
    ends = ledgers(t)["bronze"].agg(F.max("batch_id").alias("last"), F.min("batch_id").alias("first")).first()
    for batch_id in (ends["last"], ends["first"], ends["last"]):
        ledger.record("silver", batch_id, "local")
    return ledger.read("silver").select("batch_id", "source", F.col("save_ts").isNotNull().alias("has_time"))


@query(
    "current_timestamp",
    """SELECT DISTINCT CAST(o_orderkey % 97 AS INTEGER) AS batch_id, true AS later_than_data FROM orders""",
)
def stamped(t: Tables) -> DataFrame:
    rows = ledgers(t)["bronze"].groupBy("batch_id").agg(F.max("save_ts").alias("newest"))
    return rows.select("batch_id", (F.current_timestamp() > F.col("newest")).alias("later_than_data"))


@query(
    "epoch_batch_label",
    "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS label FROM events",
)
def epoch_batch_label(t: Tables) -> DataFrame:
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return t.events.select("event_id", epoch_label(seconds).alias("label"))


# --- streams -------------------------------------------------------------------------------------
@query("stream_ingest", ENTRY_SQL)
def stream_ingest(t: Tables) -> DataFrame:
    folder = scratch(t)
    write_bundles(bundles(t), f"{folder}/in")
    lake = Lake(f"{folder}/lake")
    stream = bundle_file_stream(t.spark, f"{folder}/in", multi_line=False, files_per_batch=FILES_PER_EPOCH)
    ingest_stream(t.spark, stream, lake, f"{folder}/progress")
    return entry_ids(read_bronze(t.spark, lake, "stream"))


@query(
    "stream_upsert",
    f"""SELECT 'enc-' || o_orderkey AS encounter_key, o_orderstatus AS encounter_status,
          CASE WHEN o_orderkey % 6 = 0 THEN 'F' ELSE substr(o_orderpriority, 1, 1) END AS encounter_type_key,
          CAST(substr({moment('o_orderdate')}, 1, 19) AS TIMESTAMP) + INTERVAL 4 HOUR AS period_start
        FROM orders""",
)
def stream_upsert(t: Tables) -> DataFrame:
    """All encounters arrive twice, in the same stream stopped and started again: first in an older state."""
    folder = scratch(t)
    lake = Lake(f"{folder}/lake")
    old = bundles(t).select(F.regexp_replace("value", '"status":"[^"]*"', '"status":"older"').alias("value"))
    for texts in (old, bundles(t)):
        write_bundles(texts, f"{folder}/in")
        stream = bundle_file_stream(t.spark, f"{folder}/in", multi_line=False, files_per_batch=FILES_PER_EPOCH)
        upsert_stream(t.spark, stream, ["fact_encounter"], lake, f"{folder}/progress")
    rows = read_star(t.spark, lake, "fact_encounter")
    return rows.select("encounter_key", "encounter_status", "encounter_type_key", "period_start")


@query("explode_entries", ENTRY_SQL)
def explode_entries(t: Tables) -> DataFrame:
    return entry_ids(bundle_entries(parse_bundles(bundles(t))))


@query("group_collect_entries", bronze_sql())
def group_collect_entries(t: Tables) -> DataFrame:
    """Entries by type. Collecting a type's entries and exploding them again gives the rows back, so the
    plan only drops the NULL entries and needs no shuffle."""
    rows = bronze(t, *BRONZE_SQL).where(F.col("data").isNotNull())
    return rows.select("batch_id", "resource_type", F.col("data.id").alias("id"))

