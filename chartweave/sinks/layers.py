"""Writers of the three layers.

A batch always overwrites its own folder and nothing else, so running it again after a lost executor or
driver gives the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.star import LOAD
from ..sources.layers import Lake

ROWS_PER_FILE = 5_000_000
#: folders of which a task keeps a file open; only the rows of further folders are sorted by folder
OPEN_FILES = 32
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_bronze(entries: DataFrame, lake: Lake, source: str, batch_id: int | None = None) -> None:
    """Entries by resource type, written from the scan: no shuffle and no sort, a file per task and type. Bundles that could not
    be loaded are stored in the same pass, under a type of their own.

    Without ``batch_id`` the rows name their batches in a column of that name.
    """
    _write(entries, lake.bronze(source), batch_id, "resource_type")


def write_detail(rows: DataFrame, lake: Lake, name: str, source: str, batch_id: int | None = None) -> None:
    _write(rows, f"{lake.detail(name)}/source={source}", batch_id)


def write_star(
    rows: DataFrame, lake: Lake, table, source: str, batch_id: int | None = None, sequence: int | None = None
) -> None:
    """A batch's rows with the sequence number of its load, which orders the loads of all sources.

    Without ``sequence`` the rows' batch id takes its place.
    """
    number = F.col("batch_id") if sequence is None else F.lit(sequence)
    if sequence is None and "batch_id" not in rows.columns:
        number = F.lit(batch_id)
    _write(rows.withColumn(LOAD, number.cast("bigint")), f"{lake.star(table)}/source={source}", batch_id)


def _write(rows: DataFrame, folder: str, batch_id: int | None, *parts: str) -> None:
    _keep_files_open(rows.sparkSession)
    writer = rows if batch_id is None else rows.drop("batch_id")
    writer = writer.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
    if batch_id is None:
        writer = writer.option("partitionOverwriteMode", "dynamic")
        parts = ("batch_id", *parts)
    else:
        folder = Lake.batch(folder, batch_id)
    (writer.partitionBy(*parts) if parts else writer).parquet(folder)


def _keep_files_open(spark: SparkSession) -> None:
    """Let tasks write to several folders at once, unless the session has a number of its own.

    Otherwise every task sorts its rows by folder first, and the wide rows of large tasks are spilled for it. Spark
    takes this number from the session alone. It stays there, since other threads may be writing.
    """
    if int(spark.conf.get(WRITERS, "0")) == 0:
        spark.conf.set(WRITERS, OPEN_FILES)


def save_detail_table(
    rows: DataFrame, name: str, batch_id: int, file_format: str = "orc", source: str | None = None
) -> None:
    """Add one batch to a catalog table that is split by batch, replacing that batch if it is there.

    With ``source`` the table is split by source and batch.
    """
    spark = rows.sparkSession
    parts = {"batch_id": str(int(batch_id))} if source is None else {"source": f"'{source}'", "batch_id": str(int(batch_id))}
    plain = rows.drop(*parts)
    if not spark.catalog.tableExists(name):
        marked = plain
        if source is not None:
            marked = marked.withColumn("source", F.lit(source))
        marked = marked.withColumn("batch_id", F.lit(batch_id))
        marked.write.format(file_format).partitionBy(*parts).saveAsTable(name)
        return
    in_order = plain.select(*[c for c in spark.table(name).columns if c not in parts])
    where = ", ".join(f"{column} = {value}" for column, value in parts.items())
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({where}) SELECT * FROM {{rows}}", rows=in_order)


def save_image_table(metadata: DataFrame, name: str = "image_data", location: str | None = None) -> None:
    writer = metadata.write.mode("overwrite").format("parquet")
    (writer.option("path", location) if location else writer).saveAsTable(name)
