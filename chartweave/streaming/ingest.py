"""Streams of bundles and of star-table updates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.details import build
from ..plans.jobs import run_each, store_bundles
from ..plans.ledger import Ledger
from ..plans.star import STAR, StarTable, load_rows
from ..schemas import BUNDLE_DDL
from ..sinks.layers import write_star
from ..sources.bundles import BROKEN, parse_bundles
from ..sources.layers import Lake, read_bronze

SOURCE = "stream"


def bundle_file_stream(spark: SparkSession, folder: str, multi_line: bool = True, files_per_batch: int | None = None):
    """New bundle files below a folder."""
    reader = spark.readStream.schema(f"{BUNDLE_DDL}, {BROKEN} STRING").option("columnNameOfCorruptRecord", BROKEN)
    reader = reader.option("multiLine", multi_line).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def bundle_queue_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Bundles as queue messages, one per message (needs the queue connector on the class path).

    A new stream starts with the oldest message the queue holds; later runs go on from their checkpoint.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", "earliest")
    return parse_bundles(reader.load(), "value")


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what is there, then stop; a restart goes on where the checkpoint ends."""
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def ingest_stream(spark: SparkSession, bundles: DataFrame, lake: Lake, checkpoint: str, source: str = SOURCE):
    """Each micro-batch becomes the bronze batch of its epoch number. A replayed epoch overwrites itself.

    A micro-batch is parsed once; bundles that can't be read are kept with it, and the ledger counts them.
    """
    ledger = Ledger(spark, lake.root)

    def each(batch: DataFrame, epoch: int) -> None:
        store_bundles(batch, lake, source, epoch, ledger)
        ledger.record("bronze", epoch, source)

    return run_available(bundles, checkpoint, each)


def upsert_stream(
    spark: SparkSession, bundles: DataFrame, tables: list[str], lake: Lake, checkpoint: str, source: str = SOURCE
):
    """Each micro-batch of bundles goes into the named star tables, by way of its bronze batch.

    An epoch's load number is written down before its rows. An epoch that is replayed, after whatever other loads,
    keeps it, so its rows stay behind theirs. Broken bundles are kept and counted as in :func:`ingest_stream`.
    """
    ledger = Ledger(spark, lake.root)

    def each(batch: DataFrame, epoch: int) -> None:
        store_bundles(batch, lake, source, epoch, ledger)
        ledger.record("bronze", epoch, source)
        bronze, number = read_bronze(spark, lake, source, epoch), ledger.load_number(epoch, source)

        def load(_: str, table: StarTable) -> None:
            write_star(load_rows(build(table.source, bronze), table), lake, table, source, epoch, number)

        run_each({name: STAR[name] for name in tables}, load)
        ledger.record("gold", epoch, source)

    return run_available(bundles, checkpoint, each)
