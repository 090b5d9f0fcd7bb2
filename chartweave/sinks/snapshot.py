"""Merging batches of keyed star tables into their stored rows."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from ..operators.keyed import union_states
from ..plans.claims import names, publish, remove, text_of
from ..plans.star import StarTable
from ..sources.layers import Lake
from ..sources.snapshot import (
    BUCKET,
    Manifest,
    batch_states,
    bucket_of,
    latest,
    manifest_path,
    merged_states,
    versions,
)

FIRST_BUCKETS = 16
#: average rows of a bucket above which a merge doubles the number of buckets
ROWS_PER_BUCKET = 2_000_000
KEPT_VERSIONS = 3
#: folders that no kept manifest names are removed after this time, when no merge can still be writing them
UNUSED_HOURS = 24.0


def merge_batches(
    spark: SparkSession,
    lake: Lake,
    table: StarTable,
    batches: list[tuple[str, int]],
    first_buckets: int = FIRST_BUCKETS,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> Manifest | None:
    """Merge the named batches that are not merged yet; returns the table's manifest then, None without batches.

    Only buckets that hold one of the batches' keys are read and written. Of two merges at once the first to publish
    wins, and the other starts again from its result, so no batch is lost or merged into rows that lack another.
    A batch must not change after it was merged, so only batches that the ledger has recorded should be named.
    """
    folder = lake.merged(table)
    while True:
        current = latest(spark, folder) or Manifest(-1, first_buckets)
        new = [b for b in batches if not current.has(*b)]
        if not new:
            return None if current.version < 0 else current
        buckets = current.buckets
        while sum(current.rows.values()) > rows_per_bucket * buckets:
            buckets *= 2
        place = bucket_of(table, buckets).alias(BUCKET)
        states = batch_states(spark, lake.star(table), new, table)
        chosen = None
        if buckets == current.buckets:  # at most as many numbers as there are buckets
            chosen = {row[BUCKET] for row in states.select(place).distinct().collect()}
        old = merged_states(spark, folder, current, table, chosen)
        # one shuffle puts a bucket's keys together for the merge and for its one file
        both = old.unionByName(states).withColumn(BUCKET, place)
        tasks = buckets if chosen is None else max(1, len(chosen))
        merged = union_states(both.repartition(tasks, BUCKET), [BUCKET, table.key])
        written = f"{current.version + 1}-{uuid.uuid4().hex}"
        merged.write.partitionBy(BUCKET).parquet(f"{folder}/rows/{written}")
        found = _written(spark, f"{folder}/rows/{written}", table)
        kept = set() if chosen is None else set(current.folders) - chosen
        manifest = Manifest(
            current.version + 1,
            buckets,
            {b: current.folders[b] for b in kept} | {b: f"{written}/{BUCKET}={b}" for b in found},
            {b: current.rows[b] for b in kept} | found,
            current.with_batches(new),
        )
        if publish(spark, manifest_path(folder, manifest.version), manifest.text()):
            _drop_unused(spark, folder)
            return manifest
        remove(spark, f"{folder}/rows/{written}")


def _written(spark: SparkSession, path: str, table: StarTable) -> dict[int, int]:
    """Rows per bucket, from the files' footers."""
    rows = spark.read.schema(f"{table.key} {table.fields[table.key].type}, {BUCKET} INT").parquet(path)
    return {row[BUCKET]: row["count"] for row in rows.groupBy(BUCKET).count().collect()}


def _drop_unused(spark: SparkSession, folder: str) -> None:
    known = versions(spark, folder)
    used = {
        place.split("/")[0]
        for version in known[-KEPT_VERSIONS:]
        for place in Manifest.of(text_of(spark, manifest_path(folder, version))).folders.values()
    }
    for name, age in names(spark, f"{folder}/rows").items():
        if name not in used and age > UNUSED_HOURS * 3600:
            remove(spark, f"{folder}/rows/{name}")
