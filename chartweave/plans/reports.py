"""Reports over merged tables that follow their merges.

A report's groups are kept per bucket of the merged table. A merge that overwrites rows writes their buckets anew, so
the groups of those buckets are replaced and the old rows' share is gone with them; those of all other buckets stay.
Any measure will do whose values for parts of the rows can be merged: counts, sums, least and greatest values.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import star_join
from ..operators.keyed import state_rows
from ..plans.claims import names, publish, remove, text_of
from ..sources.layers import Lake
from ..sources.snapshot import BUCKET, Manifest, bucket_of, latest, merged_states
from .star import StarTable

MERGED = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}


@dataclass(frozen=True)
class Report:
    """``groups`` are expressions by name, ``measures`` pairs (count, sum, min or max; expression) by name."""

    name: str
    table: StarTable
    groups: dict[str, str]
    measures: dict[str, tuple[str, str]]

    def of_rows(self, rows: DataFrame, *more: str) -> DataFrame:
        groups = [F.expr(value).alias(name) for name, value in self.groups.items()]
        measures = [F.expr(f"{how}({value})").alias(name) for name, (how, value) in self.measures.items()]
        return rows.groupBy(*more, *groups).agg(*measures)

    def of_parts(self, parts: DataFrame) -> DataFrame:
        measures = [F.expr(f"{MERGED[how]}({name})").alias(name) for name, (how, _) in self.measures.items()]
        return parts.groupBy(*self.groups).agg(*measures)


def _parts_of(manifest: Manifest) -> dict[str, set[int]]:
    """Buckets that are read from each merge's folder."""
    found: dict[str, set[int]] = {}
    for bucket, place in manifest.folders.items():
        found.setdefault(place.split("/")[0], set()).add(bucket)
    return found


def refresh_report(spark: SparkSession, lake: Lake, report: Report, manifest: Manifest | None = None) -> int:
    """Compute the groups of the buckets written since the last time; returns the number of those buckets."""
    folder, rows_folder = f"{lake.root}/reports/{report.name}", lake.merged(report.table)
    manifest = manifest or latest(spark, rows_folder)
    if manifest is None:
        return 0
    parts, known, done = _parts_of(manifest), names(spark, f"{folder}/known"), 0
    for merge, buckets in parts.items():
        if merge not in known:
            states = merged_states(spark, rows_folder, manifest, report.table, buckets)
            bucket = bucket_of(report.table, manifest.buckets).alias(BUCKET)
            rows = state_rows(states, [report.table.key], report.table.columns, report.table.keep_first)
            written = uuid.uuid4().hex
            report.of_rows(rows.select(bucket, "*"), BUCKET).coalesce(1).write.parquet(f"{folder}/parts/{written}")
            if not publish(spark, f"{folder}/known/{merge}", written):
                remove(spark, f"{folder}/parts/{written}")  # another job was first
            done += len(buckets)
    return done


def read_report(
    spark: SparkSession, lake: Lake, report: Report, dimensions: dict[str, DataFrame] | None = None
) -> DataFrame:
    """The report over all merged batches, with the attributes of the dimensions by the key column that names them."""
    folder, manifest = f"{lake.root}/reports/{report.name}", latest(spark, lake.merged(report.table))
    if manifest is None:
        raise ValueError(f"{report.table.full_name} has not been merged")
    refresh_report(spark, lake, report, manifest)
    parts = [
        spark.read.parquet(f"{folder}/parts/{text_of(spark, f'{folder}/known/{merge}')}").where(F.col(BUCKET).isin(*buckets))
        for merge, buckets in _parts_of(manifest).items()
    ]
    if not parts:
        rows = spark.createDataFrame([], report.table.ddl)
        return star_join(report.of_rows(rows), dimensions or {})
    return star_join(report.of_parts(reduce(DataFrame.unionByName, parts)), dimensions or {})
