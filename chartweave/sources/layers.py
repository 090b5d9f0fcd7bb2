"""Folders of the three layers and how they are read back.

Every layer is split by source and batch in its folder names, so reading or rewriting one batch touches
only that batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..plans.star import STAR, StarTable, current_rows
from ..schemas import RESOURCE_DDL
from .bundles import REJECT_DDL, REJECTED
from .snapshot import read_merged


@dataclass(frozen=True)
class Lake:
    root: str

    def bronze(self, source: str) -> str:
        return f"{self.root}/bronze/{source}"

    def detail(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def star(self, table: StarTable) -> str:
        return f"{self.root}/gold/{table.full_name}"

    def merged(self, table: StarTable) -> str:
        return f"{self.root}/merged/{table.full_name}"

    def profiles(self, name: str) -> str:
        return f"{self.root}/profiles/{name}"

    @staticmethod
    def batch(folder: str, batch_id: int) -> str:
        return f"{folder}/batch_id={batch_id}"


def read_bronze(spark: SparkSession, lake: Lake, source: str, batch_id: int | None = None) -> DataFrame:
    """``(batch_id, resource_type, data)``; the first two are folder names, so filters on them prune files."""
    rows = _bronze(spark, lake, source, batch_id, f"data {RESOURCE_DDL}")
    return rows.where(rows.resource_type != REJECTED).select("batch_id", "resource_type", "data")


def read_rejects(spark: SparkSession, lake: Lake, source: str, batch_id: int | None = None) -> DataFrame:
    """``(batch_id, path, n_entries, text)`` of the bundles that could not be loaded."""
    rows = _bronze(spark, lake, source, batch_id, f"reject {REJECT_DDL}")
    return rows.where(rows.resource_type == REJECTED).select("batch_id", "reject.*")


def _bronze(spark: SparkSession, lake: Lake, source: str, batch_id: int | None, column: str) -> DataFrame:
    folder = lake.bronze(source)
    reader = spark.read.schema(f"{column}, batch_id INT, resource_type STRING").option("basePath", folder)
    rows = reader.parquet(folder if batch_id is None else lake.batch(folder, batch_id))  # only this batch is listed
    return rows if batch_id is None else rows.where(rows.batch_id == batch_id)


def read_batches(spark: SparkSession, folder: str, source: str | None = None, batch_id: int | None = None) -> DataFrame:
    """Batches of a table with ``source`` and ``batch_id`` from the folder names.

    With both given only that batch's folder is listed, however long the history is.
    """
    path = folder if source is None else f"{folder}/source={source}"
    if source is not None and batch_id is not None:
        path = Lake.batch(path, batch_id)
    return spark.read.option("basePath", folder).option("mergeSchema", False).parquet(path)


def read_detail(
    spark: SparkSession, lake: Lake, name: str, source: str | None = None, batch_id: int | None = None
) -> DataFrame:
    rows = read_batches(spark, lake.detail(name), source, batch_id)
    if source is None and batch_id is not None:
        rows = rows.where(rows.batch_id == batch_id)
    return rows.drop("source")


def read_star(spark: SparkSession, lake: Lake, table: StarTable | str) -> DataFrame:
    """The current rows of a star table over all loaded batches.

    Of a keyed table that has been merged, only the merged rows and the batches after them are listed and read.
    """
    table = STAR[table] if isinstance(table, str) else table
    if table.key is not None:
        merged = read_merged(spark, lake.star(table), lake.merged(table), table)
        if merged is not None:
            return merged
    return current_rows(read_batches(spark, lake.star(table)), table)
