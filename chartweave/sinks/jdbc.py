"""Append to a database."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.keyed import dedupe_full_row


def jdbc_rows(rows: DataFrame) -> DataFrame:
    return dedupe_full_row(rows)


def write_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = 16) -> None:
    """Deduplicated rows over a bounded number of connections. Each partition commits on its own, so the
    target should merge by key or be a staging table."""
    options = {"isolationLevel": "NONE", "numPartitions": str(connections), **properties}
    writer = jdbc_rows(rows).write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
    writer.options(**options).save()
