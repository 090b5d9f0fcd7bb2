"""Bundle files and bundle text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BUNDLE_DDL


BROKEN = "_broken"
#: the type under which bundles that can't be loaded are stored beside their batch's entries
REJECTED = "_rejected"
REJECT_DDL = "STRUCT<path: STRING, n_entries: INT, text: STRING>"


def read_bundles(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    """Bundle files with the fixed schema: no inference pass, and the same columns in every batch.

    A text that does not parse, or has a field of another type, is kept whole in ``_broken``.
    """
    reader = spark.read.schema(f"{BUNDLE_DDL}, {BROKEN} STRING").option("columnNameOfCorruptRecord", BROKEN)
    return reader.option("multiLine", multi_line).json(paths)


def whole_bundles(bundles: DataFrame) -> DataFrame:
    return bundles.where(F.col(BROKEN).isNull()).drop(BROKEN)


def rejected_bundles(bundles: DataFrame) -> DataFrame:
    """``(path, n_entries, text)`` of the bundles that can't be loaded as they are."""
    return bundles.where(F.col(BROKEN).isNotNull()).select(
        F.input_file_name().alias("path"),
        F.coalesce(F.size("entry"), F.lit(0)).alias("n_entries"),  # entries that could be read
        F.col(BROKEN).alias("text"),
    )


def bundle_rows(bundles: DataFrame) -> DataFrame:
    """All that bundles hold, from one parse: ``(resource_type, data, reject)``.

    An entry is a row without ``reject``. A bundle that can't be loaded as it is is one row of the type
    ``REJECTED`` with its ``path``, the number of entries that could be read, and its text.
    """
    whole = F.col(BROKEN).isNull()
    reject = F.struct(
        F.input_file_name().alias("path"),
        F.coalesce(F.size("entry"), F.lit(0)).alias("n_entries"),
        F.col(BROKEN).alias("text"),
    )
    rows = bundles.select(
        F.explode_outer(F.when(whole, F.col("entry"))).alias("entry"), F.when(~whole, reject).alias("reject")
    )
    kind = F.when(F.col("reject").isNotNull(), REJECTED).otherwise(F.col("entry.resource.resourceType"))
    rows = rows.select(kind.alias("resource_type"), F.col("entry.resource").alias("data"), "reject")
    return rows.dropna(subset=["resource_type"])


def read_json_inferred(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    """Exploration only: the schema comes from a pass over the data."""
    return spark.read.option("multiLine", multi_line).json(paths)


def schema_rows(df: DataFrame) -> DataFrame:
    """Top-level columns and types of a frame as rows."""
    fields = [
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"))
        for f in df.schema.fields
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*fields)))


def parse_bundles(texts: DataFrame, name: str = "value") -> DataFrame:
    """Bundles that arrive as text, one per row (a message queue, a line-delimited file)."""
    text = F.col(name).cast("string")
    bundle = F.from_json(text, f"{BUNDLE_DDL}, {BROKEN} STRING", {"columnNameOfCorruptRecord": BROKEN})
    return texts.select(bundle.alias("bundle")).select("bundle.entry", f"bundle.{BROKEN}")


def bundle_entries(bundles: DataFrame) -> DataFrame:
    """One row per entry as ``(resource_type, data)``; entries without a resource type are left out.

    The outer form is used because for the inner one the optimizer adds a filter on the array's size, and
    pushes it below the parsing of bundle text, which is then parsed again for the filter. Bundles without
    entries leave with the missing resource type.
    """
    entries = bundles.select(F.explode_outer("entry").alias("entry")).select(
        F.col("entry.resource.resourceType").alias("resource_type"), F.col("entry.resource").alias("data")
    )
    return entries.dropna(subset=["resource_type"])


def list_files(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """Paths below a folder. The content column is not selected, so no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return files.load(folder).select("path")
