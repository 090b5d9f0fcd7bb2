"""Image files as binary rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_images(spark: SparkSession, folder: str, pattern: str = "*.dcm") -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return files.load(folder).select("path", "content")
