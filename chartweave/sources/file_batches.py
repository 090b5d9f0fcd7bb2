"""Grouping of files into batches by their outer folder."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_FOLDERS = 8
GLOB_CHARACTERS = r"[\[\]{}*?\\]"


def outer_folder(path: Column, folder: str) -> Column:
    """First path segment below ``folder``; NULL for files that do not lie two levels down."""
    root = folder.rstrip("/") + "/"
    start = F.instr(path, root)
    segments = F.split(F.substring(path, start + F.lit(len(root)), F.length(path)), "/")
    return F.when((start > 0) & (F.size(segments) == 3), F.element_at(segments, 1))


def list_outer(spark: SparkSession, folder: str) -> DataFrame:
    """The folders right below ``folder``; nothing deeper is listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [(status.getPath().getName(),) for status in found if status.isDirectory()]
    return spark.createDataFrame(names, "outer STRING")


def next_folders(outer: DataFrame, taken: DataFrame, folders_per_batch: int = BATCH_FOLDERS) -> list[str]:
    """The first folders by name that none has taken; at most one batch's names reach the driver."""
    waiting = outer.join(taken.select("outer"), "outer", "left_anti").orderBy("outer").limit(folders_per_batch)
    return [row["outer"] for row in waiting.collect()]


def batch_globs(names: list[str], folder: str) -> list[str]:
    """Reader patterns of the files two levels below ``folder`` in the named folders."""

    def plain(text: str) -> str:
        return re.sub(GLOB_CHARACTERS, lambda m: chr(92) + m[0], text)

    return [f"{plain(folder.rstrip('/'))}/{plain(name)}/*/*.json" for name in sorted(names)]
