"""The query that makes some documents periodic and finds the runs of all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, table
from .periodic_runs import collapse_runs

SPLIT = r"[\x20\x09-\x0D]+"


def made_periodic(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``: the words of about every tenth document repeat from a place and with a period that
    follow from its id; the others stay as they are, and so do rows with a null id."""
    rows = id_and_text(docs, "doc_id", "text").withColumn("h", F.crc32(F.encode(F.col("id").cast("string"), "UTF-8")))
    words = F.when(F.col("h") % 10 == 0, F.filter(F.split("text", SPLIT), lambda w: w != ""))
    rows = rows.withColumn("words", words).withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    places = "transform(sequence(0, n - 1), i -> words[CAST(IF(i < a, i, a + (i - a) % p) AS INT)])"
    text = F.when(F.col("a").isNotNull(), F.array_join(F.expr(places), " ")).otherwise(F.col("text"))
    return rows.select(F.col("id").alias("doc_id"), text.alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = collapse_runs(made_periodic(table(spark, folder, "documents")))
    return found.select(
        "doc_id",
        "n_runs",
        "start",
        "length",
        "period",
        "exponent_milli",
        F.sha2("runs", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
