"""The query that damages conversations and repairs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .conversations import repair_conversations


def damaged(rows: DataFrame) -> DataFrame:
    """Every row with the damage its number calls for; a row that is dropped stays with ``present`` false.

    Nulls read as one space; an id or turn that is null does so in the number only.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    number = F.crc32(F.encode(key, "UTF-8")) % 20
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    copies = F.when(number == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(number == 4, "user").otherwise(role).alias("role"),
        F.when(number == 1, "").when(number == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (number != 0).alias("present"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    found = repair_conversations(damaged(table(spark, folder, "conversations")), present=F.col("present"))
    return found.withColumn("repaired_sha256", F.sha2("repaired", 256)).drop("repaired")
