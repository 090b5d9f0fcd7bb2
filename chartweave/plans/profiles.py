"""Profiles of growing tables, kept per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.sketches import PROFILE_DDL, merge_profiles, profile_batch
from ..plans.claims import names
from ..sources.layers import Lake, read_batches
from ..sources.snapshot import loaded_batches


def update_profiles(spark: SparkSession, folder: str, profiles: str, leave_out: tuple[str, ...] = ()) -> int:
    """Profile the batches of a table's folder that have none yet; returns their number.

    A batch that is written again needs its profile removed first; the jobs never rewrite a recorded batch.
    """
    known = {batch for batch in loaded_batches(spark, profiles) if _complete(spark, profiles, *batch)}
    new = [batch for batch in loaded_batches(spark, folder) if batch not in known]
    for source, batch_id in new:
        rows = read_batches(spark, folder, source, batch_id).drop("source", "batch_id", *leave_out)
        found = profile_batch(rows).coalesce(1)
        found.write.mode("overwrite").parquet(Lake.batch(f"{profiles}/source={source}", batch_id))
    return len(new)


def _complete(spark: SparkSession, profiles: str, source: str, batch_id: int) -> bool:
    return any(name.endswith(".parquet") for name in names(spark, Lake.batch(f"{profiles}/source={source}", batch_id)))


def read_profile(spark: SparkSession, profiles: str) -> DataFrame:
    """The profile of all profiled batches; only their profiles are read."""
    rows = spark.read.schema(PROFILE_DDL).option("basePath", profiles).parquet(profiles)
    return merge_profiles(rows.drop("source", "batch_id"))
