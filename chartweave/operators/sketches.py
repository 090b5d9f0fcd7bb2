"""Column profiles that can be merged: counts, distinct values, quantiles and frequent values per batch.

A profile is one small row per column. Profiles of batches merge into the profile of all their rows, so a growing
table is profiled by its new batches only.

Errors of a merged profile, whatever the number of batches: row and value counts are exact; ``n_distinct`` is within
5 % with a chance of 99.7 % (HyperLogLog with 2**12 registers: standard error 1.6 %); the share of values at or below
a quantile is within 0.02 of the asked one with a chance of 99 % (KLL with ``k`` 200); the count of a frequent value
is exact or too low by at most ``cut``, and every value with more than ``cut`` rows is listed. ``cut`` is the sum,
over the batches, of the largest count that a batch's list left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, TimestampType

TOP = 64
QUANTILES = (0.25, 0.5, 0.75)
FREQUENT = "ARRAY<STRUCT<value: STRING, n: BIGINT>>"
PROFILE_DDL = (
    "column_name STRING, data_type STRING, n_rows BIGINT, n_values BIGINT, distinct_sketch BINARY, "
    f"quantile_sketch BINARY, frequent {FREQUENT}, cut BIGINT"
)


def _number(column: Column, kind: DataType) -> Column | None:
    """What quantiles are taken of: numbers, days since 1970, seconds since 1970."""
    if isinstance(kind, NumericType):
        return column.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, TimestampType):
        return column.cast("double")
    return None


def profile_batch(df: DataFrame, top: int = TOP) -> DataFrame:
    """The profile of one batch, with the columns of ``PROFILE_DDL``. Nulls are counted as rows only; values are
    compared as text. An empty batch has a profile without values."""
    aggregates, lines = [F.count(F.lit(1)).alias("n_rows")], []
    for place, field in enumerate(df.schema.fields):
        column = F.col(f"`{field.name}`")
        number = _number(column, field.dataType)
        quantile = F.lit(None).cast("binary") if number is None else F.kll_sketch_agg_double(number)
        aggregates += [
            F.count(column).alias(f"n{place}"),
            F.hll_sketch_agg(_text(column, field.dataType)).alias(f"d{place}"),
            (F.max(quantile) if number is None else quantile).alias(f"q{place}"),
        ]
        lines.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col("n_rows"),
                F.col(f"n{place}").alias("n_values"),
                F.col(f"d{place}").alias("distinct_sketch"),
                F.when(F.col(f"n{place}") > 0, F.col(f"q{place}")).alias("quantile_sketch"),
            )
        )
    sketches = df.agg(*aggregates).select(F.inline(F.array(*lines)))
    values = [
        F.struct(F.lit(f.name).alias("column_name"), _text(F.col(f"`{f.name}`"), f.dataType).alias("value"))
        for f in df.schema.fields
    ]
    counted = df.select(F.inline(F.array(*values))).where("value IS NOT NULL")
    counted = counted.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    listed = _listed(counted.withColumn("cut", F.lit(0).cast("bigint")), top)
    return _with_lists(sketches, listed)


def _text(column: Column, kind: DataType) -> Column:
    simple = isinstance(kind, (NumericType, DateType, TimestampType)) or kind.simpleString() in ("string", "boolean")
    return column.cast("string") if simple else F.when(column.isNotNull(), F.to_json(F.struct(column.alias("v"))))


def _listed(counted: DataFrame, top: int) -> DataFrame:
    """``(column_name, frequent, cut)``: the most frequent values and the largest count not among them.

    Only ``top + 1`` values of a column leave a task, since the filter on the row number limits every sort.
    """
    best = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    rows = counted.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top + 1)
    kept = F.when(F.col("place") <= top, F.struct("place", F.struct("value", "n").alias("entry")))
    return rows.groupBy("column_name").agg(
        F.transform(F.array_sort(F.collect_list(kept)), lambda e: e["entry"]).alias("frequent"),
        F.coalesce(F.max(F.when(F.col("place") > top, F.col("n"))), F.lit(0)).alias("cut"),
    )


def _with_lists(sketches: DataFrame, listed: DataFrame) -> DataFrame:
    joined = sketches.join(listed, "column_name", "left")
    lists = {"frequent": F.coalesce("frequent", F.array().cast(FREQUENT)), "cut": F.coalesce("cut", F.lit(0))}
    return joined.withColumns(lists).select(*_names())


def _names() -> list[str]:
    return "column_name data_type n_rows n_values distinct_sketch quantile_sketch frequent cut".split()


def merge_profiles(profiles: DataFrame, top: int = TOP) -> DataFrame:
    """Profiles of batches, several rows per column, to the profile of all their rows."""
    sketches = profiles.groupBy("column_name").agg(
        F.max("data_type").alias("data_type"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
        F.count("quantile_sketch").alias("n_sketches"),
        F.sum("cut").alias("left_out"),
    )
    quantile = F.when(F.col("n_sketches") > 0, F.col("quantile_sketch"))  # of none a merge makes an empty one
    counted = profiles.select("column_name", F.explode("frequent").alias("entry"))
    counted = counted.groupBy("column_name", F.col("entry.value").alias("value")).agg(F.sum("entry.n").alias("n"))
    listed = _listed(counted, top)
    merged = _with_lists(sketches.withColumn("quantile_sketch", quantile), listed)
    # what a batch left out and what this list leaves out may be the same value
    left_out = sketches.select("column_name", "left_out")
    return merged.join(left_out, "column_name").withColumn("cut", F.col("cut") + F.col("left_out")).select(*_names())


def profile_report(profile: DataFrame, quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """``(column_name, data_type, n_rows, n_values, n_distinct, quantiles, frequent, cut)`` of a profile; quantiles of
    text columns are null."""
    asked = F.array(*(F.lit(q) for q in quantiles))
    return profile.select(
        "column_name",
        "data_type",
        "n_rows",
        "n_values",
        F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"),
        F.kll_sketch_get_quantile_double("quantile_sketch", asked).alias("quantiles"),
        "frequent",
        "cut",
    )
