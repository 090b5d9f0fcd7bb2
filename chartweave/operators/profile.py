"""Profiling and cleaning of whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StringType, StructType

from ..functions.scalars import first_of, url_tail


def value_counts(df: DataFrame, name: str, top: int | None = None) -> DataFrame:
    """Frequency of each non-NULL value, most frequent first; ``top`` keeps the head of the report."""
    counts = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n")).orderBy(F.desc("n"), name)
    return counts if top is None else counts.limit(top)


def unique_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(name).distinct()


def frame_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, non-NULL count. A single aggregate reads the table once."""
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema.fields)])
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"c{i}").alias("non_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def prune_frame(df: DataFrame) -> DataFrame:
    """Without all-NULL rows and without repeated rows."""
    filled = F.coalesce(*[F.when(F.col(f"`{c}`").isNotNull(), True) for c in df.columns])
    return df.where(filled).dropDuplicates()


def prune_all_frames(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: prune_frame(tables[name]) for name in sorted(tables)}


def convert_dtypes(df: DataFrame) -> DataFrame:
    """Cast text and floating columns to the narrowest type that keeps every value.

    Text is cast only if casting back gives the same text for every value, so leading zeros stay. One aggregate over the table counts, per column and candidate type, the values that survive the cast;
    only that single row of counts reaches the driver.
    """
    tests: dict[tuple[str, str], Column] = {}
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType):
            for kind in ("bigint", "double", "boolean"):
                tests[field.name, kind] = value.isNotNull() & ~value.try_cast(kind).cast("string").eqNullSafe(value)
        elif isinstance(field.dataType, (DoubleType, FloatType)):
            whole = value.try_cast("bigint")
            tests[field.name, "bigint"] = value.isNotNull() & (whole.isNull() | (whole.cast("double") != value))
    if not tests:
        return df
    checks = list(tests)
    lost = df.agg(
        *[F.count_if(tests[c]).alias(f"t{i}") for i, c in enumerate(checks)],
        *[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(df.schema.fields)],
    ).first()
    filled = {f.name: lost[f"n{i}"] for i, f in enumerate(df.schema.fields)}
    chosen: dict[str, str] = {}
    for i, (name, kind) in enumerate(checks):
        if filled[name] and lost[f"t{i}"] == 0:
            chosen.setdefault(name, kind)
    return df.select(
        *[F.col(f"`{c}`").cast(chosen[c]).alias(c) if c in chosen else F.col(f"`{c}`") for c in df.columns]
    )


def typed_extension_columns(
    df: DataFrame, extensions: Column, value: str | None = None, names: list[str] | None = None
) -> DataFrame:
    """A column per extension name (the tail of its url) that holds the extension's value.

    ``value`` names one value field, whose type is kept; without it, the first filled ``value...`` field counts, as
    text (structs and lists as JSON). Without ``names``, the names come from a pass over the data.
    """
    kind = df.select(extensions.alias("e")).schema["e"].dataType.elementType
    fields = [value] if value else [f.name for f in kind.fields if f.name.startswith("value")]

    def as_text(ext: Column, name: str) -> Column:
        nested = isinstance(kind[name].dataType, (ArrayType, StructType))
        return F.to_json(ext[name]) if nested else ext[name].cast("string")

    def content(ext: Column) -> Column:
        return ext[value] if value else F.coalesce(*[as_text(ext, name) for name in fields])

    def found(name: str) -> Column:
        hits = F.filter(extensions, lambda ext: url_tail(ext["url"]) == name)
        return first_of(F.transform(hits, content))

    if names is None:  # as many as the result has columns
        tails = df.select(F.explode(F.transform(extensions, lambda ext: url_tail(ext["url"]))).alias("name"))
        names = sorted(r["name"] for r in tails.where("name <> ''").distinct().collect())
    return df.withColumns({name: found(name) for name in names})
