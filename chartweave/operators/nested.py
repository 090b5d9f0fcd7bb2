"""Reshaping of nested columns: arrays to rows, structs to columns, lists to child tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..functions.scalars import column, first_of, ref_to_id


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def unnest(df: DataFrame, name: str, array: Column | str, outer: bool = False) -> DataFrame:
    """One row per array element as column ``name``; ``outer`` keeps rows without elements."""
    generator = F.explode_outer if outer else F.explode
    return df.withColumn(name, generator(column(array)))


def unnest_cross(df: DataFrame, arrays: dict[str, Column | str], outer: bool = False) -> DataFrame:
    """Per-row cross product of independent arrays."""
    for name, array in arrays.items():
        df = unnest(df, name, array, outer)
    return df


def unnest_zip(df: DataFrame, names: list[str], outer: bool = True) -> DataFrame:
    """Explode several arrays side by side: the n-th elements share a row."""
    generator = F.inline_outer if outer else F.inline
    rest = [_quoted(c) for c in df.columns if c not in names]
    return df.select(*rest, generator(F.arrays_zip(*[_quoted(n) for n in names])))


def flatten_struct(df: DataFrame, separator: str = "_") -> DataFrame:
    """Lift the fields of every struct column one level up, named ``column<sep>field``."""
    out = []
    for field in df.schema.fields:
        if isinstance(field.dataType, StructType):
            out += [
                _quoted(field.name).getField(sub).alias(f"{field.name}{separator}{sub}")
                for sub in field.dataType.names
            ]
        else:
            out.append(_quoted(field.name))
    return df.select(*out)


def explode_flatten_all(df: DataFrame, separator: str = ".") -> DataFrame:
    """Explode arrays and lift structs until every column is flat.

    The loop runs over the schema on the driver and only builds the plan; rows multiply by the size of
    each array, and an empty array keeps its row.
    """
    while True:
        arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]
        if not arrays and not any(isinstance(f.dataType, StructType) for f in df.schema.fields):
            return df
        for name in arrays:
            df = df.select(*[F.explode_outer(_quoted(c)).alias(c) if c == name else _quoted(c) for c in df.columns])
        df = flatten_struct(df, separator)


def split_child_tables(df: DataFrame, parent: str, id_column: str = "id") -> dict[str, DataFrame]:
    """Move each list column into a table ``parent.column`` that keeps the parent's id."""
    arrays = [f for f in df.schema.fields if isinstance(f.dataType, ArrayType)]
    tables = {parent: df.drop(*[f.name for f in arrays])}
    for field in arrays:
        key = _quoted(id_column).alias(f"{parent}_id")
        if isinstance(field.dataType.elementType, StructType):
            tables[f"{parent}.{field.name}"] = df.select(key, F.inline(_quoted(field.name)))
        else:
            tables[f"{parent}.{field.name}"] = df.select(key, F.explode(_quoted(field.name)).alias(field.name))
    return tables


def first_array_line(df: DataFrame, *names: str) -> DataFrame:
    """Replace each named array by its first element."""
    return df.withColumns({name: first_of(_quoted(name)) for name in names})


def extract_ids(df: DataFrame, *references: str) -> DataFrame:
    """Replace each reference column ``x.reference`` (or ``x``) by ``x_id``; NULL stays NULL."""
    ids = [ref_to_id(_quoted(name)).alias(name.split(".")[0] + "_id") for name in references]
    return df.select(*[_quoted(c) for c in df.columns if c not in references], *ids)


def split_by_type(df: DataFrame, types: list[str], type_column: str = "resource_type") -> dict[str, DataFrame]:
    """One lazy frame per type. The types are given, so building the plan runs no job."""
    return {kind: df.where(F.col(type_column) == kind) for kind in types}


def pair_coordinates(address: Column) -> Column:
    """All (latitude, longitude) pairs of an address, found inside the row without a self-join."""
    # a NULL inner list must not wipe out the lists next to it
    lists = F.filter(F.transform(address["extension"], lambda ext: ext["extension"]), lambda part: part.isNotNull())
    inner = F.flatten(lists)

    def values(url: str) -> Column:
        return F.filter(inner, lambda item: item["url"] == url)

    return F.flatten(
        F.transform(
            values("latitude"),
            lambda lat: F.transform(
                values("longitude"),
                lambda lon: F.struct(lat["valueDecimal"].alias("latitude"), lon["valueDecimal"].alias("longitude")),
            ),
        )
    )
