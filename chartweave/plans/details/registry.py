"""Detail tables as independent plans over bronze rows.

Each table is one function from the rows of its resource type to flat columns. Nothing is cached or
regrouped in between: a table's plan reads only its own ``resource_type`` partition and only the nested
fields it selects.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH = "batch_id"


@dataclass(frozen=True)
class Detail:
    name: str
    resource: str
    plan: Callable[[DataFrame], DataFrame]


DETAILS: dict[str, Detail] = {}


def detail(resource: str):
    """Register a function as the plan of the detail table that carries its name."""

    def register(plan: Callable[[DataFrame], DataFrame]):
        DETAILS[plan.__name__] = Detail(plan.__name__, resource, plan)
        return plan

    return register


def shape(rows: DataFrame, **columns: Column | str) -> DataFrame:
    """Batch id plus the named columns; text stands for the column of that (dotted) name."""
    picked = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    return rows.select(BATCH, *picked)


def per_element(rows: DataFrame, name: str, array: Column | str, **carry: Column | str) -> DataFrame:
    """One row per array element, with only the carried columns beside it."""
    generator = F.explode(F.col(array) if isinstance(array, str) else array).alias(name)
    kept = [(F.col(c) if isinstance(c, str) else c).alias(alias) for alias, c in carry.items()]
    return rows.select(BATCH, *kept, generator)


def resource_types() -> list[str]:
    return sorted({d.resource for d in DETAILS.values()})


def tables_of(resource: str) -> list[str]:
    return [d.name for d in DETAILS.values() if d.resource == resource]


def resource_rows(bronze: DataFrame, resource: str) -> DataFrame:
    """Rows of one type; a partition filter when bronze is read from its folder."""
    return bronze.where(F.col("resource_type") == resource).select(BATCH, "data")


def build(name: str, bronze: DataFrame) -> DataFrame:
    table = DETAILS[name]
    return table.plan(resource_rows(bronze, table.resource))


def detail_tables(bronze: DataFrame) -> dict[str, DataFrame]:
    """All thirty lazy plans by name."""
    return {name: build(name, bronze) for name in DETAILS}
