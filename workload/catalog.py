"""All registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chartweave.plans.details import DETAILS, build
from chartweave.plans.star import STAR, star_table

from .oracle_details import DETAIL_SQL
from .oracle_star import STAR_SQL
from . import join_queries, profile_queries, scalar_queries, scan_queries, shape_queries  # noqa: F401
from .records import RECORDS, Tables
from .register import QUERIES

Query = Callable[[SparkSession, str], DataFrame]


def detail_query(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(name, RECORDS[DETAILS[name].resource](Tables(spark, folder)))

    return run


def star_query(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return star_table(detail_query(STAR[name].source)(spark, folder), STAR[name])

    return run


def all_queries() -> dict[str, Query]:
    return {
        **{name: query for name, (query, _) in QUERIES.items()},
        **{name: detail_query(name) for name in DETAILS},
        **{name: star_query(name) for name in STAR},
    }


def all_sql() -> dict[str, str]:
    return {**{name: sql for name, (_, sql) in QUERIES.items() if sql}, **DETAIL_SQL, **STAR_SQL}
