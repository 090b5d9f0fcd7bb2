"""Deduplication and keyed last-write-wins merging.

These are aggregates with map-side combine, so a key that holds a large share of all rows is reduced before the
shuffle and never gathered in one task. The exception are callers that say a key has few rows (``unique``): their
rows are shuffled and sorted once as they are, which is cheaper, but puts all rows of a key into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, *names: str) -> DataFrame:
    return (df.select(*names) if names else df).distinct()


def dedupe_full_row(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def _counted(df: DataFrame) -> DataFrame:
    """Distinct rows with their number as ``_n``: a hash aggregate that shrinks repeats on the map side.

    A plain ``distinct`` below ``min`` or ``max`` is taken out by the optimizer as redundant, and then all
    input rows are sorted by key. Callers keep ``_n`` in use, so the cheap reduction stays in the plan.
    """
    return df.groupBy(*df.columns).agg(F.count("*").alias("_n"))


def one_per_key(df: DataFrame, *keys: str, repeats: bool = True) -> DataFrame:
    """One row per key: the one with the smallest remaining columns, so reruns agree.

    ``repeats=False`` says that rows are nearly unique: they are not counted together first.
    """
    rest = [c for c in df.columns if c not in keys]
    if repeats:
        grouped = _counted(df).groupBy(*keys)
        smallest = grouped.agg(F.min(F.struct(*rest)).alias("_row"), F.sum("_n").alias("_n")).where(F.col("_n") > 0)
    else:
        smallest = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return smallest.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def latest_per_key(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    keep_first: tuple[str, ...] = (),
    repeats: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Last row per key by ``order`` (ties: largest remaining columns). NULLs overwrite like values.

    Columns in ``keep_first`` take the value of the first row instead. ``order`` columns are not returned.
    ``repeats`` says that most rows are copies of others (code tables), so they are counted together first.
    ``unique`` says that a key has few rows (facts): they are shuffled and sorted once, without reducing them
    on the map side first, where nothing would be reduced.
    Rows without a key have no place in a keyed table; see :func:`rows_without_key`.
    """
    payload = [c for c in df.columns if c not in (*keys, *order)]
    rows = df.dropna(subset=list(keys))
    row = F.struct(*order, *payload)
    aggregates = [F.max(row).alias("_last")]
    if keep_first:
        aggregates.append(F.min(row).alias("_first"))
    if repeats:
        merged = _counted(rows).groupBy(*keys).agg(*aggregates, F.sum("_n").alias("_n")).where(F.col("_n") > 0)
    else:
        merged = (rows.repartition(*keys) if unique else rows).groupBy(*keys).agg(*aggregates)

    def pick(name: str):
        if name in keys:
            return F.col(name)
        return F.col("_first" if name in keep_first else "_last")[name].alias(name)

    return merged.select(*[pick(c) for c in df.columns if c not in order])


def key_states(
    df: DataFrame, keys: list[str], order: list[str], keep_first: bool = False, repeats: bool = False
) -> DataFrame:
    """``(keys, last[, first])``: per key its last row by ``order`` (ties: largest remaining columns), and its first.

    States can be merged in any order (:func:`union_states`): the result is that of all their rows at once.
    """
    payload = [c for c in df.columns if c not in (*keys, *order)]
    rows = df.dropna(subset=list(keys))
    row = F.struct(*order, *payload)
    aggregates = [F.max(row).alias("last"), *([F.min(row).alias("first")] if keep_first else [])]
    if not repeats:
        return rows.groupBy(*keys).agg(*aggregates)
    return _counted(rows).groupBy(*keys).agg(*aggregates, F.sum("_n").alias("_n")).where(F.col("_n") > 0).drop("_n")


def union_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """One state per key."""
    first = [F.min("first").alias("first")] if "first" in states.columns else []
    return states.groupBy(*keys).agg(F.max("last").alias("last"), *first)


def with_newer_states(states: DataFrame, newer: DataFrame, keys: list[str]) -> DataFrame:
    """All states after newer ones, each side with one state per key.

    Joins rather than an aggregate over both: few newer states are broadcast, and the others are not shuffled.
    """
    renamed = newer.withColumnsRenamed({c: f"_{c}" for c in newer.columns if c not in keys})
    picked = {"last": F.greatest, "first": F.least}
    columns = [
        picked[c](F.col(c), F.col(f"_{c}")).alias(c) if c in picked else F.col(c) for c in states.columns
    ]
    changed = states.join(renamed, keys, "left").select(*columns)
    return changed.unionByName(newer.join(states.select(*keys), keys, "left_anti"))


def state_rows(states: DataFrame, keys: list[str], columns: list[str], keep_first: tuple[str, ...] = ()) -> DataFrame:
    """The rows that states stand for; columns in ``keep_first`` have their first value."""
    return states.select(
        *[F.col(c) if c in keys else F.col("first" if c in keep_first else "last")[c].alias(c) for c in columns]
    )


def upsert_merge(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    order: list[str],
    update_cols: list[str] | None = None,
    repeats: bool = False,
) -> DataFrame:
    """The target after all updates: matched keys take the last update, new keys are added.

    ``order`` names columns of ``updates`` that give their sequence; target rows are older than all of
    them. Columns outside ``update_cols`` keep the value the key came in with. Both sides are shuffled and sorted
    once; ``repeats`` says that some keys have very many updates, so they are reduced before the shuffle.
    """
    columns = target.columns
    values = [c for c in columns if c not in keys]
    kept = tuple(c for c in values if update_cols is not None and c not in update_cols)
    old = target.select(F.lit(0).alias("_new"), *columns)
    new = updates.select(F.lit(1).alias("_new"), *order, *columns)
    both = new.unionByName(old, allowMissingColumns=True)
    return latest_per_key(both, keys, ["_new", *order], kept, unique=not repeats).select(*columns)


def rows_without_key(df: DataFrame, *keys: str) -> DataFrame:
    """Rows a keyed table refuses because a key column is NULL."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return df.where(missing)
