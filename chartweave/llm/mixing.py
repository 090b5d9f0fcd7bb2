"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

A document can be sampled once at most, so a cell can hold no more than its own tokens. That bound is part of the
fitting: in every step a cell is scaled to its margin's target or up to its bound, whichever is less, and the other
cells of the margin make up for it in the following steps. Targets that the bounds allow are thus met by the final
probabilities; :func:`margins` shows what was reached.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

ROUNDS = 8
MISSING = "?"


def tempered(cells: DataFrame, name: str, power: float) -> DataFrame:
    """Target shares of one dimension: its token masses raised to ``power``; below 1 this lifts the small ones."""
    return cells.groupBy(name).agg(F.pow(F.sum("mass"), F.lit(power)).alias("target"))


def shares_of(cells: DataFrame, name: str, target: DataFrame) -> DataFrame:
    """``(name, share)``: targets of the values that occur, summing to 1; a value without a target gets none."""
    given = target.groupBy(name).agg(F.max(F.col("target").cast("double")).alias("target"))
    there = cells.select(name).distinct().join(given, name, "left").fillna(0.0, ["target"])
    total = there.agg(F.sum("target")).first()[0]
    return there.select(name, F.coalesce(F.try_divide("target", F.lit(total)), F.lit(0.0)).alias("share"))


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, share: float | None = None
) -> DataFrame:
    """Cells with ``raked``: their masses fitted to the target shares of every dimension, summing to 1 if that can be.

    ``cells`` has one row per combination with ``mass``; ``targets`` maps a dimension to a table of its value and
    ``target``. With ``share`` no cell gets more than its mass is of that share of all mass. A dimension's sums are
    grouped and joined back, so no task holds all cells of a value; every round is written, since each step reads the
    cells twice.
    """
    total = cells.agg(F.sum("mass").cast("double")).first()[0]
    fitted = cells.withColumn("raked", F.try_divide(F.col("mass").cast("double"), F.lit(total)))
    if share is not None:
        bound = F.try_divide(F.col("mass").cast("double"), F.lit(None if total is None else share * total))
        fitted = fitted.withColumn("bound", F.coalesce(bound, F.lit(0.0)))
    for name, target in targets.items():
        aims = shares_of(cells, name, target).withColumnRenamed("share", f"to_{name}")
        fitted = fitted.join(aims, name)
    fitted = saved(fitted)
    for _ in range(rounds):
        for name in targets:
            held = fitted.groupBy(name).agg(F.sum("raked").alias("held"))
            scaled = F.coalesce(F.col("raked") * F.col(f"to_{name}") / F.nullif("held", F.lit(0.0)), F.lit(0.0))
            scaled = scaled if share is None else F.least("bound", scaled)
            fitted = fitted.join(held, name).withColumn("raked", scaled).drop("held")
        fitted = saved(fitted)
    return fitted.drop("bound", *(f"to_{n}" for n in targets))


def calibrate(fitted: DataFrame, share: float) -> DataFrame:
    """Cells with ``probability``, at most 1: what part of a cell's mass its raked part of ``share`` of all mass is."""
    total = fitted.agg(F.sum("mass").cast("double")).first()[0]
    part = F.col("raked") * F.lit(share) * F.lit(total) / F.nullif(F.col("mass").cast("double"), F.lit(0.0))
    return fitted.withColumn("probability", F.least(F.lit(1.0), F.coalesce(part, F.lit(0.0))))


def margins(fitted: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """``(dimension, value, target, reached)`` of cells with a probability: the shares of the expected sample."""
    taken = F.col("mass") * F.col("probability")
    total = fitted.agg(F.sum(taken)).first()[0]
    return reduce(
        DataFrame.unionByName,
        [
            fitted.groupBy(name)
            .agg(F.try_divide(F.sum(taken), F.lit(total)).alias("reached"))
            .join(shares_of(fitted, name, target), name)
            .select(F.lit(name).alias("dimension"), F.col(name).alias("value"), F.col("share").alias("target"), "reached")
            for name, target in targets.items()
        ],
    )


def uniform(id_col: str, seed: str) -> Column:
    """A number in [0, 1) from the id alone, so a lost task draws the same again."""
    text = F.concat(F.lit(seed), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def fit(
    rows: DataFrame,
    names: list[str],
    powers: dict[str, float] | None = None,
    targets: dict[str, DataFrame] | None = None,
    share: float = 0.5,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The cells of rows with ``n_tokens`` and their ``probability``, and the targets they were fitted to."""
    cells = saved(rows.groupBy(*names).agg(F.sum("n_tokens").alias("mass")))
    aims = {n: (targets or {}).get(n) for n in names}
    aims = {n: tempered(cells, n, (powers or {}).get(n, 1.0)) if aim is None else aim for n, aim in aims.items()}
    return calibrate(rake(cells, aims, rounds, share), share), aims


def mix(
    docs: DataFrame,
    dimensions: dict[str, Column],
    tokens: Column,
    powers: dict[str, float] | None = None,
    targets: dict[str, DataFrame] | None = None,
    share: float = 0.5,
    seed: str = "mix-",
    id_col: str = "doc_id",
    carry: bool = False,
) -> DataFrame:
    """One row per input row: the id, the dimensions, ``n_tokens``, ``probability`` and ``sampled``; with ``carry``
    also ``row``, the whole input row as a struct.

    ``dimensions`` names the margins and gives their value per document, null counting as a value of its own;
    ``tokens`` is a document's weight, of at least 1. A dimension's target shares come from ``targets`` (value,
    ``target``) or from its own masses raised to ``powers[name]``. The cells of all dimensions are raked to the
    targets of a sample of ``share`` of all tokens, none above its own tokens; where the targets ask for more than
    there is, the sample is smaller. Every document of a cell has the cell's probability, and is sampled if a number
    drawn from its id lies below it. Repeated rows share one draw, null ids draw as the empty text, an empty table
    gives an empty result, no other column is read.

    Only cell sums are shuffled: the partial sums of a hot source meet as one row per task. The cells, one row
    per combination, join back below Spark's broadcast threshold or else by key with AQE's skew split.
    """
    names = list(dimensions)
    rows = weighted(docs, dimensions, tokens, id_col, carry)
    fitted, _ = fit(rows, names, powers, targets, share)
    fitted = saved(fitted.select(*names, "probability"))
    return (
        rows.join(fitted, names)
        .withColumn("sampled", uniform("id", seed) < F.col("probability"))
        .select(F.col("id").alias(id_col), *names, "n_tokens", "probability", "sampled", *(["row"] if carry else []))
    )


def weighted(
    docs: DataFrame, dimensions: dict[str, Column], tokens: Column, id_col: str = "doc_id", carry: bool = False
) -> DataFrame:
    """Documents as ``id``, their dimensions and ``n_tokens``."""
    return docs.select(
        F.col(f"`{id_col}`").alias("id"),
        *(F.coalesce(value.cast("string"), F.lit(MISSING)).alias(name) for name, value in dimensions.items()),
        F.greatest(F.coalesce(tokens.cast("long"), F.lit(1)), F.lit(1)).alias("n_tokens"),
        *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []),
    )
