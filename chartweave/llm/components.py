"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _apart(links: DataFrame) -> DataFrame:
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable over ``links`` (a, b), for every node that has a link.

    Each round every node points to its smallest neighbour or itself, pointers are followed to their ends, and
    links are drawn between the ends; links within one component vanish, so each round works on what is left.
    Rounds are written tables; only whether anything is left reaches the driver.
    """
    edges, labels = saved(_apart(links)), None
    while True:
        ways = edges.union(edges.select("b", "a"))
        ends = saved(ways.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("comp")))
        while True:
            further = ends.join(ends.toDF("comp", "up"), "comp")
            ends = saved(further.select("node", F.col("up").alias("comp"), (F.col("up") != F.col("comp")).alias("moved")))
            moved = ends.where("moved").limit(1).count()
            ends = ends.drop("moved")
            if not moved:
                break
        if labels is None:
            labels = ends
        else:
            labels = saved(
                labels.join(ends.toDF("comp", "to"), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
            )
        edges = saved(
            _apart(edges.join(ends.toDF("a", "x"), "a").join(ends.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b")))
        )
        if not edges.limit(1).count():
            return labels
