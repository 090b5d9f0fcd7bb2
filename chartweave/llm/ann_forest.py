"""Approximate nearest neighbours by a forest of sorted hash strings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_type, saved

TREES = 12
BITS = 60
SHARD_ROWS = 8192
LEAF = 32
RECALL = 0.95
QUERY_ROWS = 4096
#: shards up to which their table, of five numbers each, is broadcast
FEW_SHARDS = 100_000
SLICE = 2048


def _planes(tree: int, dim: int) -> np.ndarray:
    return np.random.default_rng([7, tree, dim]).standard_normal((dim + 1, BITS))


def hash_strings(vectors: np.ndarray, extra: np.ndarray, tree: int) -> np.ndarray:
    """The sides of ``BITS`` random planes as one number; the first plane is the highest bit.

    ``extra`` is one more component that gives all rows one length, so that the angle to a query orders rows by
    inner product.
    """
    sides = np.column_stack([vectors, extra]) @ _planes(tree, vectors.shape[1]) > 0
    return sides.astype(np.int64) @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _valid(id_arrow):
    """Usable vectors as doubles, with their length and dimension."""

    def run(batches):
        for batch in batches:
            column = batch.column("vec").cast(pa.list_(pa.float64()))
            rows, kept, norms = [], [], []
            for at in range(batch.num_rows):
                if not column[at].is_valid or not batch.column("id")[at].is_valid:
                    continue
                values = column[at].values
                if values.null_count or not len(values):
                    continue
                vector = values.to_numpy()
                norm = float(np.sqrt((vector * vector).sum()))
                if np.isfinite(vector).all() and vector.any() and np.isfinite(norm):
                    rows.append(vector)
                    kept.append(at)
                    norms.append(norm)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(kept, pa.int32())),
                    pa.array([len(r) for r in rows], pa.int32()),
                    pa.array(norms, pa.float64()),
                    pa.array(rows, pa.list_(pa.float64())),
                ],
                names=["id", "dim", "norm", "vec"],
            )

    return run


def _strings(longest: dict[int, float], query: bool):
    """A row per tree, with its string and those of all trees. Rows get a component that makes them all as long as the longest; queries get none."""

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                dims = batch.column("dim").to_numpy()
                for dim in np.unique(dims):
                    part = batch.filter(pa.array(dims == dim))
                    vectors = part.column("vec").flatten().to_numpy().reshape(part.num_rows, dim)
                    norms = part.column("norm").to_numpy()
                    extra = np.zeros(len(norms)) if query else np.sqrt(np.maximum(longest[int(dim)] ** 2 - norms**2, 0))
                    strings = [hash_strings(vectors, extra, tree) for tree in range(TREES)]
                    offsets = pa.array(np.arange(0, TREES * len(norms) + 1, TREES, dtype=np.int32))
                    codes = pa.ListArray.from_arrays(offsets, pa.array(np.column_stack(strings).ravel()))
                    for tree in range(TREES):
                        yield pa.RecordBatch.from_arrays(
                            [
                                *(part.column(n) for n in part.schema.names),
                                pa.repeat(pa.scalar(tree, pa.int32()), len(norms)),
                                pa.array(strings[tree]),
                                codes,
                            ],
                            names=[*part.schema.names, "tree", "code", "codes"],
                        )

    return run


def _search(k: int, id_arrow):
    """The ``k`` best rows of a shard for each query that visits it.

    Rows are sorted by hash string. A query without a level descends to its longest prefix that at least
    ``LEAF`` rows share, and takes at most ``LEAF`` of them on either side of its own string; one with a level takes the rows that share a prefix of that length here and in no tree
    before this one, so that one tree alone scores a row. ``scored`` counts them, on one of a query's rows.
    """
    names = ["query_id", "norm", "dim", "id", "score", "scored"]

    def run(key, rows: pa.Table, queries: pa.Table) -> pa.Table:
        bits, tree = key[4].as_py(), key[1].as_py()
        out = {n: [] for n in names}
        if rows.num_rows and queries.num_rows:
            order = np.argsort(rows.column("code").to_numpy(), kind="stable")
            codes = rows.column("code").to_numpy()[order]
            dim = key[0].as_py()
            vectors = rows.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dim)[order]
            ids = rows.column("id").combine_chunks().take(pa.array(order))
            asked = queries.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dim)
            strings, levels = queries.column("code").to_numpy(), queries.column("level").to_numpy()
            before = rows.column("codes").combine_chunks().flatten().to_numpy().reshape(-1, TREES)[order, :tree]
            asked_before = queries.column("codes").combine_chunks().flatten().to_numpy().reshape(-1, TREES)[:, :tree]
            own, asked_ids = ids.to_pylist(), queries.column("query_id").to_pylist()
            low, high = np.zeros(len(strings), np.int64), np.full(len(strings), len(codes), np.int64)
            known = (levels >= 0) & (levels <= bits)
            for length in range(BITS, bits, -1):
                shift = np.int64(BITS - length)
                first = (strings >> shift) << shift
                a = np.searchsorted(codes, first)
                b = np.searchsorted(codes, first + (np.int64(1) << shift))
                take = ~known & np.where(levels < 0, b - a >= LEAF, levels == length)
                low[take], high[take] = a[take], b[take]
                known |= take
            at = np.searchsorted(codes, strings)
            low = np.where(levels < 0, np.maximum(low, at - LEAF), low)
            high = np.where(levels < 0, np.minimum(high, at + LEAF), high)
            norms = queries.column("norm").to_pylist()
            for q, vector in enumerate(asked):
                part, places = vectors[low[q] : high[q]], np.arange(low[q], high[q])
                if levels[q] >= 0 and tree and len(places):
                    differ = before[low[q] : high[q]] ^ asked_before[q]
                    fresh = np.flatnonzero(((differ >> np.int64(BITS - levels[q])) != 0).all(axis=1))
                    part, places = part[fresh], places[fresh]
                scores = part @ vector
                if len(scores) > k + 1:
                    edge = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                    near = np.flatnonzero(scores >= edge - 1e-9 * max(1.0, abs(edge)))
                else:
                    near = np.arange(len(scores))
                exact = (part[near] * vector).sum(axis=1)  # the same for equal rows, unlike the product above
                named = [own[i] for i in places[near].tolist()]
                best = sorted((-s, row) for s, row in zip(exact.tolist(), named) if row != asked_ids[q])[:k]
                for place, (score, row) in enumerate(best):
                    out["scored"].append(0 if place else len(scores))
                    out["query_id"].append(asked_ids[q])
                    out["norm"].append(norms[q])
                    out["id"].append(row)
                    out["score"].append(-score)
            out["dim"] = [dim] * len(out["id"])
        kinds = [id_arrow, pa.float64(), pa.int32(), id_arrow, pa.float64(), pa.int64()]
        return pa.Table.from_arrays([pa.array(out[n], t) for n, t in zip(names, kinds)], names=names)

    return run


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """``query_id``, ``rank``, the row's id, ``score``, ``n_scored``: the ``k`` rows found with the largest inner product.

    Queries are the rows of ``vectors`` for which ``is_query`` holds; candidates are all rows but those with the
    query's own id. The nearest come first, ties to the smaller id. Null or zero vectors, vectors with null or
    non-finite components and rows with a null id take no part; vectors of another dimension are no candidates.
    Repeated rows count once. An empty table gives an empty result; no other column is read.

    Every row is entered in ``TREES`` sorted arrays by a string of ``BITS`` plane sides. Arrays are cut into
    shards by their first bits, about ``SHARD_ROWS`` rows each, and a shard that holds many more (close vectors)
    is dealt to parts that its queries all visit; queries are dealt to blocks of about ``QUERY_ROWS``, so a task
    holds a part and a block, however many rows and queries there are. Queries first descend, in every tree, to
    their longest prefix that ``LEAF`` rows share. From the angles of the ``k`` rows found follows how short a
    prefix all trees must ascend to, together, for neighbours at these angles to be met with the chance
    ``recall`` on average; the second visit takes every row below that prefix, each from the first tree that
    offers it. ``n_scored`` is the number of scores of both visits. Close neighbours are cheap; where there are
    none the search ends near the root, over most rows.
    """
    kind = id_type(vectors, id_col)
    from pyspark.sql.pandas.types import to_arrow_type

    id_arrow = to_arrow_type(vectors.schema[id_col].dataType)
    source = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vec"), is_query.alias("asks"))
    plain = source.select("id", "vec").mapInArrow(_valid(id_arrow), f"id {kind}, dim int, norm double, vec array<double>")
    rows = saved(plain)
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("norm")).collect()
    longest = {r.dim: r.norm for r in sizes}
    count = max((r.n for r in sizes), default=0)
    bits = max(0, int(np.log2(max(1, count) / SHARD_ROWS))) if count > SHARD_ROWS else 0
    asks = source.where("asks AND id IS NOT NULL").select("id").distinct()

    shard = F.shiftright("code", BITS - bits)
    coded = f"id {kind}, dim int, norm double, vec array<double>, tree int, code long, codes array<long>"
    index = rows.mapInArrow(_strings(longest, False), coded).withColumn("shard", shard)
    index = saved(index.drop("norm"))
    parts = (
        index.groupBy("dim", "tree", "shard")
        .agg(F.count(F.lit(1)).alias("held"))
        .select("dim", "tree", "shard", F.ceil(F.col("held") / (4 * SHARD_ROWS)).cast("int").alias("parts"))
    )
    parts = saved(parts)
    place = ["dim", "tree", "shard", "part", "bits", "block"]
    # rows that repeat are small on disk and large in memory, so the side to build from is always named
    small = "broadcast" if parts.count() <= FEW_SHARDS else "shuffle_hash"
    queries = rows.join(asks, "id").dropDuplicates(["id", "vec"]).mapInArrow(_strings(longest, True), coded)
    queries = saved(queries.withColumnRenamed("id", "query_id"))

    def visit(asking: DataFrame) -> DataFrame:
        level = F.when((F.col("level") < 0) | (F.col("level") > bits), F.lit(bits)).otherwise(F.col("level"))
        first = F.shiftleft(F.expr(f"shiftright(code, {BITS} - visit)"), 0)
        steps = F.expr(f"shiftleft(1L, {bits} - visit)")
        asking = asking.withColumn("visit", level.cast("int")).withColumn("first", first * steps)
        asking = asking.withColumn("shard", F.explode(F.sequence("first", F.col("first") + steps - 1)))
        visitors = asking.groupBy("dim", "tree", "shard").agg(
            F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("blocks")
        )
        # a shard's rows meet its queries block by block
        shards = parts.join(visitors, ["dim", "tree", "shard"]).hint(small)
        facing = index.join(shards, ["dim", "tree", "shard"])
        facing = facing.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")
        facing = facing.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        facing = facing.withColumn("bits", F.lit(bits))
        asking = asking.join(shards, ["dim", "tree", "shard"])
        asking = asking.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        asking = asking.withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int"))
        asking = asking.withColumn("bits", F.lit(bits))
        asking = asking.select(*place, "query_id", "norm", "vec", "code", "codes", "level")
        found = (
            facing.groupBy(*place)
            .cogroup(asking.groupBy(*place))
            .applyInArrow(
                _search(k, id_arrow), f"query_id {kind}, norm double, dim int, id {kind}, score double, scored long"
            )
        )
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        found = found.groupBy("query_id", "id").agg(
            F.max("score").alias("score"), F.first("norm").alias("norm"), F.first("dim").alias("dim"),
            F.sum("scored").alias("scored"),
        )
        found = found.withColumn("n_scored", F.sum("scored").over(Window.partitionBy("query_id")))
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    met = visit(queries.withColumn("level", F.lit(-1)))
    scale = F.create_map(*(F.lit(x) for d, n in longest.items() for x in (d, n))) if longest else None
    if scale is None:
        return _answer(met, id_col)
    cosine = F.col("score") / (F.col("norm") * scale[F.col("dim")])
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
    same_side = 1 - angle / np.pi
    # the longest prefix at which the neighbours found so far would be met with the chance wanted, on average
    sides = met.groupBy("query_id").agg(
        F.collect_list(F.least(F.lit(1.0), F.greatest(F.lit(0.0), same_side))).alias("sides"), F.first("n_scored").alias("first")
    )
    chance = f"aggregate(sides, 0D, (sum, s) -> sum + 1 - pow(1 - pow(s, l), {TREES})) >= {recall} * {k}"
    level = F.expr(f"array_max(filter(sequence(0, {BITS}), l -> {chance}))")
    levels = saved(sides.select("query_id", F.coalesce(level, F.lit(0)).cast("int").alias("level"), "first"))
    second = queries.join(levels.drop("first").hint("shuffle_hash"), "query_id", "left").withColumn("level", F.coalesce("level", F.lit(0)))
    both = visit(second).join(levels.drop("level").hint("shuffle_hash"), "query_id", "left")
    return _answer(both.withColumn("n_scored", F.col("n_scored") + F.coalesce("first", F.lit(0))), id_col)


def _answer(found: DataFrame, id_col: str) -> DataFrame:
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score", "n_scored")
