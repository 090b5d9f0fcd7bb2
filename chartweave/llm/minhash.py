"""MinHash near-duplicates by an inverted join on signature coordinates."""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, id_type, map_texts, saved, slices
from .components import components
from .decontaminate import word_chunks

COORDS = 64
RISK = 1e-5
GROUP = 4096
PART = 2048
SMALL = 64
# A-Z become a-z and the five control characters that part words become blanks.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def match_threshold(coords: int, similarity: float, risk: float = RISK) -> int:
    """The most matches that two sets of that similarity miss with a chance below ``risk``."""
    tail = 0.0
    for n in range(coords + 1):
        tail += comb(coords, n) * similarity**n * (1 - similarity) ** (coords - n)
        if tail >= risk:
            return max(1, n)
    return coords


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, size: int, hashes: _Hashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; of the whole text if it has fewer words."""
    parts = [
        np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        for words in word_chunks((text or "").encode().translate(_FOLD))
    ]
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if not len(words):
        return words
    span = min(size, len(words))
    out = np.full(len(words) - span + 1, span, np.uint64)
    for k in range(span):
        out = (out ^ words[k : k + len(out)]) * _PRIME
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _family(coords: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_229)
    return rng.integers(1, 2**63, coords, np.uint64) | np.uint64(1), rng.integers(0, 2**63, coords, np.uint64)


def signature(shingles: np.ndarray, family) -> np.ndarray:
    times, plus = family
    least = np.full(len(times), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), 2048):
        values = (shingles[None, at : at + 2048] * times[:, None] + plus[:, None]) >> np.uint64(32)
        least = np.minimum(least, values.min(axis=1).astype(np.uint32))
    return least.view(np.int32)


def _sign(size: int, coords: int):
    def work(batch: pa.RecordBatch) -> dict:
        hashes, family = _Hashes(), _family(coords)
        counts, keys, signs = [], [], []
        for text in batch.column("text").to_pylist():
            shingles = shingle_set(text, size, hashes)
            counts.append(len(shingles))
            keys.append(xxhash.xxh3_128_digest(shingles.tobytes()))
            signs.append(signature(shingles, family))
        flat = pa.array(np.concatenate(signs) if signs else np.zeros(0, np.int32))
        ends = pa.array(np.arange(0, coords * len(signs) + 1, coords, dtype=np.int32))
        return {
            "id": batch.column("id"),
            "n": pa.array(counts, pa.int64()),
            "skey": pa.array(keys, pa.binary()),
            "sig": pa.ListArray.from_arrays(ends, flat),
        }

    return work


class _Labels:
    """Components of numbered nodes, merged by arrays of links."""

    def __init__(self, count: int):
        self.of = np.arange(count)

    def merge(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.of[i], self.of[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            to = np.arange(len(self.of))
            np.minimum.at(to, np.maximum(a, b), np.minimum(a, b))
            while (to[to] != to).any():
                to = to[to]
            self.of = to[self.of]

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        """Every node that isn't the first of its component, and that first one."""
        rest = np.flatnonzero(self.of != np.arange(len(self.of)))
        return rest, self.of[rest]


def _collisions(needed: int):
    """Links between the classes of a coordinate value whose signatures match often enough.

    Pairs that are connected already are skipped. Only one link per class and task comes out: to the first
    class of the component it fell into. Rows come sorted by value.
    """

    def run(batches):
        for table in _whole_groups(batches, ["key"]):
            key = table.column("key").to_numpy()
            ids = table.column("rep").combine_chunks()
            # numbered by id, so that the tasks of a group mostly name the same first class
            _, first, nodes = np.unique(ids.to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
            sig = table.column("sig").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
            labels = _Labels(len(first))

            def judge(i, j):
                for at in range(0, len(i), 1 << 16):
                    a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                    apart = labels.of[nodes[a]] != labels.of[nodes[b]]
                    a, b = a[apart], b[apart]
                    near = (sig[a] == sig[b]).sum(axis=1) >= needed
                    labels.merge(nodes[a[near]], nodes[b[near]])

            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            for size in np.unique(sizes[(sizes > 1) & (sizes <= SMALL)]):
                i, j = np.triu_indices(size, 1)
                at = starts[sizes == size]
                step = max(1, (1 << 18) // len(i))
                for k in range(0, len(at), step):
                    base = at[k : k + step, None]
                    judge((base + i).ravel(), (base + j).ravel())
            for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
                for row in range(start, start + size - 1):
                    judge(np.full(start + size - row - 1, row), np.arange(row + 1, start + size))
            rest, root = labels.stars()
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(first[rest])), ids.take(pa.array(first[root]))], names=["a", "b"])

    return run


def _whole_groups(batches, names: list[str], size: int = 20_000):
    """Tables of about ``size`` rows or more that end between groups of equal values in ``names``."""
    held, count = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < size:
            continue
        table = pa.Table.from_batches(held)
        other = np.zeros(table.num_rows, bool)
        for name in names:
            values = table.column(name).combine_chunks().dictionary_encode().indices.to_numpy()
            other |= values != values[-1]
        last = np.flatnonzero(other)
        end = last[-1] + 1 if len(last) else 0
        if end:
            yield table.slice(0, end)
        held = table.slice(end).to_batches()
        count = table.num_rows - end
    if held:
        yield pa.Table.from_batches(held)


def _confirm(shingle: int, num: int, den: int):
    """Links confirmed on full sets within a part of a cluster, one per document: to the first it is linked with.

    A document is held against the first of each component, and only where that is no link against all others.
    Guests are held against the part's own documents only; documents known to be connected (``comp``) are not
    held against each other.
    """

    def linked(row: int, others: np.ndarray, flat, starts, sizes, mark) -> np.ndarray:
        low, high = np.minimum(sizes[others], sizes[row]), np.maximum(sizes[others], sizes[row])
        others = others[den * low >= num * high]
        if not len(others):
            return others
        mark[flat[starts[row] : starts[row + 1]]] = True
        places = np.concatenate([flat[starts[x] : starts[x + 1]] for x in others])
        ends = np.cumsum(sizes[others])
        both = np.add.reduceat(mark[places].astype(np.int64), np.r_[0, ends[:-1]])
        mark[flat[starts[row] : starts[row + 1]]] = False
        return others[den * both >= num * (sizes[others] + sizes[row] - both)]

    def run(batches):
        hashes = _Hashes()
        small = (part for batch in batches for part in slices([batch], "text"))
        for table in _whole_groups(small, ["cluster", "part"], 2_000):
            cluster = table.column("cluster").combine_chunks().dictionary_encode().indices.to_numpy()
            part = table.column("part").to_numpy()
            starts_at = np.flatnonzero(np.r_[True, (cluster[1:] != cluster[:-1]) | (part[1:] != part[:-1])])
            ids = table.column("id").combine_chunks()
            left, right = [], []
            for a, b in zip(starts_at, np.r_[starts_at[1:], len(part)]):
                rows = table.slice(a, b - a)
                sets = [shingle_set(t, shingle, hashes) for t in rows.column("text").to_pylist()]
                sizes = np.array([len(x) for x in sets])
                universe, flat = np.unique(np.concatenate(sets), return_inverse=True)
                starts, mark = np.r_[0, np.cumsum(sizes)], np.zeros(len(universe), bool)
                guest = rows.column("guest").to_numpy()
                comp = rows.column("comp").combine_chunks().dictionary_encode().indices.to_numpy()
                labels = _Labels(len(sets))
                order = np.argsort(comp, kind="stable")
                same = comp[order[1:]] == comp[order[:-1]]
                labels.merge(order[1:][same], order[:-1][same])
                for row in np.flatnonzero(guest) if guest.any() else range(1, len(sets)):  # own ones were held before
                    for heads_only in (True, False):
                        others = np.arange(row)
                        if heads_only:
                            others = np.unique(labels.of[:row])
                            others = others[others < row]
                        others = others[labels.of[others] != labels.of[row]]
                        others = others[~(guest[others] & guest[row])]
                        while len(others):
                            now, others = others[:256], others[256:]
                            found = linked(row, now, flat, starts, sizes, mark)
                            if len(found):
                                left += [a + row] * len(found)
                                right += (a + found).tolist()
                                labels.merge(np.full(len(found), row), found)
                                others = others[labels.of[others] != labels.of[row]]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(left, pa.int64())), ids.take(pa.array(right, pa.int64()))], names=["a", "b"])

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    similarity: tuple[int, int] = (80, 100),
    coords: int = COORDS,
) -> DataFrame:
    """One row per input row: the id, ``n_shingles``, ``component_id`` and ``kept``.

    Words are parted by blanks and control characters 9 to 13, A-Z lower-cased; a text of fewer words than a
    shingle is one shingle. Documents are linked if the Jaccard similarity of their shingle sets is at least
    ``similarity`` (as a fraction); ``component_id`` is the smallest id reachable over links, ``kept`` tells
    whether it is the row's own. Texts without words are linked with nothing. A row with a null id is linked
    with nothing, has a null component and is kept. Repeated rows get a row each; rows that share an id but
    differ in text count as two texts of that id. An empty table gives an empty result; no other column is read.

    1. Equal sets become one class, so copies cost one row each.
    2. Every class is posted under its (coordinate, value) pairs. Values are ordered by how many classes hold
       them; two classes that match in enough coordinates share one among the rarest of each (the prefix), so
       only prefixes are joined, and values of a common passage stay out. A class that shares too few values
       with anyone is out at once.
    3. Within a value, matches are counted on whole signatures, skipping pairs that are connected already. Pairs
       above the match threshold make clusters; a value of more than ``GROUP`` classes makes one without counting.
    4. Clusters are confirmed on full sets: each document travels once, and only one link per document comes out,
       so the pairs of a large group of near copies are never listed. A cluster of more than ``PART`` documents
       is dealt to parts; then the documents outside its largest component visit all other parts, so every pair
       that is not connected by then is held against each other.

    The number of matches asked for misses a link with a chance below one in 100,000.
    """
    kind = id_type(docs, id_col)
    num, den = similarity
    needed = match_threshold(coords, num / den)
    texts = id_and_text(docs, id_col, text_col)
    signed = saved(map_texts(texts, "text", _sign(shingle, coords), f"id {kind}, n long, skey binary, sig array<int>"))
    reps = saved(
        signed.where("n > 0 AND id IS NOT NULL").groupBy("skey").agg(F.min("id").alias("rep"), F.first("sig").alias("sig"))
    )

    posted = reps.select("skey", F.posexplode("sig").alias("coord", "value")).select(
        "skey",
        (F.shiftleft(F.col("coord").cast("long"), 32) + F.col("value").cast("long").bitwiseAND(0xFFFFFFFF)).alias("key"),
    )
    shared = posted.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    prefixes = (
        posted.join(shared, "key")
        .groupBy("skey")
        .agg(F.sort_array(F.collect_list(F.struct("held", "key"))).alias("keys"))
        .where(F.size("keys") >= needed)
        .select("skey", F.slice("keys.key", 1, F.size("keys") - needed + 1).alias("keys"))
    )
    able = saved(reps.join(prefixes, "skey"))
    posts = able.select("skey", "rep", F.explode("keys").alias("key"))
    groups = posts.groupBy("key").agg(F.count(F.lit(1)).alias("held"), F.min("rep").alias("first")).where("held > 1")
    posts = saved(posts.join(groups, "key"))
    counted = (
        posts.where(F.col("held") <= GROUP)
        .select("key", "skey")
        .join(able.select("skey", "rep", "sig"), "skey")
        .select("key", "rep", "sig")
        .repartition("key")
        .sortWithinPartitions("key", "rep")
        .mapInArrow(_collisions(needed), f"a {kind}, b {kind}")
    )
    hot = posts.where(F.col("held") > GROUP).select(F.col("rep").alias("a"), F.col("first").alias("b"))
    clusters = components(counted.union(hot).distinct())
    sizes = clusters.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    clusters = saved(clusters.toDF("id", "cluster").join(sizes.toDF("cluster", "parts"), "cluster"))

    members = saved(
        texts.join(clusters, "id").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    )

    def confirmed(rows: DataFrame) -> DataFrame:
        rows = rows.select("cluster", "part", "guest", "comp", "id", "text").where("text IS NOT NULL")
        dealt = rows.repartition("cluster", "part").sortWithinPartitions("cluster", "part", "guest", "id")
        return dealt.mapInArrow(_confirm(shingle, num, den), f"a {kind}, b {kind}")

    links = saved(confirmed(members.withColumn("guest", F.lit(False)).withColumn("comp", F.col("id"))))
    split = members.where("parts > 1")
    if split.limit(1).count():
        labels = components(links).toDF("id", "label")
        split = split.join(labels, "id", "left").withColumn("comp", F.coalesce("label", "id")).drop("label")
        held = split.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("held"))
        most = held.groupBy("cluster").agg(F.max_by("comp", "held").alias("most"))
        split = split.join(most, "cluster").withColumn("home", F.col("part"))
        everywhere = F.sequence(F.lit(0), F.col("parts") - 1)
        visits = F.when(F.col("comp") != F.col("most"), everywhere).otherwise(F.array("home"))
        guests = split.withColumn("part", F.explode(visits)).withColumn("guest", F.col("part") != F.col("home"))
        links = saved(links.union(confirmed(guests)))
    comps = components(links).toDF("rep", "comp")
    classes = reps.select("skey", "rep").join(comps, "rep", "left")
    classes = classes.select("skey", F.coalesce("comp", "rep").alias("comp"))
    linked = signed.select("id", "n", "skey").where("n > 0 AND id IS NOT NULL").join(classes, "skey").drop("skey")
    alone = signed.where("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("comp"))
    return linked.select("id", "n", "comp").union(alone).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("comp").alias("component_id"),
        F.coalesce(F.col("id") == F.col("comp"), F.lit(True)).alias("kept"),
    )
