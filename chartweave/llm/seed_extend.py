"""Substring dedup by seeds and extension: repeated runs of words, wherever they stand."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_type
from .repeats import Rule, blocks_of, cut, packed, repeated, unpacked
from .winnow import RangeHash

WINDOW = 35
SEED = 16


def _extended(size: int):
    """Every window of the asked fragments: the seed, extended to each split of what is missing left and right."""

    def rows(block, first, count, turn, anchor, rank, hot, buckets: int):
        ends = np.cumsum(count)
        start = np.repeat(first, count) + np.arange(ends[-1]) - np.repeat(ends - count, count)
        seed, alone = np.repeat(anchor, count), np.repeat(rank == 0, count)
        hashes = RangeHash(block.symbols)(start, start + size).view(np.int64)
        lot = np.where(np.repeat(hot, count), hashes, seed) % buckets
        order = np.argsort(lot, kind="stable")
        bounds = np.flatnonzero(np.r_[True, np.diff(lot[order]) != 0, True])
        for a, b in zip(bounds[:-1], bounds[1:]):
            take = order[a:b]
            yield int(lot[take[0]]), packed(seed[take] // buckets, hashes[take], start[take], alone[take].astype(np.int64))

    return rows


def _repeats(key, table):
    """Windows whose seed and extension stand at least twice."""
    names = table.column("block").to_pylist()
    parts = [(*unpacked(d, 4), n) for n, d in enumerate(table.column("data").to_pylist())]
    seed, hashes, start, alone = (np.concatenate([p[k] for p in parts]) for k in range(4))
    block = np.concatenate([np.full(len(p[0]), p[4]) for p in parts])
    order = np.lexsort((hashes, seed))
    seed, hashes, start, alone, block = (c[order] for c in (seed, hashes, start, alone, block))
    group = np.cumsum(np.r_[True, (seed[1:] != seed[:-1]) | (hashes[1:] != hashes[:-1])]) - 1
    twice = np.bincount(group)[group] > 1
    out = []
    for number in np.unique(block[twice]):
        mine = start[twice & (block == number)]
        out.append((names[number], packed(mine, np.ones(len(mine), np.int64))))
    return pa.table([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], names=["block", "data"])


def _kept(block, covered: np.ndarray):
    counts = block.ends - block.starts
    removed = np.diff(np.r_[0, np.cumsum(covered)][np.r_[0, block.ends]]) if len(block.ends) else np.zeros(0, np.int64)
    texts = []
    for words, start, gone in zip(block.words, block.starts, removed):
        if gone:
            words = [w for w, c in zip(words, covered[start : start + len(words)].tolist()) if not c]
        texts.append(b" ".join(words).decode())
    return [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())]


def cut_repeated_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED
) -> DataFrame:
    """One row per input row: the id, ``n_words``, ``n_removed`` and ``kept``, the words left, joined by one blank.

    Words are parted by blanks and control characters 9 to 13. A word goes if a window of ``window`` words that
    covers it also starts anywhere else, in the same document or another, so a maximal repeat of at least
    ``window`` words goes wherever it stands. Windows are judged on the input. Null and empty texts have no
    words; repeated rows are copies of each other; a null id is a document like any other; an empty table gives
    an empty result; no other column is read.

    Seeds are winnowed runs of ``seed`` words. Documents meet on equal seeds: first each seed is extended as far
    as its fragment reaches and compared by one hash, which settles long repeats; for seeds in several contexts
    it is extended to every window and windows are compared. Groups are counted, never listed in pairs, and
    equal fragments of a block travel once.
    """
    rule = Rule(words=True, size=window, span=seed, earlier=False)
    blocks = blocks_of(docs, id_col, text_col)
    gone = repeated(blocks, rule, _extended(window), _repeats)
    return cut(
        blocks, gone, rule, ["id", "n_words", "n_removed", "kept"], _kept,
        f"id {id_type(docs, id_col)}, n_words long, n_removed long, kept string",
    ).withColumnRenamed("id", id_col)
