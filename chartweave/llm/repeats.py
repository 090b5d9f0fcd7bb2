"""Repeated windows of a corpus: blocks of documents, their fragments, and the exchange that settles most of them.

A window is a run of ``size`` symbols of one document. Fragments (see ``winnow``) with equal content hold equal
windows, so the first exchange compares one hash per fragment. Only the fragments of anchors that stand in more
than one context are left for a second exchange, which compares their windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import id_and_text, id_type, saved, slices
from .winnow import RangeHash, fragments

BLOCK_BYTES = 6 << 20
BUCKET_BYTES = 8 << 20
SEGMENT = 1 << 20
#: contexts of one anchor from which on its windows are dealt by their content
HOT = 20_000
SETTLED, ASKED, DONE = 0, 1, 2
BYTE_SYMBOLS = np.random.default_rng(11).integers(0, 2**63, 256, np.uint64) | np.uint64(1)
_BLANKS = bytes(32 if 9 <= c <= 13 else c for c in range(256))


@dataclass(frozen=True)
class Rule:
    """What a symbol is, how long a window, how long an anchor, and which copies count.

    ``earlier``: a window goes if a document with a smaller id has it, else if it starts anywhere else.
    """

    words: bool
    size: int
    span: int
    earlier: bool


def packed(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers as compressed planes of bytes."""
    planes = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)
    return len(columns[0]).to_bytes(8, "little") + zstandard.compress(planes, 1)


def unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    size = int.from_bytes(data[:8], "little")
    raw = np.frombuffer(zstandard.decompress(data[8:]), np.uint8).reshape(columns, 8, size)
    return [np.ascontiguousarray(c.T).view(np.int64).ravel() for c in raw]


def _blocks(id_arrow):
    def run(batches):
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        ids, texts, held = [], [], 0

        def block():
            ends = np.cumsum([len(t) for t in texts])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 32) | number], pa.int64()),
                    pa.array([ids], pa.list_(id_arrow)),
                    pa.array([ends], pa.list_(pa.int64())),
                    pa.array([int(ends[-1])], pa.int64()),
                    pa.array([zstandard.compress(b"".join(texts))], pa.binary()),
                ],
                names=["block", "ids", "ends", "size", "body"],
            )

        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                raw = text.encode() if text else b""
                if ids and held + len(raw) > BLOCK_BYTES:
                    yield block()
                    number, ids, texts, held = number + 1, [], [], 0
                ids.append(doc_id)
                texts.append(raw)
                held += len(raw)
        if ids:
            yield block()

    return run


def blocks_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents in compressed blocks of about ``BLOCK_BYTES``, written once; a longer text is a block."""
    kind = id_type(docs, id_col)
    rows = id_and_text(docs, id_col, text_col).mapInArrow(
        _blocks(to_arrow_type(docs.schema[id_col].dataType)),
        f"block long, ids array<{kind}>, ends array<long>, size long, body binary",
    )
    return saved(rows)


class Block:
    """A block's documents as symbols: their hashes, how many are left in the document, whose they are."""

    def __init__(self, batch, row: int, rule: Rule):
        self.number = batch.column("block")[row].as_py()
        self.ids = batch.column("ids")[row].values
        body, ends = zstandard.decompress(batch.column("body")[row].as_py()), batch.column("ends")[row].values.to_pylist()
        self.texts = [body[a:b] for a, b in zip([0, *ends], ends)]
        if rule.words:
            self.words = [t.translate(_BLANKS).split() for t in self.texts]
            counts = np.array([len(w) for w in self.words], np.int64)
            known: dict[bytes, int] = {}
            flat = []
            for words in self.words:
                for word in words:
                    value = known.get(word)
                    if value is None:
                        value = known[word] = xxhash.xxh3_64_intdigest(word)
                    flat.append(value)
            self.symbols = np.array(flat, np.uint64)
        else:
            counts = np.diff(np.r_[0, np.array(ends, np.int64)])
            self.raw = np.frombuffer(body, np.uint8)
            self.symbols = BYTE_SYMBOLS[self.raw]
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
        ends = self.ends.astype(np.int32)
        self.left = np.repeat(ends, counts) - np.arange(len(self.symbols), dtype=np.int32)

    def owner(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, side="right")


def _fragment_rows(rule: Rule, buckets: int):
    """Packed fragments per bucket of anchors, after what the block can settle by itself.

    Of equal fragments of a block only what others can't do without is sent: the ones of its smallest id, or one
    that is marked as settled.
    """
    names = ["bucket", "block", "kind", "data"]

    def rows(bucket, block, kind, data):
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), pa.array([block], pa.int64()), pa.array([kind], pa.int32()), pa.array([data])],
            names=names,
        )

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row, rule)
                parts = []
                for at in range(0, len(block.symbols), SEGMENT):
                    end = at + SEGMENT + rule.size - 1
                    symbols = block.symbols[at:end]
                    anchor, place, first, count = fragments(symbols, block.left[at:end], rule.size, rule.span)
                    content = RangeHash(symbols)(first, first + count + rule.size - 1) + (place - first).astype(np.uint64)
                    parts.append((anchor >> np.uint64(16), content, first + at, count, place - first))
                if not parts:
                    continue
                anchor, content, first, count, turn = (np.concatenate(c).astype(np.int64) for c in zip(*parts))
                owner = block.owner(first)
                if rule.earlier:
                    known = ~np.array(block.ids.is_null())[owner]
                    anchor, content, first, count, turn, owner = (
                        c[known] for c in (anchor, content, first, count, turn, owner)
                    )
                    rank = block.ids.fill_null(0).to_numpy()[owner]
                else:
                    rank = np.zeros(len(owner), np.int64)
                order = np.lexsort((first, rank, content, anchor))
                anchor, content, first, count, turn, rank = (c[order] for c in (anchor, content, first, count, turn, rank))
                head = np.r_[True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])][: len(anchor)]
                group = np.cumsum(head) - 1
                if rule.earlier:
                    gone = rank > rank[np.flatnonzero(head)][group] if len(group) else np.zeros(0, bool)
                    send = ~gone
                else:
                    gone = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
                    rank, send = gone.astype(np.int64), head
                lot = anchor % buckets
                if gone.any():
                    yield rows(int(block.number % buckets), block.number, DONE, packed(first[gone], count[gone]))
                order = np.flatnonzero(send)[np.argsort(lot[send], kind="stable")]
                bounds = np.flatnonzero(np.r_[True, np.diff(lot[order]) != 0, True]) if len(order) else []
                for a, b in zip(bounds[:-1], bounds[1:]):
                    take = order[a:b]
                    step = np.diff(anchor[take] // buckets, prepend=0)
                    yield rows(
                        int(lot[take[0]]), block.number, ASKED,
                        packed(step, content[take], first[take], count[take] | (turn[take] << 8), rank[take]),
                    )

    return run


def _settle(rule: Rule, buckets: int):
    """Settled fragments, and the ones of anchors with several contents that must be looked at more closely."""

    def run(key, table):
        bucket = key[0].as_py()
        out: list[tuple[int, int, bytes]] = []
        parts, numbers = [], []
        for block, kind, data in zip(*(table.column(n).to_pylist() for n in ("block", "kind", "data"))):
            if kind == DONE:
                out.append((block, SETTLED, data))
                continue
            step, *rest = unpacked(data, 5)
            parts.append((np.cumsum(step), *rest, np.full(len(step), len(numbers))))
            numbers.append(block)
        if parts:
            anchor, content, first, shape, rank, block = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((rank, content, anchor))
            anchor, content, first, shape, rank, block = (c[order] for c in (anchor, content, first, shape, rank, block))
            new_anchor = np.r_[True, anchor[1:] != anchor[:-1]]
            head = new_anchor | np.r_[True, content[1:] != content[:-1]]
            group, lot = np.cumsum(head) - 1, np.cumsum(new_anchor) - 1
            several = np.bincount(lot[head])[lot] > 1
            if rule.earlier:
                gone = rank > rank[np.flatnonzero(head)][group]
                ends = np.flatnonzero(new_anchor)
                apart = np.minimum.reduceat(rank, ends) != np.maximum.reduceat(rank, ends)  # else one document's own
                ask = several & apart[lot] & ~gone
            else:
                gone = (np.bincount(group)[group] > 1) | (np.maximum.reduceat(rank, np.flatnonzero(head))[group] > 0)
                ask = several & (head | ~gone)
            shape = shape | ((np.bincount(lot, weights=ask)[lot] > HOT).astype(np.int64) << 16)
            for number, name in enumerate(numbers):
                mine = block == number
                if (done := mine & gone).any():
                    out.append((name, SETTLED, packed(first[done], shape[done] & 255)))
                if (more := mine & ask).any():
                    out.append((name, ASKED, packed(first[more], shape[more], anchor[more] * buckets + bucket, rank[more])))
        return pa.table(
            [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.binary()))],
            names=["block", "kind", "data"],
        )

    return run


def _with_blocks(blocks: DataFrame, parts: DataFrame, how: str) -> DataFrame:
    """Each block once, beside the list of all that was found out about it."""
    return blocks.join(parts.groupBy("block").agg(F.collect_list("data").alias("parts")), "block", how)


def _closer_rows(rule: Rule, buckets: int, rows_of):
    """The asked fragments' windows, packed per bucket by ``rows_of``."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row, rule)
                asked = [unpacked(d.as_py(), 4) for d in batch.column("parts")[row].values]
                first, shape, anchor, rank = (np.concatenate(c) for c in zip(*asked))
                hot = (shape >> 16) > 0
                for lot, data in rows_of(block, first, shape & 255, (shape >> 8) & 255, anchor, rank, hot, buckets):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lot], pa.int32()), pa.array([block.number], pa.int64()), pa.array([data], pa.binary())],
                        names=["bucket", "block", "data"],
                    )

    return run


def repeated(blocks: DataFrame, rule: Rule, rows_of, judge) -> DataFrame:
    """(block, data): packed first windows and numbers of windows that the rule takes out, by block.

    ``rows_of`` makes the second exchange's rows from a block's asked fragments, ``judge`` settles a bucket of
    them. Buckets grow in number with the corpus and hold about ``BUCKET_BYTES`` of text each.
    """
    total = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    sent = blocks.mapInArrow(_fragment_rows(rule, buckets), "bucket int, block long, kind int, data binary")
    settled = saved(sent.groupBy("bucket").applyInArrow(_settle(rule, buckets), "block long, kind int, data binary"))
    asked = settled.where(F.col("kind") == ASKED).select("block", "data")
    closer = _with_blocks(blocks, asked, "inner").mapInArrow(
        _closer_rows(rule, buckets, rows_of), "bucket int, block long, data binary"
    )
    found = closer.groupBy("bucket").applyInArrow(judge, "block long, data binary")
    return settled.where(F.col("kind") == SETTLED).select("block", "data").union(found)


def cut(blocks: DataFrame, gone: DataFrame, rule: Rule, out_names: list[str], rows_of, schema: str) -> DataFrame:
    """Rows of every block's documents, made by ``rows_of(block, covered)`` from the symbols that go."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row, rule)
                edge = np.zeros(len(block.symbols) + rule.size + 1, np.int32)
                parts = batch.column("parts")[row]
                for data in parts.values if parts.is_valid else []:
                    first, count = unpacked(data.as_py(), 2)
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + count + rule.size - 1, -1)
                covered = np.cumsum(edge[: len(block.symbols)]) > 0
                arrays = rows_of(block, covered)
                yield pa.RecordBatch.from_arrays([block.ids, *arrays], names=out_names)

    return _with_blocks(blocks, gone, "left").mapInArrow(run, schema)
