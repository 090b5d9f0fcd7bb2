"""Suffix-array dedup with a run-length index: long byte runs that an earlier document has."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import id_type
from .repeats import BYTE_SYMBOLS, Rule, blocks_of, cut, packed, repeated, unpacked
from .winnow import RangeHash, mixed

WINDOW = 50
ANCHOR = 16
INDEX_BYTES = 1_500_000


class RunIndex:
    """A run-compressed Burrows-Wheeler transform of byte strings that come in the order of their documents.

    Suffixes end with their string; equal ones stand in document order. A run is a stretch of rows with one
    preceding byte and one ``size``-byte prefix. Every run keeps where it starts, how often its byte came before
    it, and a sample: the first document among its rows; the samples of all runs of a prefix give the first
    document that has it. Streaming a string from its end, one step is a lookup in its row's run.
    """

    def __init__(self, raw: np.ndarray, lengths: np.ndarray, docs: np.ndarray, size: int):
        count = len(lengths)
        stops = np.cumsum(lengths + 1) - 1
        text = np.zeros(int(stops[-1]) + 1, np.uint8)
        letters = np.ones(len(text), bool)
        letters[stops] = False
        text[letters] = raw + 1  # 0xFF is no byte of UTF-8, so nothing overflows into the end mark 0
        stop = np.repeat(stops, lengths + 1)
        at = np.arange(len(text))
        rows, half, width = self._sorted(text, at, stop, int(lengths.max(initial=0)), size)

        before = text[rows - 1]
        before[rows == 0] = 0
        full = stop - at >= size
        tail = np.minimum(at + size - width, stop)
        a, b = rows[1:], rows[:-1]
        same = (half[a] == half[b]) & (half[tail[a]] == half[tail[b]]) & full[a] & full[b]
        head = np.r_[True, (before[1:] != before[:-1]) | ~same]
        self.starts = np.flatnonzero(head)
        self.run_of = np.cumsum(head, dtype=np.int32) - 1
        self.byte = before[self.starts]
        sizes = np.diff(np.r_[self.starts, len(rows)])
        order = np.argsort(self.byte, kind="stable")
        running = np.cumsum(sizes[order]) - sizes[order]
        # rows before the run whose suffix begins with a smaller byte, or with this byte by an earlier run
        self.to = np.empty(len(sizes), np.int64)
        self.to[order] = running
        sample = np.minimum.reduceat(np.repeat(docs, lengths + 1)[rows], self.starts)
        group = np.cumsum(np.r_[True, ~same][self.starts]) - 1
        first = np.full(group[-1] + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, group, sample)
        self.first_doc = first[group]
        self.count, self.size = count, size

    @staticmethod
    def _sorted(text, at, stop, longest: int, size: int):
        """Rows in suffix order; ranks by prefixes of the largest power of two up to ``size``, and that power.

        Sorting by prefixes of doubling length; it ends early once all suffixes differ.
        """
        padded = np.concatenate([text, np.zeros(8, np.uint8)])
        key = np.zeros(len(text), np.uint64)
        inside = np.ones(len(text), bool)
        for k in range(8):
            now = padded[k : k + len(text)] * inside
            inside &= now != 0
            key = (key << np.uint64(8)) | now
        width, half, kept, places = 8, None, 8, 0
        while True:
            rows = np.argsort(key)
            ordered = key[rows]
            step = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]])
            rank = np.empty(len(text), np.int64)
            rank[rows] = step
            if width <= size:
                half, kept = rank, width
            settled = step[-1] + 1 == len(text) or step[-1] + 1 == places or width > longest
            if settled and 2 * width > size:
                # equal suffixes stand in document order
                return np.argsort((rank.astype(np.uint64) << np.uint64(32)) | at.astype(np.uint64)), half, kept
            places = step[-1] + 1
            on = at + width
            follower = np.where(on < stop, rank[np.minimum(on, stop)] + 1, 0)
            key = (rank.astype(np.uint64) << np.uint64(32)) | follower.astype(np.uint64)
            width *= 2

    def stream(self, lengths: np.ndarray):
        """For every string and each place from its end on: (strings, distance from the end, first document).

        The strings are the indexed ones in their order; only places with ``size`` bytes ahead are given.
        """
        row, alive = np.arange(self.count), np.arange(self.count)
        for distance in range(1, int(lengths.max(initial=0)) + 1):
            more = lengths[alive] >= distance
            row, alive = row[more], alive[more]
            run = self.run_of[row]
            row = self.to[run] + row - self.starts[run]
            if distance >= self.size:
                yield alive, distance, self.first_doc[self.run_of[row]]


def _strings(size: int):
    """The asked fragments' bytes, packed per bucket."""

    def rows(block, first, count, turn, anchor, rank, hot, buckets: int):
        lot = anchor % buckets
        if hot.any():  # an anchor in too many contexts: windows one by one, dealt by their content
            ends = np.cumsum(count[hot])
            start = np.repeat(first[hot], count[hot]) + np.arange(ends[-1]) - np.repeat(ends - count[hot], count[hot])
            dealt = RangeHash(block.symbols)(start, start + size).view(np.int64)
            rank = np.r_[rank[~hot], np.repeat(rank[hot], count[hot])]
            turn = np.r_[turn[~hot], np.full(len(start), -1)]
            first, count = np.r_[first[~hot], start], np.r_[count[~hot], np.ones(len(start), np.int64)]
            anchor, lot = np.r_[anchor[~hot], dealt], np.r_[lot[~hot], dealt % buckets]
        order = np.lexsort((first, lot))
        bounds = np.flatnonzero(np.r_[True, np.diff(lot[order]) != 0, True])
        for a, b in zip(bounds[:-1], bounds[1:]):
            take = order[a:b]
            head = packed(anchor[take], first[take], count[take], rank[take], turn[take])
            body = b"".join(block.raw[f : f + c + size - 1].tobytes() for f, c in zip(first[take], count[take]))
            yield int(lot[take[0]]), len(head).to_bytes(8, "little") + head + zstandard.compress(body)

    return rows


def _may_share(raw, anchor, place, lengths, turn, span: int, size: int) -> np.ndarray:
    """Fragments that agree with another one of their anchor on the half of a window left or right of it.

    What a window has beyond the anchor lies at least half on one side, so others share no window.
    """
    half = (size - span + 1) // 2
    content = RangeHash(BYTE_SYMBOLS[raw])
    out = turn < 0
    middle = place + turn
    for start, end, whole in (
        (middle - half, middle + span, turn >= half),
        (middle, middle + span + half, turn + span + half <= lengths),
    ):
        rows = np.flatnonzero(whole & (turn >= 0))
        key = mixed(anchor[rows].astype(np.uint64)) + content(start[rows], end[rows])
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        out[rows] |= times[which] > 1
    return out


def _earlier(size: int, span: int):
    """Windows of a bucket that a document with a smaller id has."""

    def run(key, table):
        names = table.column("block").to_pylist()
        heads, bodies = [], []
        for number, data in enumerate(table.column("data").to_pylist()):
            cut_at = 8 + int.from_bytes(data[:8], "little")
            columns = unpacked(data[8:cut_at], 5)
            heads.append((*columns, np.full(len(columns[0]), number)))
            bodies.append(np.frombuffer(zstandard.decompress(data[cut_at:]), np.uint8))
        anchor, first, count, rank, turn, block = (np.concatenate(c) for c in zip(*heads))
        raw, lengths = np.concatenate(bodies), count + size - 1
        place = np.cumsum(lengths) - lengths
        likely = np.flatnonzero(_may_share(raw, anchor, place, lengths, turn, span, size))
        anchor, first, rank, block, lengths, place = (c[likely] for c in (anchor, first, rank, block, lengths, place))
        if not len(likely):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.binary())], names=["block", "data"])
        order = np.argsort(anchor, kind="stable")
        filled = np.cumsum(lengths[order])
        new = np.flatnonzero(np.r_[True, anchor[order][1:] != anchor[order][:-1]])
        cuts, last = [0], 0
        for at in new[1:]:
            if filled[at - 1] - last > INDEX_BYTES:
                cuts.append(at)
                last = filled[at - 1]
        blocks, starts = [], []
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            part = order[a:b]
            part = part[np.argsort(rank[part], kind="stable")]
            own, docs = lengths[part], rank[part]
            ends = np.cumsum(own)
            where = np.repeat(place[part] - ends + own, own) + np.arange(ends[-1])
            index = RunIndex(raw[where], own, docs, size)
            for strings, distance, earliest in index.stream(own):
                found = strings[earliest < docs[strings]]
                blocks.append(block[part[found]])
                starts.append(first[part[found]] + own[found] - distance)
        blocks, starts = np.concatenate(blocks), np.concatenate(starts)
        order = np.lexsort((starts, blocks))
        blocks, starts = blocks[order], starts[order]
        head = np.flatnonzero(np.r_[True, (blocks[1:] != blocks[:-1]) | (starts[1:] > starts[:-1] + 1)][: len(starts)])
        runs = starts[np.r_[head[1:], len(starts)] - 1] - starts[head] + 1 if len(head) else starts
        owner, starts = blocks[head], starts[head]
        out = []
        for number in np.unique(owner):
            mine = owner == number
            out.append((names[number], packed(starts[mine], runs[mine])))
        return pa.table(
            [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], names=["block", "data"]
        )

    return run


def _kept(block, covered: np.ndarray):
    counts = block.ends - block.starts
    total = np.r_[0, np.cumsum(covered)]
    removed = total[block.ends] - total[block.starts]
    begins = covered.copy()
    begins[1:] &= ~covered[:-1]
    inner = block.starts[counts > 0]
    begins[inner] = covered[inner]
    spans = np.r_[0, np.cumsum(begins)]
    spans = spans[block.ends] - spans[block.starts]
    kept = [
        block.raw[a:b][~covered[a:b]].tobytes() if gone else text
        for a, b, gone, text in zip(block.starts, block.ends, removed, block.texts)
    ]
    return [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())]


def cut_earlier_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """One row per input row: the id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the bytes left).

    A byte goes if a string of ``window`` bytes that covers it also starts in a document with a smaller id;
    strings are judged on the input and never cross documents (``window`` is 8 at least). ``n_spans`` counts the maximal removed runs. Ids
    are integers; rows that share an id are one document for this rule, so repeated rows don't remove each other;
    a row with a null id is kept whole and removes nothing. Null and empty texts have no bytes; an empty table
    gives an empty result; no other column is read.

    Fragments around winnowed anchors settle most strings by one hash. Where an anchor stands in several
    contexts, its distinct fragments meet in a bucket, a run-length index is built over them in document order,
    and each streams through it for its matching statistics: a place goes if the first document among the rows
    that share its next ``window`` bytes is an earlier one. An index holds about ``INDEX_BYTES`` and never parts
    an anchor; an anchor in very many contexts is dealt on as single strings by their content.
    """
    rule = Rule(words=False, size=window, span=anchor, earlier=True)
    blocks = blocks_of(docs, id_col, text_col)
    gone = repeated(blocks, rule, _strings(window), _earlier(window, anchor))
    return cut(
        blocks, gone, rule, ["id", "n_bytes", "n_removed", "n_spans", "kept"], _kept,
        f"id {id_type(docs, id_col)}, n_bytes long, n_removed long, n_spans long, kept binary",
    ).withColumnRenamed("id", id_col)
