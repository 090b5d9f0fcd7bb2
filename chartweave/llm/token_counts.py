"""Token counts per document, without ids.

Each distinct pre-token of the corpus is run through the tokenizer once; documents keep only how often they
hold each pre-token, and the counts meet in a join.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, id_type, saved, slices

BLOCK_BYTES = 32 << 20
LONG_TEXT = 1 << 20
PACK_ROWS = 4_000_000
# Fixed value: the published split pattern of byte-level BPE vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Splitter:
    """Pre-tokens of a text as the tokenizer makes them, and the number of special strings in it.

    The pattern runs in ``regex``. Its Unicode tables may be newer than the tokenizer's, so each non-ASCII
    character is compared once; a text with a character on which the two differ is split by the tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.pattern = regex.compile(SPLIT)
        special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.marks = special
        self.same: dict[str, bool] = {}

    def _agrees(self, text: str) -> bool:
        if text.isascii():
            return True
        for char in set(text):
            known = self.same.get(char)
            if known is None:
                known = True
                if char > "\x7f":
                    probe = f"a{char}1{char}!{char} {char}{char}"
                    ours = [m.span() for m in self.pattern.finditer(probe)]
                    known = ours == [span for _, span in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)]
                self.same[char] = known
            if not known:
                return False
        return True

    def _pieces(self, text: str):
        if not self._agrees(text):
            return Counter(text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))
        if len(text) > LONG_TEXT:
            return Counter(m.group() for m in self.pattern.finditer(text))
        return Counter(self.pattern.findall(text))

    def __call__(self, text: str) -> tuple[Counter, int]:
        if self.special and any(mark in text for mark in self.marks):
            parts = self.special.split(text)
            pieces: Counter = Counter()
            for part in parts:
                pieces.update(self._pieces(part))
            return pieces, len(parts) - 1
        return self._pieces(text), 0


def _squeezed(numbers: np.ndarray) -> bytes:
    """32-bit numbers as four planes of bytes, compressed; the upper planes of small numbers vanish."""
    return zstandard.compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unsqueezed(planes: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(planes), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view(np.int32).ravel()


def _blocks(path: str, id_arrow):
    """Per block of documents: its distinct pre-tokens, and each document's frequencies by place in that list."""

    def run(batches):
        from pyspark import TaskContext

        split = Splitter(path)
        task, number = TaskContext.get().partitionId(), 0
        places: dict[str, int] = {}
        ids, sizes, special, ends, keys, times = [], [], [], [], [], []
        held = total = 0

        def block():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 32) | number], pa.int64()),
                    pa.array([list(places)], pa.list_(pa.string())),
                    pa.array([ids], pa.list_(id_arrow)),
                    pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([special], pa.list_(pa.int64())),
                    pa.array([ends], pa.list_(pa.int64())),
                    pa.array([_squeezed(np.concatenate(keys))]),
                    pa.array([_squeezed(np.concatenate(times))]),
                ],
                names=BLOCK_COLUMNS,
            )

        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                text = text or ""
                size = len(text.encode())
                if ids and held + size > BLOCK_BYTES:
                    yield block()
                    number += 1
                    places, ids, sizes, special, ends, keys, times = {}, [], [], [], [], [], []
                    held = total = 0
                pieces, marks = split(text)
                own = np.fromiter((places.setdefault(p, len(places)) for p in pieces), np.int32, len(pieces))
                order = np.argsort(own)
                keys.append(np.diff(own[order], prepend=np.int32(0)))  # steps from the document's last place
                times.append(np.fromiter(pieces.values(), np.int32, len(pieces))[order])
                held += size
                total += len(pieces)
                ids.append(doc_id)
                sizes.append(size)
                special.append(marks)
                ends.append(total)
        if ids:
            yield block()

    return run


BLOCK_COLUMNS = ["block", "pieces", "ids", "sizes", "special", "ends", "keys", "times"]


def _piece_counts(path: str):
    """Token counts by (block, place), packed per block, of rows in the order of their pieces.

    A piece is tokenized once per run of equal pieces.
    """

    def packed(blocks, places, counts):
        blocks, places, counts = map(np.concatenate, (blocks, places, counts))
        order = np.lexsort((places, blocks))
        blocks, places, counts = blocks[order], places[order], counts[order]
        starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
        bounds = list(zip(starts, [*starts[1:], len(blocks)]))
        return pa.RecordBatch.from_arrays(
            [pa.array(blocks[starts]), *(pa.array([_squeezed(x[a:b]) for a, b in bounds]) for x in (places, counts))],
            names=["block", "places", "counts"],
        )

    def run(batches):
        tokenizer = _tokenizer(path)
        last, known, held, rows = None, 0, 0, ([], [], [])
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = pc.run_end_encode(batch.column("piece"))
            pieces, ends = runs.values.to_pylist(), runs.run_ends.to_numpy()
            fresh = pieces[1:] if pieces[0] == last else pieces
            counts = [len(e.ids) for e in tokenizer.encode_batch(fresh, add_special_tokens=False)]
            counts = [known] * (len(pieces) - len(fresh)) + counts
            last, known = pieces[-1], counts[-1]
            rows[0].append(batch.column("block").to_numpy())
            rows[1].append(batch.column("place").to_numpy())
            rows[2].append(np.repeat(np.array(counts, np.int32), np.diff(ends, prepend=0)))
            held += batch.num_rows
            if held > PACK_ROWS:
                yield packed(*rows)
                held, rows = 0, ([], [], [])
        if held:
            yield packed(*rows)

    return run


def _sums(batches):
    for batch in batches:
        rows = {name: batch.column(name) for name in batch.schema.names}
        for i in range(batch.num_rows):
            ids = rows["ids"][i].values
            ends = rows["ends"][i].values.to_numpy()
            steps = np.cumsum(_unsqueezed(rows["keys"][i].as_py()), dtype=np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            keys = steps - np.repeat(np.where(starts > 0, steps[starts - 1] if len(steps) else 0, 0), ends - starts)
            times = _unsqueezed(rows["times"][i].as_py())
            parts = [
                (_unsqueezed(p["places"]), _unsqueezed(p["counts"])) for p in rows["parts"][i].as_py() or []
            ]
            counts = np.zeros(1 + max((places[-1] for places, _ in parts), default=0), np.int64)
            for places, own in parts:
                counts[places] = own
            running = np.concatenate([[0], np.cumsum(counts[keys] * times)])
            tokens = np.diff(running[np.concatenate([[0], ends])]) + rows["special"][i].values.to_numpy()
            yield pa.RecordBatch.from_arrays(
                [ids, rows["sizes"][i].values, pa.array(tokens, pa.int64())], names=["id", "n_bytes", "n_tokens"]
            )


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id, ``n_bytes`` (UTF-8) and ``n_tokens`` of the tokenizer file at ``path``.

    For byte-level BPE files of the ``tokenizers`` library. The counts are those of ``encode`` without added
    begin, end or padding tokens; special strings inside a text are one token each, as is that library's
    default. A null or empty text has no tokens, repeated rows are counted each, a null id stays null, an
    empty table gives an empty result, and other columns are not read.

    Documents travel as blocks of about 32 MB of text: a list of the block's distinct pre-tokens and, per
    document, places in that list with frequencies. Only (block, pre-token) rows are shuffled, so neither a
    frequent pre-token nor a hot source gathers more than one row per block; rows of one pre-token meet in one
    task in sorted order, where it is tokenized once.
    """
    kind = id_type(docs, id_col)
    texts = id_and_text(docs, id_col, text_col)
    from pyspark.sql.pandas.types import to_arrow_type

    id_arrow = to_arrow_type(docs.schema[id_col].dataType)
    blocks = saved(
        texts.mapInArrow(
            _blocks(path, id_arrow),
            f"block long, pieces array<string>, ids array<{kind}>, sizes array<long>, special array<long>, "
            "ends array<long>, keys binary, times binary",
        )
    )
    listed = blocks.select("block", F.posexplode("pieces").alias("place", "piece"))
    found = (
        listed.repartition("piece")
        .sortWithinPartitions("piece")
        .mapInArrow(_piece_counts(path), "block long, places binary, counts binary")
        .groupBy("block")
        .agg(F.collect_list(F.struct("places", "counts")).alias("parts"))
    )
    return (
        blocks.drop("pieces")
        .join(found, "block", "left")
        .mapInArrow(_sums, f"id {kind}, n_bytes long, n_tokens long")
        .withColumnRenamed("id", id_col)
    )
