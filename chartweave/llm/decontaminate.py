"""Benchmark decontamination with a generalised suffix automaton over normalised words."""

from __future__ import annotations

import pickle
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, id_type, released, saved, slices

WINDOW = 13
BLOCK_WORDS = 100_000
#: bytes of item text that one task makes automata of, one after another
BUILD_BYTES = 8 << 20
CHUNK = 1 << 20
# Every byte that is no word byte becomes a blank; A-Z become a-z.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def word_chunks(folded: bytes):
    """The words in lists of bounded length; chunks end between words."""
    at = 0
    while at < len(folded):
        end = len(folded) if len(folded) - at <= CHUNK else folded.find(b" ", at + CHUNK)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


class Automaton:
    """Suffix automaton of many word sequences that reports the windows of each sequence.

    A sequence's windows are its runs of ``window`` words, or the whole sequence if it is shorter.
    """

    def __init__(self, items, window: int):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        items = [(name, words) for name, words in items if words]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        #: state -> (length, name) of the windows that end there
        self.ends: dict[int, list[tuple[int, object]]] = {}
        for name, words in items:
            size = min(window, len(words))
            state = 0
            for place, word in enumerate(words):
                state = self.next[state][word]
                while self.length[self.link[state]] >= size:
                    state = self.link[state]
                if place + 1 >= size:
                    known = self.ends.setdefault(state, [])
                    if (size, name) not in known:
                        known.append((size, name))
        order = sorted(range(len(self.length)), key=self.length.__getitem__)
        self.marked = bytearray(len(order))
        for state in order:
            self.marked[state] = state in self.ends or (state > 0 and self.marked[self.link[state]])

    def _extend(self, last: int, word: bytes) -> int:
        to, link, length = self.next, self.link, self.length
        if word in to[last]:
            old = to[last][word]
            return old if length[old] == length[last] + 1 else self._split(last, word, old)
        new = len(length)
        to.append({})
        link.append(0)
        length.append(length[last] + 1)
        state = last
        while state >= 0 and word not in to[state]:
            to[state][word] = new
            state = link[state]
        if state >= 0:
            old = to[state][word]
            link[new] = old if length[old] == length[state] + 1 else self._split(state, word, old)
        return new

    def _split(self, state: int, word: bytes, old: int) -> int:
        to, link, length = self.next, self.link, self.length
        copy = len(length)
        to.append(dict(to[old]))
        link.append(link[old])
        length.append(length[state] + 1)
        link[old] = copy
        while state >= 0 and to[state].get(word) == old:
            to[state][word] = copy
            state = link[state]
        return copy

    def stream(self, folded: bytes):
        """Number of words, runs of hit words as [first, end), names of the items met."""
        to, link, length, marked, ends = self.next, self.link, self.length, self.marked, self.ends
        runs: list[list[int]] = []
        names: set = set()
        state = matched = place = 0
        root = to[0]
        for words in word_chunks(folded):
            for word in words:
                step = to[state].get(word)
                if step is not None:
                    state = step
                    matched += 1
                elif word not in root:
                    state = matched = 0
                else:
                    while word not in to[state]:
                        state = link[state]
                    matched = length[state] + 1
                    state = to[state][word]
                place += 1
                if marked[state]:
                    longest = 0
                    at = state
                    while at > 0 and marked[at]:
                        for size, name in ends.get(at, ()):
                            if size <= matched:
                                names.add(name)
                                longest = max(longest, size)
                        at = link[at]
                    if longest:
                        first = place - longest
                        while runs and runs[-1][0] >= first:
                            runs.pop()
                        if runs and runs[-1][1] >= first:
                            runs[-1][1] = place
                        else:
                            runs.append([first, place])
        return place, runs, names


def _merged(runs) -> list[list[int]]:
    out: list[list[int]] = []
    for first, end in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


def cut_words(text: str, runs: list[list[int]]) -> str:
    """The text without the words of the runs and what stands between them."""
    raw = text.encode()
    folded = raw.translate(_FOLD)
    spans, place, runs = [], 0, list(runs)
    for m in _WORD.finditer(folded):
        if not runs:
            break
        if place == runs[0][0]:
            spans.append([m.start(), m.end()])
        if runs[0][0] <= place < runs[0][1]:
            spans[-1][1] = m.end()
        place += 1
        if place == runs[0][1]:
            runs.pop(0)
    parts, at = [], 0
    for start, end in spans:
        parts.append(raw[at:start])
        at = end
    return b"".join([*parts, raw[at:]]).decode()


def _build(window: int, block_words: int):
    """The automata of a group of items as pickled rows, each over at most ``block_words`` words or one longer item."""

    schema = pa.schema([("group", pa.int32()), ("piece", pa.int32()), ("automaton", pa.binary())])

    def row(group, piece, block):
        data = pickle.dumps(Automaton(block, window), protocol=pickle.HIGHEST_PROTOCOL)
        return pa.RecordBatch.from_pylist([{"group": group, "piece": piece, "automaton": data}], schema)

    def run(key, items):
        made, block, held = [], [], 0
        for name, text in sorted(zip(items.column("name").to_pylist(), items.column("text").to_pylist())):
            words = words_of(text)
            if block and held + len(words) > block_words:
                made.append(row(key[0].as_py(), len(made), block))
                block, held = [], 0
            if words:
                block.append((name, words))
                held += len(words)
        if block:
            made.append(row(key[0].as_py(), len(made), block))
        return pa.Table.from_batches(made, schema)

    return run


def item_automata(
    items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``group``, ``piece`` and ``automaton`` (pickled): automata over blocks of the items, made in tasks and written.

    Different items are dealt by hash to groups of about BUILD_BYTES of text, whose task makes one automaton
    after another. Texts without words are in none, repeated items in one.
    """
    named = items.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("None")).alias("name"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    ).where(F.length("text") > 0)
    held = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first().bytes
    named = named.dropDuplicates(["name", "text"])
    named = named.withColumn("group", F.pmod(F.xxhash64("name", "text"), F.lit(held // BUILD_BYTES + 1)).cast("int"))
    made = named.groupBy("group").applyInArrow(_build(window, block_words), "group int, piece int, automaton binary")
    return saved(made)


def match_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    min_share: float = 0.05,
    block_words: int = BLOCK_WORDS,
    with_text: bool = False,
) -> DataFrame:
    """One row per input row: ``n_words``, ``n_hit``, ``n_items``, ``items`` (their ids as text, comma-joined in
    text order) and ``contaminated``, true if there is a hit and hits are at least ``min_share`` of the words.
    ``with_text`` adds ``clean_text``, the text with all hit words cut out.

    Words are runs of ASCII letters and digits and of all other non-ASCII characters, A-Z lower-cased. A window
    is ``window`` consecutive words of an item, or a whole shorter item. The automaton takes blocks of at most
    ``block_words`` item words (a longer item is a block of its own). Automata are made in tasks and written; the
    driver then hands out one at a time. Each is one pass over the documents, whose result is written before the
    next, with the automaton and the result before it given back: a larger benchmark costs more passes, and the
    driver and the workers hold one automaton whatever its size. Nothing is shuffled but the items.
    Null and empty texts have no words and are clean, items without words match nothing, items with a null id
    are named ``None``, repeated items count once, repeated rows get a row each, an empty table on either side
    gives a full result, and other columns are not read.
    """
    context = docs.sparkSession.sparkContext
    kind = id_type(docs, id_col)
    state = "id {0}, text string, n_words long, runs array<array<int>>, items array<string>".format(kind)
    frame = id_and_text(docs, id_col, text_col)
    automata = item_automata(items, item_id_col, item_text_col, window, block_words)
    names = [(r.group, r.piece) for r in automata.select("group", "piece").orderBy("group", "piece").collect()]
    written = None
    for at, (group, piece) in enumerate(names):
        one = automata.where((F.col("group") == group) & (F.col("piece") == piece)).select("automaton").first()
        shared = context.broadcast(bytes(one.automaton))
        frame = frame.mapInArrow(_pass(shared, at == 0), state)
        if at + 1 < len(names):
            frame = saved(frame)
            shared.destroy()
            if written is not None:
                released(written)
            written = frame
    if not names:
        shared = context.broadcast(pickle.dumps(Automaton([], window)))
        frame = frame.mapInArrow(_pass(shared, True), state)
    return frame.mapInArrow(
        _verdict(min_share),
        f"id {kind}, n_words long, n_hit long, n_items long, items string, contaminated boolean, clean_text string",
    ).drop(*([] if with_text else ["clean_text"])).withColumnRenamed("id", id_col)


#: the automaton that this Python worker holds, under the number of its broadcast
_held: dict[int, Automaton] = {}


def _received(shared, number: int) -> Automaton:
    if number not in _held:
        _held.clear()
        _held[number] = pickle.loads(shared.value)
    return _held[number]


def _pass(shared, first: bool):
    number = shared._jbroadcast.id()
    runs_type = pa.list_(pa.list_(pa.int32()))

    def run(batches):
        automaton = _received(shared, number)
        for batch in slices(batches, "text"):
            counts, spans, names = [], [], []
            old = None if first else (batch.column("runs").to_pylist(), batch.column("items").to_pylist())
            for row, text in enumerate(batch.column("text").to_pylist()):
                n, runs, met = automaton.stream((text or "").encode().translate(_FOLD))
                if old:
                    runs, met = _merged(runs + old[0][row]), met | set(old[1][row])
                counts.append(n)
                spans.append(runs)
                names.append(sorted(met))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("text"), pa.array(counts, pa.int64()),
                    pa.array(spans, runs_type), pa.array(names, pa.list_(pa.string())),
                ],
                names=["id", "text", "n_words", "runs", "items"],
            )

    return run


def _verdict(min_share: float):
    from fractions import Fraction

    share = Fraction(str(min_share))

    def run(batches):
        for batch in batches:
            words = batch.column("n_words").to_pylist()
            runs = batch.column("runs").to_pylist()
            items = batch.column("items").to_pylist()
            hits = [sum(end - first for first, end in r) for r in runs]
            texts = batch.column("text").to_pylist() if any(hits) else None
            clean = batch.column("text")
            if texts:
                clean = pa.array([cut_words(t, r) if r else t for t, r in zip(texts, runs)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("n_words"), pa.array(hits, pa.int64()),
                    pa.array([len(i) for i in items], pa.int64()), pa.array([",".join(i) for i in items], pa.string()),
                    pa.array([h > 0 and h >= share * n for h, n in zip(hits, words)], pa.bool_()), clean,
                ],
                names=["id", "n_words", "n_hit", "n_items", "items", "contaminated", "clean_text"],
            )

    return run
