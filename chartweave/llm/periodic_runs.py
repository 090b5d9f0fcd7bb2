"""Periodic runs of words, found by catching squares over power-of-two blocks.

The words of a document are a stream. At level ``k`` every completed block of ``L = 2**k`` words, starting at a
multiple of ``L``, becomes a catcher: it watches the words after it for its own copy ``q`` words later, for the
periods ``q`` of its level. A run of period ``q`` that is at least ``exponent`` periods long equals itself ``q``
words on over at least ``(exponent - 1) * q`` words, so it holds a whole block whenever
``2 * L - 1 <= (exponent - 1) * q``; a period belongs to the largest such level. A copy that a catcher sees is a
square. Squares of neighbouring catchers with one period are the same repetition and merge; suffix comparisons over
the halves, quarters, ... of a block then move both ends to the first words that break the period. Of the periods
of one stretch the smallest is the run's, the others are its multiples.

The catchers of a level see all appended words in one vector step, and many documents, with a word of its own after
each, are one stream; so work is about ``n * log(n)`` word comparisons however the words repeat. Blocks are
compared by 64-bit names made from the names of their halves. Every run is then checked word by word, at its ends as
well; if a name was shared by two different blocks, the stream is searched again under other names.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, id_type, map_texts

EXPONENT = 4
SHORTEST = 6
#: documents whose lengths differ by less than this factor are searched as one stream
SIZE_STEP = 4


def collapse_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = EXPONENT, shortest: int = SHORTEST
) -> DataFrame:
    """The runs of every document and its text with each run cut to its first period.

    Words are what lies between bytes 9 to 13 and 32. A run is a stretch of consecutive words of smallest period
    ``q``, at least ``exponent * q`` and ``shortest`` words long, that no neighbouring word extends with that
    period. A word that any run holds after its first ``q`` words goes. Returns ``(id_col, n_words, n_runs, start,
    length, period, exponent_milli, runs, collapsed)``: the run of the greatest length / period (ties: smallest
    start, then period; four nulls if there is none), all runs as lines ``start,length,period`` and the kept words
    joined by one space.

    Null, empty and blank texts have no words, no runs and empty texts. Repeated rows and null ids are judged row
    by row, an empty table gives an empty result, other columns are not read. A text is searched whole, in one
    task; nothing is shuffled.
    """
    kind = id_type(docs, id_col)

    def work(batch):
        texts = batch.column("text").to_pylist()
        words = [(t or "").encode().split() for t in texts]
        found = runs_of(words, exponent, shortest)
        columns = zip(*[_report(w, r) for w, r in zip(words, found)])
        kinds = [pa.int64()] * len(NUMBERS) + [pa.string()] * len(TEXTS)
        report = {name: pa.array(c, t) for name, c, t in zip((*NUMBERS, *TEXTS), columns, kinds)}
        return {id_col: batch.column("id"), **report}

    columns = ", ".join([*(f"{c} bigint" for c in NUMBERS), *(f"{c} string" for c in TEXTS)])
    return map_texts(id_and_text(docs, id_col, text_col), "text", work, f"`{id_col}` {kind}, {columns}")


NUMBERS = ("n_words", "n_runs", "start", "length", "period", "exponent_milli")
TEXTS = ("runs", "collapsed")


def _report(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    if not runs:
        return len(words), 0, None, None, None, None, "", b" ".join(words).decode()
    start, length, period = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    kept = bytearray(b"\x01") * len(words)
    for at, size, q in runs:
        kept[at + q : at + size] = bytes(size - q)
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    collapsed = b" ".join(w for w, keep in zip(words, kept) if keep).decode()
    return len(words), len(runs), start, length, period, 1000 * length // period, lines, collapsed


def runs_of(texts: list[list], exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """The runs ``(start, length, period)`` of each list of words, by start and then period."""
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for members in _by_size([len(t) for t in texts], max(exponent, shortest)):
        stream, firsts = _stream([texts[i] for i in members])
        longest = max(len(texts[i]) for i in members) // exponent
        runs = stream_runs(stream, longest, exponent, shortest)
        for place, start, length, period in zip(
            np.searchsorted(firsts, runs[:, 0], side="right") - 1, *(runs[:, c] for c in range(3))
        ):
            found[members[place]].append((int(start - firsts[place]), int(length), int(period)))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def _by_size(lengths: list[int], least: int) -> list[list[int]]:
    classes: dict[int, list[int]] = {}
    for i, n in enumerate(lengths):
        if n >= least:
            size = 0
            while n >= SIZE_STEP:
                n, size = n // SIZE_STEP, size + 1
            classes.setdefault(size, []).append(i)
    return list(classes.values())


def _stream(texts: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, equal for equal words, with a number of its own after each text; the texts' starts."""
    known: dict = {}
    numbers: list[int] = []
    firsts = []
    for i, words in enumerate(texts):
        firsts.append(len(numbers))
        numbers.extend([known.setdefault(w, len(known)) for w in words])
        numbers.append(-1 - i)
    return np.array(numbers, dtype=np.int64), np.array(firsts, dtype=np.int64)


def stream_runs(stream: np.ndarray, longest: int, exponent: int, shortest: int) -> np.ndarray:
    """Rows ``(start, length, period)`` of all runs in the stream with periods up to ``longest``."""
    for seed in range(1, 100):
        runs = _merged(_squares(stream, longest, exponent, seed), exponent, shortest)
        if all(_holds(stream, *map(int, run)) for run in runs):
            return runs
    raise ArithmeticError("block names keep colliding")


def _squares(stream: np.ndarray, longest: int, exponent: int, seed: int) -> np.ndarray:
    """Rows ``(first, end, period)`` of stretches that equal what lies a period on, as far as they reach."""
    names = [_scrambled(stream.view(np.uint64), seed)]
    found = [np.empty((0, 3), dtype=np.int64)]
    size = 1
    while True:
        low, high = _periods(size, exponent)
        if low > longest:
            return np.concatenate(found)
        found.append(_caught(names, size, low, min(high, longest)))
        half = names[-1]
        if len(half) <= size:
            return np.concatenate(found)
        names.append(_scrambled(half[:-size] * np.uint64(0x9E3779B97F4A7C15) + _scrambled(half[size:], seed), seed + size))
        size *= 2


def _periods(size: int, exponent: int) -> tuple[int, int]:
    """First and last period of the catchers of ``size`` words."""
    reach = exponent - 1
    return -(-(2 * size - 1) // reach), -(-(4 * size - 1) // reach) - 1


def _scrambled(values: np.ndarray, seed: int) -> np.ndarray:
    # fixed values: multipliers of the splitmix64 finaliser
    values = values + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _caught(names: list[np.ndarray], size: int, low: int, high: int) -> np.ndarray:
    """What the catchers of one level report, merged over neighbours and extended at both ends."""
    table = names[-1]
    periods = np.arange(low, high + 1)
    blocks = np.arange(0, len(table), size)
    if not len(blocks) or not len(periods):
        return np.empty((0, 3), dtype=np.int64)
    seen = np.zeros((len(periods), len(blocks) + 2), dtype=bool)
    for row, q in enumerate(periods):
        later = table[q::size]
        seen[row, 1 : 1 + len(later)] = table[blocks[: len(later)]] == later
    here = seen[:, 1:-1]
    at, first = np.nonzero(here & ~seen[:, :-2])
    _, last = np.nonzero(here & ~seen[:, 2:])
    q, start, end = periods[at], first * size, (last + 1) * size
    for level in range(len(names) - 2, -1, -1):
        step, part = 1 << level, names[level]
        back = np.maximum(start - step, 0)
        start = np.where((start >= step) & (part[back] == part[np.minimum(back + q, len(part) - 1)]), back, start)
        fits = end + q < len(part)
        ahead = np.where(fits, end, 0)
        end = np.where(fits & (part[ahead] == part[np.minimum(ahead + q, len(part) - 1)]), end + step, end)
    return np.stack([start, end, q], axis=1)


def _merged(squares: np.ndarray, exponent: int, shortest: int) -> np.ndarray:
    start, q = squares[:, 0], squares[:, 2]
    length = squares[:, 1] + q - start
    runs = np.stack([start, length, q], axis=1)[length >= np.maximum(shortest, exponent * q)]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    same = np.zeros(len(runs), dtype=bool)
    same[1:] = (runs[1:, :2] == runs[:-1, :2]).all(axis=1)
    return runs[~same]


def _holds(stream: np.ndarray, start: int, length: int, q: int) -> bool:
    """The stretch has this period, and no neighbouring word extends it."""
    end = start + length
    return (
        np.array_equal(stream[start : end - q], stream[start + q : end])
        and (start == 0 or stream[start - 1] != stream[start - 1 + q])
        and (end == len(stream) or stream[end] != stream[end - q])
    )
