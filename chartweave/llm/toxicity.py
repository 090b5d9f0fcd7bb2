"""Toxicity: a weighted lexicon, matched by Aho-Corasick in folded text and normalised by length."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, id_type, map_texts, saved

TRAIN_ROWS = 20_000
LEXICON_TERMS = 4096
EXCEPTIONS = 1024
PREFIXES = range(3, 9)
MIN_TOXIC = 4
MIN_WEIGHT = 2.0
FLUSH = 400_000

# Characters drawn like a Latin letter, and digits and signs used in a letter's place.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "һ": "h", "ӏ": "l", "ո": "n", "υ": "u", "ν": "v", "ο": "o", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ρ": "p",
    "τ": "t", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ⅰ": "i",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
UNSEEN = "​‌‍⁠﻿­"


class _Fold(dict):
    """Character table of ``str.translate``, filled as characters are met; all but letters become blanks."""

    def __missing__(self, code: int):
        char = chr(code)
        low = char.lower()
        if 0xFF01 <= code <= 0xFF5E:
            low = chr(code - 0xFEE0).lower()
        low = HOMOGLYPHS.get(low, SUBSTITUTES.get(low, low))
        value = None if char in UNSEEN else low if low.isalpha() or not low.isascii() and low.isalnum() else " "
        self[code] = value
        return value


_TABLE = _Fold()
_ASCII = bytes(ord(_TABLE[c]) for c in range(128)) + bytes(range(128, 256))


def folded(text: str | None) -> str:
    """Lower-case words between single or repeated blanks, with one blank at either end."""
    if not text:
        return "  "
    plain = text.encode("ascii").translate(_ASCII).decode("ascii") if text.isascii() else text.translate(_TABLE)
    return f" {plain} "


def _features(words) -> set[str]:
    """Whole words, closed by a blank, and word beginnings."""
    found = {f"{w} " for w in words}
    for word in words:
        found.update(word[:n] for n in PREFIXES if n <= len(word))
    return found


@dataclass
class Lexicon:
    """Terms start at a word's beginning; one that ends in a blank is a whole word, any other a word beginning.

    ``exceptions`` are phrases of folded words; a term that begins inside such a phrase doesn't count.
    ``bias``, ``total`` and ``density`` turn a document's sums into a score.
    """

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    bias: float = -4.0
    total: float = 1.0
    density: float = 1.0

    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            machine.add_word(f" {term}", (len(term) + 1, weight))
        for phrase in self.exceptions:
            machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
        if len(machine):
            machine.make_automaton()
        return machine


def hits(machine, text: str) -> dict[int, float]:
    """Weight of the heaviest term at each word start that has one, outside exception phrases."""
    found: dict[int, float] = {}
    exempt: list[tuple[int, int]] = []
    if len(machine):
        for end, (size, weight) in machine.iter(text):
            start = end - size + 1
            if weight is None:
                exempt.append((start, end))
            elif weight > found.get(start, 0.0):
                found[start] = weight
    if exempt and found:
        found = {s: w for s, w in found.items() if not any(a <= s < b for a, b in exempt)}
    return found


def _inputs(machine, text: str) -> tuple[float, float]:
    found = hits(machine, text)
    if not found:
        return 0.0, 0.0
    weight = sum(found.values())
    return math.log1p(weight), weight / math.sqrt(len(text.split()))


def _term_counts(batches):
    """Documents of either label that hold each feature, summed in the task before they are shuffled."""

    def rows():
        names = list(seen)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([seen[n][k] for n in names], pa.int64()) for k in (0, 1))],
            names=["term", "clean", "toxic"],
        )

    seen: dict[str, list[int]] = {}
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            for feature in _features(set(folded(text).split())):
                seen.setdefault(feature, [0, 0])[label] += 1
            if len(seen) > FLUSH:
                yield rows()
                seen = {}
    yield rows()


def _phrase_counts(terms: dict[str, float]):
    def run(batches):
        machine = Lexicon(terms).automaton()
        seen: dict[str, list[int]] = {}
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                text = folded(text)
                phrases = set()
                for start in hits(machine, text):
                    before, after = text[max(0, start - 80) : start + 1].split(), text[start : start + 160].split()
                    if before:
                        phrases.add(f"{before[-1]} {after[0]}")
                    if len(after) > 2:
                        phrases.add(f"{after[0]} {after[1]}")
                for phrase in phrases:
                    seen.setdefault(phrase, [0, 0])[label] += 1
        names = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([seen[n][k] for n in names], pa.int64()) for k in (0, 1))],
            names=["phrase", "clean", "toxic"],
        )

    return run


def _sums(lexicon: Lexicon):
    def work(batch: pa.RecordBatch) -> dict:
        machine = lexicon.automaton()
        pairs = [_inputs(machine, folded(t)) for t in batch.column("text").to_pylist()]
        return {"label": batch.column("label"), "total": [p[0] for p in pairs], "density": [p[1] for p in pairs]}

    return work


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the first column of ``x`` is the constant."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [1e-2] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge @ w
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def learn_lexicon(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_rows: int = TRAIN_ROWS,
    max_terms: int = LEXICON_TERMS,
) -> Lexicon:
    """Learn terms, their weights and exception phrases from labelled documents.

    At most about ``train_rows`` labelled rows are used: if there are more, a share of the ids, chosen by
    their hash. A term's weight is the log of how much likelier a toxic document holds it; a word beginning
    replaces its longer forms unless they weigh clearly more. An exception phrase is a term with a neighbour
    word that clean documents hold more often than toxic ones. Rows with a null id, label or text teach
    nothing; without toxic or without clean rows the lexicon is empty.
    """
    known = labels.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")
    ).where("id IS NOT NULL AND label IN (0, 1)")
    share = min(1.0, train_rows / max(1, known.count()))
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    rows = saved(id_and_text(docs, id_col, text_col).where("text IS NOT NULL").join(known, "id").select("text", "label"))
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        return Lexicon({})

    def log_odds(t, c):
        return F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))

    counted = rows.mapInArrow(_term_counts, "term string, clean long, toxic long")
    best = (
        counted.groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= MIN_TOXIC)
        .withColumn("weight", log_odds(F.col("toxic"), F.col("clean")))
        .where(F.col("weight") >= MIN_WEIGHT)
        .orderBy((F.col("weight") * F.col("toxic")).desc(), "term")
        .limit(max_terms)
        .collect()
    )
    found = {r.term: r.weight for r in best}
    weights = {}
    for term, weight in sorted(found.items(), key=lambda x: (len(x[0]), x[0])):
        shorter = [weights[term[:n]] for n in range(min(PREFIXES), len(term)) if term[:n] in weights]
        if not shorter or weight > max(shorter) + 1:
            weights[term] = weight
    phrases = (
        rows.mapInArrow(_phrase_counts(weights), "phrase string, clean long, toxic long")
        .groupBy("phrase")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where((F.col("clean") >= 3) & (log_odds(F.col("toxic"), F.col("clean")) < 0))
        .orderBy(F.col("clean").desc(), "phrase")
        .limit(EXCEPTIONS)
        .collect()
    )
    lexicon = Lexicon(weights, [r.phrase for r in phrases])
    fitted = map_texts(rows, "text", _sums(lexicon), "label int, total double, density double").toPandas()
    inputs = np.column_stack([np.ones(len(fitted)), fitted["total"], fitted["density"]])
    lexicon.bias, lexicon.total, lexicon.density = map(float, _logistic(inputs, fitted["label"].to_numpy(float)))
    return lexicon


def score_toxicity(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``score`` from 0 to 1 and ``n_terms``, the number of lexicon terms found.

    Only the text is an input. Folding makes look-alike letters and digits in a letter's place alike. Null and
    empty texts get the score of a text without terms, an empty lexicon scores everything 0, repeated rows get
    a row each, a null id stays null, an empty table gives an empty result, and other columns are not read.
    """
    kind = id_type(docs, id_col)

    def work(batch: pa.RecordBatch) -> dict:
        machine = lexicon.automaton()
        scores, counts = [], []
        for text in batch.column("text").to_pylist():
            text = folded(text)
            found = hits(machine, text)
            counts.append(len(found))
            weight = sum(found.values())
            total, density = (math.log1p(weight), weight / math.sqrt(len(text.split()))) if found else (0.0, 0.0)
            z = lexicon.bias + lexicon.total * total + lexicon.density * density
            scores.append(1 / (1 + math.exp(-max(-40.0, min(40.0, z)))) if lexicon.weights else 0.0)
        return {"id": batch.column("id"), "score": pa.array(scores, pa.float64()), "n_terms": pa.array(counts, pa.int64())}

    return map_texts(
        id_and_text(docs, id_col, text_col), "text", work, f"id {kind}, score double, n_terms long"
    ).withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id"):
    """Rows whose labels must not be learnt from: the checksum of the id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))

