"""Secret scans: fixed patterns, and random-looking strings that a tokenizer finds hard to shorten."""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, id_type, map_texts

# The base patterns, their names in the order of listing, and the shortest match of each.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
KINDS = ("assign", "access", "hex", "random")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_CHARS = 8

RANDOM_CHARS = 20
CHARS_PER_TOKEN = 2.0
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % RANDOM_CHARS)
DIGEST_CHARS = (32, 40, 48, 56, 64, 96, 128)
HEX_ONLY = re.compile(r"(?:0x)?(?:[0-9a-f]+|[0-9A-F]+)", re.ASCII)
IDENTIFIER = re.compile(
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"  # universally unique ids
    r"|[0-9/_=+-]+"  # numbers, dates, rules
    r"|[A-Za-z]{1,12}[-_][0-9]+"  # numbered names
    r"|[A-Z]{1,12}(?:[-_][A-Z0-9]{1,4}){3,}",  # numbers of orders and parts, in short groups
    re.ASCII,
)
# Digests as base64: the name of the function before them or in front of them, and the lengths such digests have.
DIGEST_NAME = re.compile(r"(?i)(?:md5|sha-?(?:1|224|256|384|512))[\"']?\s?[-_:=]?\s?[\"']?")
DIGEST_BEFORE = re.compile(DIGEST_NAME.pattern + r"\Z")
DIGEST_BASE64 = re.compile(
    r"[A-Za-z0-9+/_-]{22}(?:==)?|[A-Za-z0-9+/_-]{27}=?|[A-Za-z0-9+/_-]{38}(?:==)?"
    r"|[A-Za-z0-9+/_-]{43}=?|[A-Za-z0-9+/_-]{64}|[A-Za-z0-9+/_-]{86}(?:==)?"
)
NAME_CHARS = 16


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("secrets", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; offsets are code points.

    A run of 32 or more hex digits is the same as a maximal run that is long enough, and likewise for access
    keys, so short runs are never listed.
    """
    spans = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return spans


def _outside(candidates, taken: list[tuple[int, int]]):
    """The parts of candidates left, between and right of the sorted places that are taken, if they are long enough."""
    k = 0
    for m in candidates:
        at = m.start()
        while k < len(taken) and taken[k][1] <= at:
            k += 1
        j = k
        while j < len(taken) and taken[j][0] < m.end():
            if taken[j][0] - at >= RANDOM_CHARS:
                yield at, taken[j][0]
            at = max(at, taken[j][1])
            j += 1
        if m.end() - at >= RANDOM_CHARS:
            yield at, m.end()


def _is_digest(word: str, before: str) -> bool:
    """Hex digits of a digest's length, or base64 of one that is named as such."""
    if HEX_ONLY.fullmatch(word):
        return len(word.removeprefix("0x")) in DIGEST_CHARS
    name = DIGEST_NAME.match(word)
    if name:
        return DIGEST_BASE64.fullmatch(word[name.end() :]) is not None
    return DIGEST_BEFORE.search(before) is not None and DIGEST_BASE64.fullmatch(word) is not None


def scan(text: str, encoding, ratio: float) -> list[tuple[int, int, int]]:
    spans = base_spans(text)
    if max(map(len, text.split()), default=0) >= RANDOM_CHARS:
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        found = []
        for start, end in _outside(CANDIDATE.finditer(text), sorted((a, b) for a, _, b in spans)):
            word = text[start:end]
            if IDENTIFIER.fullmatch(word) or _is_digest(word, text[max(0, start - NAME_CHARS) : start]):
                continue
            if len(word) < ratio * len(encoding.encode_ordinary(word)):
                found.append((start, 3, end))
        spans += found
    return sorted(spans)


def _listed(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(
    docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", ratio: float = CHARS_PER_TOKEN
) -> DataFrame:
    """One row per input row: ``n_assign``, ``n_access``, ``n_hex``, ``n_random``, ``base_spans``, ``spans`` and
    ``redacted``, the text with every span replaced by ``[kind]`` (overlapping spans by the first one's kind).

    ``ranks`` is a tiktoken rank file. A run of 20 or more key characters, or what fixed patterns leave of it, is
    ``random`` if it has fewer than ``ratio`` characters per token, unless it has the form of a digest (hex digits of
    a digest's length, or base64 of that length that names its hash function, as ``sha256-...`` does) or of an
    identifier (universally unique id, number or date, numbered name). Base64 without such a name is also what keys
    look like, so it counts as random. Spans are listed by start, then kind. Null and empty texts have none, repeated rows get a row
    each, a null id stays null, an empty table gives an empty result, other columns are not read.
    """
    kind = id_type(docs, id_col)

    def work(batch: pa.RecordBatch) -> dict:
        encoding = _encoding(ranks)
        out: dict[str, list] = {n: [] for n in ("n_assign", "n_access", "n_hex", "n_random", "base_spans", "spans", "redacted")}
        for text in batch.column("text").to_pylist():
            spans = scan(text, encoding, ratio) if text else []
            for place, name in enumerate(("n_assign", "n_access", "n_hex", "n_random")):
                out[name].append(sum(k == place for _, k, _ in spans))
            out["base_spans"].append(_listed(s for s in spans if s[1] < 3))
            out["spans"].append(_listed(spans))
            out["redacted"].append(_redacted(text, spans) if spans else text)
        longs = {n: pa.array(out[n], pa.int64()) for n in out if n.startswith("n_")}
        texts = {n: pa.array(out[n], pa.string()) for n in out if not n.startswith("n_")}
        return {"id": batch.column("id"), **longs, **texts}

    return map_texts(
        id_and_text(docs, id_col, text_col),
        "text",
        work,
        f"id {kind}, n_assign long, n_access long, n_hex long, n_random long, base_spans string, spans string, "
        "redacted string",
    ).withColumnRenamed("id", id_col)


def _redacted(text: str, spans) -> str:
    parts, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
