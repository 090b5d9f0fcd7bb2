"""Plain versions of the operators, written straight from what they promise."""

from __future__ import annotations

import hashlib
import re


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    text = text or ""
    both = lambda word: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)
    words = "|".join([both("password"), both("passwd"), both("secret"), both("token"), both("api") + "_?" + both("key")])
    assign = rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


def item_words(text: str | None) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contamination(docs, items, window=13):
    windows: dict[tuple, set] = {}
    for name, text in items:
        words = item_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(name))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words = item_words(text)
        hit, names = [False] * len(words), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if (found := windows.get(tuple(words[i : i + size]))) is not None:
                    names |= found
                    hit[i : i + size] = [True] * size
        n = sum(hit)
        out.append((doc_id, len(words), n, len(names), sha(",".join(sorted(names))), n > 0 and 20 * n >= len(words)))
    return out


def shingles(text: str | None, size: int = 3) -> set[tuple]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def near_components(docs, size=3, num=85, den=100):
    sets = [shingles(t, size) for _, t in docs]
    group = list(range(len(docs)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if docs[i][0] is not None and docs[j][0] is not None and a and b and den * len(a & b) >= num * len(a | b):
                group[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        comp = least.get(find(i))
        out.append((doc_id, len(sets[i]), comp, doc_id is None or doc_id == comp))
    return out


def cut_words(docs, size=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    seen: dict[tuple, int] = {}
    for w in words:
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for (doc_id, _), w in zip(docs, words):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out.append((doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def cut_bytes(docs, size=50):
    """(id, n_bytes, n_removed, n_spans, kept): a string counts if a document with a smaller id has it too."""
    first: dict[bytes, int] = {}
    raws = [(i, (t or "").encode()) for i, t in docs]
    for doc_id, raw in raws:
        if doc_id is not None:
            for k in range(len(raw) - size + 1):
                key = raw[k : k + size]
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, raw in raws:
        gone = bytearray(len(raw))
        if doc_id is not None:
            for k in range(len(raw) - size + 1):
                if first[raw[k : k + size]] < doc_id:
                    gone[k : k + size] = b"\1" * size
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((doc_id, len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return out
