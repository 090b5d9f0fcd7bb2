"""Repairs against a search over all edits, in one range and over many, and the query against its contract."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from itertools import pairwise

import pytest

from chartweave.llm import conversations
from chartweave.llm.conversation_query import op13_turn_repair
from chartweave.llm.conversations import repair_conversations
from chartweave.llm.turn_repair import Joined, all_paths

DATA = "/root/testdata/sf0.001"
DDL = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, conv STRING, place INT, fault STRING"
NEXT = {"u": "0sa", "a": "u", "s": "0"}  # initials each may follow; 0 is the start


def plain_audit(turns):
    """Least (cost, audit) over all edits, cheapest first."""
    heap, done = [(0, "", 0, "0")], set()
    while True:
        cost, audit, i, last = item = heapq.heappop(heap)
        if item in done:
            continue
        done.add(item)
        if i == len(turns) and last in "0a":
            return cost, audit
        for x in "ua":
            if last in NEXT[x]:
                heapq.heappush(heap, (cost + 5, audit + "I", i, x))
        if i < len(turns):
            initial, fault = turns[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last))
            if fault not in ("blank", "duplicate"):
                left = 5 * (fault == "truncated")
                if last in NEXT.get(initial, ""):
                    heapq.heappush(heap, (cost + left, audit + "K", i + 1, initial))
                for x in "ua":
                    if last in NEXT[x]:
                        heapq.heappush(heap, (cost + 1 + left, audit + "R", i + 1, x))


def table_audit(turns):
    """The same by a table of texts, for lists too long to search."""
    best = {"0": (0, "")}

    def offer(to, last, cost, audit):
        to[last] = min(to.get(last, (cost, audit)), (cost, audit))

    def with_inserts(best):
        for _ in range(3):
            for last, (cost, audit) in list(best.items()):
                for x in "ua":
                    if last in NEXT[x]:
                        offer(best, x, cost + 5, audit + "I")
        return best

    for initial, fault in turns:
        after: dict = {}
        for last, (cost, audit) in with_inserts(best).items():
            offer(after, last, cost + 2, audit + "D")
            if fault not in ("blank", "duplicate"):
                cost += 5 * (fault == "truncated")
                if last in NEXT.get(initial, ""):
                    offer(after, initial, cost, audit + "K")
                for x in "ua":
                    if last in NEXT[x]:
                        offer(after, x, cost + 1, audit + "R")
        best = after
    best = with_inserts(best)
    return min(best[last] for last in "0a" if last in best)


def plain_repair(turns):
    """The report of turns ``(turn, role, text)`` in order."""
    faults, seen = [], set()
    for _, role, text in turns:
        visible = re.sub("[\x20\x09-\x0d]", "", text)
        if not visible:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if visible[-1] in ".!?" else "truncated")
        seen.add((role, text))
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in pairwise(r[:1] for _, r, _ in turns))
    found = [(r[:1], f) for (_, r, _), f in zip(turns, faults)]
    cost, audit = plain_audit(found) if len(found) < 9 else table_audit(found)
    rows, lines = iter(turns), []
    for edit in audit:
        _, role, text = (None, "", "") if edit == "I" else next(rows)
        if edit in "RI":
            role = "assistant" if lines and lines[-1].startswith("u") else "user"
        if edit != "D":
            lines.append(f"{role}:{text}")
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, "\n".join(lines)


def test_pieces_of_any_length_give_the_least_audit():
    rng = random.Random(5)
    for _ in range(600):
        faults = ["", "", "", "", "blank", "duplicate", "truncated"]
        turns = [(rng.choice("ssuuuaaax "), rng.choice(faults)) for _ in range(rng.randrange(9))]
        want = plain_audit(turns)
        assert table_audit(turns) == want
        for size in (1, 2, 3, 64):
            join = Joined()
            found = [all_paths(turns[k : k + size]) for k in range(0, len(turns), size)]
            for paths in found:
                join.add(paths)
            cost, more, ways = join.finish()
            assert (cost, "".join(p[w][1] for p, w in zip(found, ways)) + "I" * more) == want


def odd_rows(seed, n_convs=60):
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "No!", "what", "", " \n", "and  so on?\t", "ends, here", "數據.", None]
    for conv in [None, *range(n_convs)]:
        turns = rng.sample(range(-3, 14), rng.randrange(1, 12)) + ([None] if conv == 1 else [])
        rows += [(conv, t, rng.choice(["system", "user", "user", "assistant", "tool", None]), rng.choice(texts)) for t in turns]
    rows += [rows[3]] * 3 + [(7, None, None, None)] * 2
    return rows


def expected(rows):
    convs: dict = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    order = lambda t: (t[0] is not None, t[0] or 0)
    return {conv: plain_repair(sorted(turns, key=order)) for conv, turns in convs.items()}


def repaired(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DDL).repartition(3)
    found = repair_conversations(frame, **options)
    assert found.columns == "conv_id gaps blank duplicate truncated illegal cost audit repaired".split()
    return {r[0]: tuple(r[1:]) for r in found.collect()}


@pytest.mark.parametrize("ranges", [1, 4, 150])
def test_odd_conversations(spark, ranges):
    # turns that differ but have one number would follow a hash here
    rows = [r for r in odd_rows(ranges) if r[0] != 7 or r[1] is not None]
    assert repaired(spark, rows, ranges=ranges) == expected(rows)


def test_long_conversations_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(conversations, "LONG_TURNS", 20)
    rng = random.Random(2)
    rows = [(1, i, rng.choice(["user", "assistant"]), rng.choice(["a.", f"{i}!", f"{i}?", f"{i}", ""])) for i in range(500)]
    rows += [(2, i, "user", f"{i}.") for i in range(130)] + [(3, 0, "user", "Hi."), (4, 5, "system", "Only this.")]
    want = expected(rows)
    for ranges in (1, 9):
        assert repaired(spark, rows, ranges=ranges) == want


def test_one_conversation_of_equal_rows(spark):
    rows = [(1, 4, "user", "Same.")] * 400 + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yes.")]
    assert repaired(spark, rows, ranges=8) == expected(rows)


def test_empty_table(spark):
    assert repaired(spark, []) == {}


def test_query_equals_its_contract(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    kept: dict = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        damage = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(damage, text)
        role = "user" if damage == 4 else role
        kept[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(damage, 1)
    want = {}
    for conv, turns in kept.items():
        *report, text = plain_repair(sorted(turns, key=lambda t: t[0]))
        want[conv] = (*report, hashlib.sha256(text.encode()).hexdigest())
    found = op13_turn_repair(spark, DATA)
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == want
    assert sum(r[5] > 0 for r in want.values()) > 5
