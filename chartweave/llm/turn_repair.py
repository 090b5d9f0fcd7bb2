"""The cheapest edits that make a list of turns a legal conversation, by whole-number shortest paths.

States say what the repaired conversation ends with: nothing, a system turn, a user turn or an assistant turn. Each
turn is kept, given another role or deleted, and empty turns may be inserted before it. A path's weight is one
whole number: the digits above ``WIDTH`` places are its cost, the places below hold one digit per edit from the
left, with zeros after the last edit. The least number is thus the least cost and among its paths the least audit
text, and the minimum of plain integers decides everything.

Turns are taken in pieces of at most ``PIECE``, so numbers stay short however long a conversation is. A piece gives
the least path between any two states. Pieces are joined from left to right by cost, the rank of the audit before the
piece and the piece's audit. That is the same order, since an audit says its end state, and no audit over the same
turns is the beginning of another one: each ends with the edit of a turn, and inserts cost something.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import pairwise

# what a repaired conversation ends with
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = (EMPTY, SYSTEM, USER, ASSISTANT)
#: state after a turn of this initial, by the state before
AFTER = {
    "s": {EMPTY: SYSTEM},
    "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
# Costs of the edits, and the letters of the audit, whose digits keep their order.
KEEP, REROLE, DELETE, INSERT, KEPT_TRUNCATED = 0, 1, 2, 5, 5
LETTERS = "DIKR"
DIGIT = {letter: n for n, letter in enumerate(LETTERS, 1)}
BITS = 3

PIECE = 64
#: inserts that can ever be of use before one turn or at the end
INSERTS = 2
#: places of a piece: its turns and the inserts before each
WIDTH = PIECE * (1 + INSERTS)

Turn = tuple[str, str]  # the first letter of the role, and the fault: "", "blank", "duplicate" or "truncated"


def _edit(weight: int, places: int, letter: str, cost: int) -> int:
    return weight + (cost << (BITS * WIDTH)) + (DIGIT[letter] << (BITS * (WIDTH - 1 - places)))


def _with_inserts(paths: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """The least path to each state when turns may be inserted behind the given ones."""
    paths = dict(paths)
    for _ in range(INSERTS):
        for state, (weight, places) in list(paths.items()):
            for letter in "ua":
                if state in AFTER[letter]:
                    _offer(paths, AFTER[letter][state], _edit(weight, places, "I", INSERT), places + 1)
    return paths


def _offer(paths: dict[int, tuple[int, int]], state: int, weight: int, places: int) -> None:
    if state not in paths or weight < paths[state][0]:
        paths[state] = weight, places


def piece_paths(turns: list[Turn], start: int) -> dict[int, tuple[int, str]]:
    """``{end state: (cost, audit)}`` of the least paths over the turns from a state."""
    paths = {start: (0, 0)}
    for initial, fault in turns:
        reached: dict[int, tuple[int, int]] = {}
        left = KEPT_TRUNCATED if fault == "truncated" else 0
        for state, (weight, places) in _with_inserts(paths).items():
            _offer(reached, state, _edit(weight, places, "D", DELETE), places + 1)
            if fault in ("blank", "duplicate"):
                continue
            if state in AFTER.get(initial, ()):
                _offer(reached, AFTER[initial][state], _edit(weight, places, "K", KEEP + left), places + 1)
            for letter in "ua":
                if state in AFTER[letter]:
                    _offer(reached, AFTER[letter][state], _edit(weight, places, "R", REROLE + left), places + 1)
        paths = reached
    return {state: (weight >> (BITS * WIDTH), _letters(weight, places)) for state, (weight, places) in paths.items()}


def _letters(weight: int, places: int) -> str:
    return "".join(LETTERS[(weight >> (BITS * (WIDTH - 1 - p)) & 7) - 1] for p in range(places))


def all_paths(turns: list[Turn], starts: Iterable[int] = STATES) -> dict[tuple[int, int], tuple[int, str]]:
    """``{(start, end): (cost, audit)}`` of a piece."""
    return {(start, end): path for start in starts for end, path in piece_paths(turns, start).items()}


class Joined:
    """The least paths over the pieces added so far; what is kept of a piece does not grow with its turns."""

    def __init__(self) -> None:
        self.heads = {EMPTY: (0, 0)}  # per state: cost and rank of the audit
        self._back: list[dict[int, int]] = []

    def add(self, paths: dict[tuple[int, int], tuple[int, str]]) -> None:
        found: dict[int, tuple[int, int, str, int]] = {}
        for (start, end), (cost, audit) in paths.items():
            if start in self.heads:
                before, rank = self.heads[start]
                offer = before + cost, rank, audit, start
                if end not in found or offer < found[end]:
                    found[end] = offer
        ranks = {audit: place for place, audit in enumerate(sorted({offer[1:3] for offer in found.values()}))}
        self.heads = {end: (offer[0], ranks[offer[1:3]]) for end, offer in found.items()}
        self._back.append({end: offer[3] for end, offer in found.items()})

    def finish(self) -> tuple[int, int, list[tuple[int, int]]]:
        """Cost, inserts after the last turn, and ``(start, end)`` of every piece."""
        ends = []
        for state, (cost, rank) in self.heads.items():
            more = {EMPTY: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}[state]
            ends.append((cost + more * INSERT, rank, state, more))
        cost, _, state, more = min(ends)
        ways = []
        for back in reversed(self._back):
            ways.append((back[state], state))
            state = back[state]
        return cost, more, ways[::-1]


def repaired(turns: Iterable[tuple[str, str]], edits: str, state: int) -> tuple[list[str], int]:
    """Lines ``role:text`` after the edits, and the state they end in."""
    rows, lines = iter(turns), []
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        initial = role[:1] if edit == "K" else "u" if state in AFTER["u"] else "a"
        lines.append(f"{role if edit == 'K' else ROLES[initial]}:{text}")
        state = AFTER[initial][state]
    return lines, state


def n_illegal(initials: Iterable[str]) -> int:
    return sum(a + b not in LEGAL for a, b in pairwise(initials))
