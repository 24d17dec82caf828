"""Cheapest edits of role/fault signatures: a prefix trie whose paths share dynamic programmes.

A signature has one letter a row (class of the role and fault). A layer holds the least cost of
every state of the pattern ``(s?(ua)+)?`` after a prefix of the signature. Sorted signatures are
inserted one after the other: the path that a signature shares with the one before keeps its layers,
the others are computed once, and the answer is read off at the terminal node. Only the current
path is held, four numbers a row.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
ACCEPTING = (START, ASSISTANT)
CLASSES = "sua"  # any other role is class 3
FAULTS = ("none", "blank", "duplicate", "truncated")
#: The letter of a row: 4 * class + fault.
LETTERS = "ABCDEFGHIJKLMNOP"
LEGAL = {(0, 1), (1, 2), (2, 1)}
KEEP, REROLE, DELETE, INSERT, UNDELETED_TRUNCATED = 0, 1, 2, 5, 5
_FAR = 1 << 60

#: Where a role (s, u, a) leads from a state; roles that can't come next are left out.
_NEXT = {START: {0: SYSTEM, 1: USER}, SYSTEM: {1: USER}, USER: {2: ASSISTANT}, ASSISTANT: {1: USER}}
#: (state, next state, role) of the one row that may be inserted in each state.
_INSERTS = [(q, to, role) for q in range(STATES) for role, to in _NEXT[q].items() if role]


def _edges(letter: int) -> list[tuple[int, int, int, str, str]]:
    """(state, next state, cost, edit, what is left of the row), cheapest letters first."""
    own, fault = divmod(letter, 4)
    out = [(q, q, DELETE, "D", "") for q in range(STATES)]
    if FAULTS[fault] in ("blank", "duplicate"):
        return out
    more = UNDELETED_TRUNCATED if FAULTS[fault] == "truncated" else 0
    for q in range(STATES):
        if own in _NEXT[q]:
            out.append((q, _NEXT[q][own], KEEP + more, "K", "k"))
        out += [(q, to, REROLE + more, "R", CLASSES[role]) for role, to in _NEXT[q].items() if role and role != own]
    return out


_EDGES = {c: _edges(k) for k, c in enumerate(LETTERS)}


def _with_inserts(layer: list[int]) -> tuple[int, ...]:
    for _ in range(2):
        for q, to, _role in _INSERTS:
            layer[to] = min(layer[to], layer[q] + INSERT)
    return tuple(layer)


@dataclass
class Answer:
    cost: int
    audit: str
    illegal: int
    blank: int
    duplicate: int
    truncated: int
    #: For each row what it becomes: k (kept), u or a (with that role), after U or A for rows inserted before it.
    edits: list[str]


class Trie:
    """The path to the last inserted signature, with one layer a node."""

    def __init__(self) -> None:
        self.path = ""
        self.layers = [_with_inserts([0, _FAR, _FAR, _FAR])]
        self.tallies = [(0, 0, 0, 0)]
        self.computed = 0

    def insert(self, signature: str) -> Answer:
        """The answer of ``signature``; those inserted in sorted order share what they can."""
        shared = len(os.path.commonprefix([self.path, signature]))
        del self.layers[shared + 1 :], self.tallies[shared + 1 :]
        for at in range(shared, len(signature)):
            last = self.layers[-1]
            layer = [_FAR] * STATES
            for q, to, cost, _, _ in _EDGES[signature[at]]:
                layer[to] = min(layer[to], last[q] + cost)
            self.layers.append(_with_inserts(layer))
            own, fault = divmod(LETTERS.index(signature[at]), 4)
            illegal, blank, duplicate, truncated = self.tallies[-1]
            illegal += at > 0 and (LETTERS.index(signature[at - 1]) // 4, own) not in LEGAL
            self.tallies.append((illegal, blank + (fault == 1), duplicate + (fault == 2), truncated + (fault == 3)))
        self.computed += len(signature) - shared
        self.path = signature
        return self._answer()

    def _answer(self) -> Answer:
        """Of the cheapest edits those whose letters are least: a mark of all states on cheapest ways, then the least way."""
        n, layers = len(self.path), self.layers
        total = min(layers[n][q] for q in ACCEPTING)
        good: list[set[int]] = [set() for _ in range(n + 1)]
        good[n] = {q for q in ACCEPTING if layers[n][q] == total}
        for at in range(n, -1, -1):
            if at < n:
                good[at] = {q for q, to, cost, _, _ in _EDGES[self.path[at]] if to in good[at + 1] and layers[at][q] + cost == layers[at + 1][to]}
            for _ in range(STATES):
                good[at] |= {q for q, to, _role in _INSERTS if to in good[at] and layers[at][q] + INSERT == layers[at][to]}
        audit, edits, before, at, q = [], [], "", 0, START
        while at < n or not (q in ACCEPTING and layers[n][q] == total):
            ways = []
            if at < n:
                ways = [(edit, to, left) for own, to, cost, edit, left in _EDGES[self.path[at]] if own == q and to in good[at + 1] and layers[at][q] + cost == layers[at + 1][to]]
            ways += [("I", to, CLASSES[role].upper()) for own, to, role in _INSERTS if own == q and to in good[at] and layers[at][q] + INSERT == layers[at][to]]
            edit, q, left = min(ways)
            audit.append(edit)
            before += left
            if edit != "I":
                edits.append(before)
                before, at = "", at + 1
        if before:
            edits[-1] += before
        return Answer(total, "".join(audit), *self.tallies[n], edits)
