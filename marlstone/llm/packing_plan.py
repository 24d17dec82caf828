"""The packing plan of a length histogram: linear grouping, configurations, substitution, best fit.

The plan never sees a document, only how many pieces have each length, so its work and its size
depend on the sequence length and not on the corpus.

1. Pieces longer than ``small`` tokens, in decreasing order, are put into ``groups`` groups of
   equal cardinality; every piece of a group counts as long as the longest.
2. For these few sizes the linear programme over configurations (multisets of sizes that fit into
   one sequence) is solved by column generation: a knapsack over the dual prices finds the next
   configuration until none can lower the total by more than ``GAP`` of it. Each configuration
   is used the whole part of its share.
3. Actual pieces take the slots of their group in order of length, so a run of sequences with the
   same configuration falls into runs whose sequences are filled alike.
4. What is left (at most some pieces for each configuration) and the small pieces go, longest first,
   where they leave the least room; a new sequence is begun where none has room.

Everything is kept by runs: equal sequences, whose slots hold consecutive ranks of one length.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

GAP = 5e-4
#: The programme also ends when so many steps have lowered its total by less than a quarter of ``GAP``.
STALLED = 200


@dataclass
class Run:
    """``count`` sequences filled alike; ``slots`` are (length, first rank, pieces a sequence)."""

    count: int
    room: int
    slots: list[tuple[int, int, int]] = field(default_factory=list)

    def split(self, at: int) -> Run:
        """Cut the sequences after the first ``at`` off."""
        rest = Run(self.count - at, self.room, [(length, first + at * each, each) for length, first, each in self.slots])
        self.count = at
        return rest

    def put(self, length: int, first: int, each: int) -> None:
        self.slots.append((length, first, each))
        self.room -= length * each


def groups_of(counts: np.ndarray, small: int, groups: int) -> list[list[tuple[int, int]]]:
    """Groups of equal cardinality, longest first; each holds (length, pieces). Groups of one size are one."""
    total = int(counts[small + 1 :].sum())
    edges = [total * (k + 1) // groups for k in range(groups)]
    out: list[list[tuple[int, int]]] = [[]]
    seen = k = 0
    for length in range(len(counts) - 1, small, -1):
        left = int(counts[length])
        while left:
            while edges[k] <= seen:
                k += 1
                if out[-1]:
                    out.append([])
            take = min(left, edges[k] - seen)
            out[-1].append((length, take))
            seen, left = seen + take, left - take
    merged: list[list[tuple[int, int]]] = []
    for g in out:
        if g and merged and merged[-1][0][0] == g[0][0]:
            merged[-1] += g
        elif g:
            merged.append(list(g))
    return merged


def _best_configuration(sizes: np.ndarray, prices: np.ndarray, room: int) -> np.ndarray:
    """The multiset of sizes that fits into ``room`` and has the greatest price.

    A knapsack by number of pieces: layer k has, for every room, the best price of at most k
    pieces. Only few of the large pieces fit into a sequence, so there are few layers.
    """
    layers = int(room // sizes.min())
    rooms = np.arange(room + 1)
    best, took = [np.zeros(room + 1)], []
    for k in range(1, layers + 1):
        asked = rooms if k < layers - 1 else np.unique(room - sizes) if k == layers - 1 else rooms[room:]
        after = asked[:, None] - sizes[None, :]
        value = np.where(after >= 0, best[-1][np.maximum(after, 0)] + prices, -1.0)
        choice = value.argmax(axis=1)
        most = value[np.arange(len(asked)), choice]
        layer, choices = np.zeros(room + 1), np.full(room + 1, -1)
        layer[asked] = np.maximum(most, 0)
        choices[asked] = np.where(most > 0, choice, -1)
        best.append(layer)
        took.append(choices)
    out = np.zeros(len(sizes))
    c = room
    for choices in reversed(took):
        if choices[c] >= 0:
            out[choices[c]] += 1
            c -= int(sizes[choices[c]])
    return out


def configurations(sizes: np.ndarray, demand: np.ndarray, room: int, most_steps: int = 20_000) -> list[tuple[np.ndarray, float]]:
    """(pieces of each size, share) of a basis of the linear programme that is within ``GAP`` of its optimum."""
    if not len(sizes):
        return []
    columns = np.diag((room // sizes).astype(float))
    inverse = np.diag(1 / np.diag(columns))  # sums in place of BLAS here: its threads were seen to hang in the driver's process
    # Groups of equal cardinality make a degenerate programme; unequal demands keep it from going round in circles.
    demand = demand * (1 + 1e-4 * np.random.default_rng(0).random(len(sizes)))
    share = (inverse * demand).sum(axis=1)
    before = share.sum()
    for step in range(most_steps):
        if step % STALLED == STALLED - 1:
            if before - share.sum() < GAP / 4 * before:
                break
            before = share.sum()
        prices = np.maximum(inverse.sum(axis=0), 0)
        entering = _best_configuration(sizes, prices, room)
        worth = float(prices @ entering)
        if worth <= 1 + GAP:  # total / worth is a lower bound
            break
        way = (inverse * entering).sum(axis=1)
        ratio = np.where(way > 1e-9, share / np.where(way > 1e-9, way, 1), np.inf)
        leaving = int(ratio.argmin())
        theta = ratio[leaving]
        share = share - theta * way
        share[leaving] = theta
        columns[:, leaving] = entering
        row = inverse[leaving] / way[leaving]
        inverse = inverse - np.outer(way, row)
        inverse[leaving] = row
        if step % 100 == 99:  # a step of Newton's takes the rounding errors out
            inverse = 2 * inverse - np.einsum("ij,jk->ik", inverse, np.einsum("ij,jk->ik", columns, inverse))
            share = np.maximum((inverse * demand).sum(axis=1), 0)
    return [(columns[:, k], float(share[k])) for k in range(len(sizes)) if share[k] > 1e-9]


def _substituted(groups: list[list[tuple[int, int]]], shares: list[tuple[np.ndarray, float]], room: int, first: np.ndarray) -> list[Run]:
    """Runs in which actual lengths take the configurations' slots; ``first`` (ranks used, by length) moves on."""
    left = [list(g) for g in groups]
    runs = []
    for pieces, share in shares:
        n = int(share + 1e-6)
        slots = [g for g in range(len(groups)) for _ in range(int(pieces[g]))]
        have = [sum(c for _, c in g) for g in left]
        n = min([n, *(have[g] // slots.count(g) for g in set(slots))])
        if not n or not slots:
            continue
        done = [Run(n, room)]
        for g in slots:
            after: list[Run] = []
            for run in done:
                while run is not None:
                    length, have_now = left[g][-1]
                    rest = run.split(have_now) if have_now < run.count else None
                    run.put(length, int(first[length]), 1)
                    first[length] += run.count
                    if have_now == run.count:
                        left[g].pop()
                    else:
                        left[g][-1] = (length, have_now - run.count)
                    after.append(run)
                    run = rest
            done = after
        runs += done
    for g, rest in zip(groups, left):
        g[:] = rest
    return runs


def best_fit(runs: list[Run], counts: np.ndarray, room: int, first: np.ndarray) -> list[Run]:
    """All ``counts`` pieces, longest first, where they leave the least room."""
    by_room: list[list[Run]] = [[] for _ in range(room + 1)]
    for run in runs:
        by_room[run.room].append(run)
    for length in range(len(counts) - 1, 0, -1):
        left = int(counts[length])
        at = length
        while left and at <= room:
            if not by_room[at]:
                at += 1
                continue
            run = by_room[at].pop()
            each = at // length
            if left < run.count * each:
                full = left // each
                if full:
                    by_room[at].append(run.split(full))
                else:
                    if run.count > 1:
                        by_room[at].append(run.split(1))
                    each = left
            run.put(length, int(first[length]), each)
            first[length] += run.count * each
            left -= run.count * each
            by_room[run.room].append(run)
        each = room // length
        for n, k in ((left // each, each), (1 if left % each else 0, left % each)):
            if n:
                run = Run(n, room)
                run.put(length, int(first[length]), k)
                first[length] += n * k
                by_room[run.room].append(run)
    return [run for own in by_room for run in own]


def plan(counts: np.ndarray, groups: int, small: int) -> list[Run]:
    """Runs that hold all pieces; ``counts[l]`` pieces have l tokens, the last entry is the room."""
    counts = np.asarray(counts, np.int64).copy()
    room = len(counts) - 1
    first = np.zeros(room + 1, np.int64)
    runs = []
    if counts[room]:
        full = Run(int(counts[room]), room)
        full.put(room, 0, 1)
        runs.append(full)
        counts[room] = 0
    grouped = groups_of(counts, small, groups)
    sizes = np.array([g[0][0] for g in grouped], np.int64)
    demand = np.array([sum(c for _, c in g) for g in grouped], float)
    runs += _substituted(grouped, configurations(sizes, demand, room), room, first)
    rest = counts.copy()
    rest[small + 1 :] = 0
    for g in grouped:
        for length, n in g:
            rest[length] += n
    return best_fit(runs, rest, room, first)


def slots(runs: list[Run]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, pieces a sequence, offset) of every slot."""
    out = []
    sequence = 0
    for run in runs:
        offset = 0
        for length, first, each in run.slots:
            out.append((length, first, first + run.count * each, sequence, each, offset))
            offset += length * each
        sequence += run.count
    return out
