"""Weighted acyclic automata over words, many at a time, as flat arrays.

A machine reads the words of a phrase; each arc has a word, the weight of the phrase read so far, and the
state it leads to. State 0 has no arcs, and the last state is where a machine starts. Machines are built
from sorted phrases, longest first: a state whose arcs equal those of one already registered in its
machine is that state, so equal ends are kept once.

Between machines and their users stand levels: for each length the phrases in order, with their parent
one word shorter (at length 1 the machine), the code of their last word and their weight.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tillsight.llm.text import ragged


@dataclass(frozen=True)
class Level:
    parents: np.ndarray
    labels: np.ndarray
    weights: np.ndarray


@dataclass(frozen=True)
class Machines:
    """Arcs of all machines in a row, then their states, with the number of each machine's own."""

    labels: np.ndarray
    weights: np.ndarray
    targets: np.ndarray
    arcs: np.ndarray  # per machine
    firsts: np.ndarray  # per state, within its machine; one more than states
    states: np.ndarray  # per machine, entries of `firsts`


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the sums of their weights, and each row's place among them."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.empty(len(keys), dtype=bool)
    new[:1] = True
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    totals = np.add.reduceat(weights[order], first) if len(first) else weights[:0]
    return ordered[first], totals, place


def _mixed(*columns: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each row."""
    h = np.full(len(columns[0]), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    return h


def build(levels: list[Level], machines: int) -> Machines:
    """Machines of sorted levels."""
    levels = levels or [Level(*[np.zeros(0, dtype=np.int64)] * 3)]
    made = np.ones(machines, dtype=np.int64)  # states registered so far; state 0 is there
    owner = [np.arange(machines)]
    for level in levels[:-1]:
        owner.append(owner[-1][level.parents])
    target = np.zeros(len(levels[-1].labels), dtype=np.int64)
    kept = []
    for k in range(len(levels) - 1, -1, -1):
        arcs, mine = levels[k], owner[k]
        first = np.searchsorted(arcs.parents, np.arange(len(mine)))
        degree = np.diff(np.append(first, len(arcs.parents)))
        inside = np.arange(len(arcs.parents)) - first[arcs.parents]
        digest = np.zeros(len(inside) + 1, dtype=np.uint64)
        np.cumsum(_mixed(arcs.labels, arcs.weights, target, inside), out=digest[1:])
        digest = digest[first + degree] - digest[first]
        open_ = np.flatnonzero(degree) if k else np.arange(machines)
        order = open_[np.lexsort((digest[open_], degree[open_], mine[open_]))]
        new = np.ones(len(order), dtype=bool)
        if k:
            a, b = order[1:], order[:-1]
            new[1:] = (mine[a] != mine[b]) | (degree[a] != degree[b]) | (digest[a] != digest[b])
            # Equal digests are taken for equal only if the arcs are.
            head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
            x, y = ragged(first[order], degree[order]), ragged(first[head], degree[order])
            differ = (arcs.labels[x] != arcs.labels[y]) | (arcs.weights[x] != arcs.weights[y]) | (target[x] != target[y])
            new |= np.bincount(np.repeat(np.arange(len(order)), degree[order]), differ, len(order)) > 0
        states = order[new]
        of = mine[states]
        number = made[of] + np.arange(len(of)) - np.searchsorted(of, of)
        made += np.bincount(of, minlength=machines)
        above = np.zeros(len(mine), dtype=np.int64)
        above[order] = number[np.cumsum(new) - 1]
        arc = ragged(first[states], degree[states])
        kept.append((of, number, degree[states], arcs.labels[arc], arcs.weights[arc], target[arc]))
        target = above
    of, number, degree = (np.concatenate([s[i] for s in kept]) for i in range(3))
    labels, weights, targets = (np.concatenate([s[i] for s in kept]) for i in range(3, 6))
    order = np.lexsort((number, of))
    arc = ragged((np.cumsum(degree) - degree)[order], degree[order])
    of, degree = of[order], degree[order]
    arcs = np.bincount(of, degree, machines).astype(np.int64)
    # Each machine's firsts: 0 for state 0, then where each state begins, then its number of arcs.
    begins = np.cumsum(degree) - degree - (np.cumsum(arcs) - arcs)[of]
    states = made + 1
    firsts = np.zeros(int(states.sum()), dtype=np.int64)
    start = np.cumsum(states) - states
    firsts[start[of] + 1 + np.arange(len(of)) - np.searchsorted(of, of)] = begins
    firsts[start + states - 1] = arcs
    return Machines(labels[arc], weights[arc], targets[arc], arcs, firsts, states)


def levels_of(machines: Machines) -> list[Level]:
    """All phrases of machines, by length; in order if the arcs' labels are."""
    arc_base = np.cumsum(machines.arcs) - machines.arcs
    state_base = np.cumsum(machines.states) - machines.states
    owner = np.arange(len(machines.arcs))
    state = state_base + machines.states - 2
    levels = []
    while len(state):
        first = machines.firsts[state]
        degree = machines.firsts[state + 1] - first
        arc = ragged(arc_base[owner] + first, degree)
        parents = np.repeat(np.arange(len(state)), degree)
        if len(arc) == 0:
            break
        levels.append(Level(parents, machines.labels[arc], machines.weights[arc]))
        owner = owner[parents]
        state = state_base[owner] + machines.targets[arc]
    return levels


def union(levels: list[Level], machine: np.ndarray, labels: int) -> list[Level]:
    """Phrases of machines that have become one, their weights summed; `machine` tells which they are now."""
    place, merged = machine, []
    for level in levels:
        keys, weights, place = summed(place[level.parents] * labels + level.labels, level.weights)
        merged.append(Level(keys // labels, keys % labels, weights))
    return merged
