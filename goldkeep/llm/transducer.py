"""A vocabulary as minimal acyclic transducers, which map a term to its place in the order.

Sorted terms are added one by one; states that no later term can change are merged with equal
ones at once, so the automaton is minimal at every moment. Every transition carries the
number of terms that come before those behind it; the sum along the path of a term is
its ordinal. A run of sorted terms makes one shard; a term can only stand in the shard with the
last first term that is not greater.

:class:`Transducers` holds shards of several vocabularies in one table of transitions and sends
many words through it at once, one byte of all of them each step.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable

import numpy as np

from goldkeep.llm.blobs import pack_arrays, unpack_arrays


def build(terms: Iterable[bytes]) -> dict[str, np.ndarray]:
    """The transducer of sorted, distinct ``terms``: ``keys`` (state and byte of every
    transition, ascending), ``targets``, ``before`` and ``final``. State 0 is the first one."""
    # a state: [final, {byte: state}, terms behind it], or a number once it is settled
    register: dict[tuple, int] = {}
    states: list[tuple] = []

    def settle(state: list) -> int:
        key = (state[0], tuple(state[1].items()))
        number = register.get(key)
        if number is None:
            number = register[key] = len(states)
            size = state[0] + sum(states[t][2] for t in state[1].values())
            states.append((state[0], key[1], size))
        return number

    path: list[list] = [[False, {}]]
    last = b""
    for term in terms:
        if term <= last and (last or path[0][0]):
            raise ValueError("terms must be sorted and distinct")
        common = 0
        while common < len(last) and common < len(term) and last[common] == term[common]:
            common += 1
        for depth in range(len(last), common, -1):
            path[depth - 1][1][last[depth - 1]] = settle(path.pop())
        for byte in term[common:]:
            path.append([False, {}])
        path[-1][0] = True
        last = term
    for depth in range(len(last), 0, -1):
        path[depth - 1][1][last[depth - 1]] = settle(path.pop())
    settle(path[0])
    first = len(states) - 1  # settled last; it becomes state 0
    keys, targets, before = [], [], []
    for number in range(first, -1, -1):
        final, moves, _ = states[number]
        passed = int(final)
        for byte, target in moves:
            keys.append((first - number) << 8 | byte)
            targets.append(first - target)
            before.append(passed)
            passed += states[target][2]
    finals = [s[0] for s in reversed(states)]
    return {
        "keys": np.array(keys, np.int64),
        "targets": np.array(targets, np.int32),
        "before": np.array(before, np.int32),
        "final": np.array(finals, np.uint8),
    }


def packed(terms: Iterable[bytes]) -> bytes:
    """:func:`build` as one compressed value."""
    return pack_arrays(**build(terms))


class Transducers:
    """Shards ``(vocabulary, first term, first ordinal, packed)`` of any vocabularies."""

    def __init__(self, shards: Iterable[tuple[str, bytes, int, bytes]]):
        self.firsts: dict[str, list[bytes]] = {}
        self.numbers: dict[str, list[int]] = {}
        parts, roots, ordinals, states = [], [], [], 0
        for vocabulary, first, ordinal, blob in sorted(shards, key=lambda s: s[:3]):
            part = unpack_arrays(blob)
            self.firsts.setdefault(vocabulary, []).append(first)
            self.numbers.setdefault(vocabulary, []).append(len(roots))
            roots.append(states)
            ordinals.append(ordinal)
            part["keys"] = part["keys"] + (states << 8)
            part["targets"] = part["targets"].astype(np.int64) + states
            states += len(part["final"])
            parts.append(part)

        def joined(name: str, kind) -> np.ndarray:
            return np.concatenate([p[name] for p in parts] or [np.zeros(0)]).astype(kind)

        self.roots, self.ordinals = np.array(roots, np.int64), np.array(ordinals, np.int64)
        self.keys, self.targets = joined("keys", np.int64), joined("targets", np.int64)
        self.before, self.final = joined("before", np.int64), joined("final", bool)

    def shard_of(self, vocabulary: str, words: list[bytes]) -> np.ndarray:
        """The only shard that can hold each word, or -1."""
        firsts = self.firsts.get(vocabulary)
        if not firsts:
            return np.full(len(words), -1, np.int64)
        numbers = np.array([-1, *self.numbers[vocabulary]], np.int64)
        if len(firsts) == 1:
            return np.full(len(words), numbers[1], np.int64)
        return numbers[np.fromiter((bisect_right(firsts, w) for w in words), np.int64, len(words))]

    def ordinals_of(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, shards: np.ndarray
    ) -> np.ndarray:
        """Ordinals of the words ``data[starts[i]:ends[i]]`` in their shards, -1 for others."""
        out = np.full(len(starts), -1, np.int64)
        at = np.flatnonzero(shards >= 0)
        if not len(self.keys):
            return out
        state, place, left = self.roots[shards[at]], starts[at], (ends - starts)[at]
        ordinal = self.ordinals[shards[at]]
        while len(at):
            done = left == 0
            if done.any():
                hit = done & self.final[state]
                out[at[hit]] = ordinal[hit]
                go = ~done
                at, state, place, left, ordinal = at[go], state[go], place[go], left[go], ordinal[go]
            key = state << 8 | data[place]
            move = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[move] == key
            at, move = at[known], move[known]
            state, ordinal = self.targets[move], ordinal[known] + self.before[move]
            place, left = place[known] + 1, left[known] - 1
        return out
