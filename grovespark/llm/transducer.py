"""A minimal acyclic transducer from words to id sequences: shared suffixes, counts on edges, memory-mapped arrays.

The words are added in byte order and equal suffixes are merged as soon as they can't change any more. The numbers on
a path's edges (how many words come before those that go on through the edge) add up to the word's index, so that
states with equal suffixes stay shared although every word has an output of its own; the index leads to its ids.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Sequence

import numpy as np


def compile_words(words: Sequence[bytes], ids: Sequence[Sequence[int]]) -> bytes:
    """The automaton of distinct ``words`` with their outputs, as bytes that ``Transducer`` maps."""
    order = sorted(range(len(words)), key=lambda i: words[i])
    children: list[dict[int, int]] = [{}]
    final: list[bool] = [False]
    register: dict[tuple, int] = {}
    path: list[int] = [0]  # the states of the last word

    def settle(keep: int, last: bytes) -> None:
        for d in range(len(path) - 1, keep, -1):
            state = path.pop()
            key = (final[state], *children[state].items())
            known = register.setdefault(key, state)
            if known != state:
                children[path[-1]][last[d - 1]] = known
                free.append(state)

    free: list[int] = []
    last = b""
    for i in order:
        w = words[i]
        common = 0
        for x, y in zip(w, last, strict=False):
            if x != y:
                break
            common += 1
        settle(common, last)
        for b in w[common:]:
            if free:
                state = free.pop()
                children[state], final[state] = {}, False
            else:
                state = len(children)
                children.append({})
                final.append(False)
            children[path[-1]][b] = state
            path.append(state)
        final[path[-1]] = True
        last = w
    settle(0, last)

    below: dict[int, int] = {}
    number: dict[int, int] = {0: 0}
    stack = [(0, iter(children[0].values()))]
    while stack:  # words below each state, children first
        state, todo = stack[-1]
        for c in todo:
            if c not in below:
                number.setdefault(c, len(number))
                stack.append((c, iter(children[c].values())))
                break
        else:
            below[state] = final[state] + sum(below[c] for c in children[state].values())
            stack.pop()
    keys, targets, skips = [], [], []
    for state in number:
        skip = int(final[state])
        for b, c in children[state].items():
            keys.append(number[state] * 256 + b)
            targets.append(number[c])
            skips.append(skip)
            skip += below[c]
    edge_order = np.argsort(np.array(keys, np.int64), kind="stable")
    flat = np.array([t for i in order for t in ids[i]], np.int32)
    parts = [
        np.array(keys, np.int64)[edge_order], np.array(targets, np.int32)[edge_order], np.array(skips, np.int32)[edge_order],
        np.array([final[s] for s in number], np.int8), np.cumsum([0, *(len(ids[i]) for i in order)]).astype(np.int32), flat,
    ]
    head = np.array([len(p) for p in parts], np.int64)
    return head.tobytes() + b"".join(p.tobytes() for p in parts)


class Transducer:
    """Looks words up in a compiled automaton, many at once."""

    def __init__(self, compiled: bytes):
        with tempfile.NamedTemporaryFile(prefix="lexicon-", delete=False) as f:
            f.write(compiled)
        mapped = np.memmap(f.name, np.uint8, "r")
        os.unlink(f.name)  # the mapping stays; nothing is left on the disk
        sizes, at, found = np.frombuffer(mapped[:48], np.int64), 48, []
        for n, kind in zip(sizes, (np.int64, np.int32, np.int32, np.int8, np.int32, np.int32), strict=True):
            end = at + int(n) * np.dtype(kind).itemsize
            found.append(np.frombuffer(mapped[at:end], kind))
            at = end
        self.keys, self.targets, self.skips, self.final, self.offsets, self.ids = found

    def find(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The index of each word (bytes and their offsets), or -1 where the automaton has no such word."""
        lengths = np.diff(at)
        out = np.full(len(lengths), -1, np.int64)
        if not len(self.keys):
            return out
        rows, state, index, d = np.flatnonzero(lengths > 0), np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
        while len(rows):
            key = state[rows] * 256 + data[at[rows] + d]
            e = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[e] == key
            rows, e, d = rows[ok], e[ok], d + 1
            state[rows], index[rows] = self.targets[e], index[rows] + self.skips[e]
            end = lengths[rows] == d
            final = rows[end & (self.final[state[rows]] != 0)]
            out[final] = index[final]
            rows = rows[~end]
        return out
