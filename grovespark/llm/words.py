"""Vectorised tokens of whole texts: spans, 64-bit word hashes and shingle sets, over Arrow string buffers.

Words are runs of characters other than space and U+0009-U+000D; A-Z are lower-cased. UTF-8 never uses those bytes
inside another character, so everything works on bytes. Work is cut into pieces of bounded size between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | U(1)
_VALUE = _VALUE[_LOWER]
_VALUE[_IS_SPACE] = 0
_BASE = U(0x9E3779B97F4A7C15)
_BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[str, np.ndarray] = {}
PIECE = 1 << 18


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        base = np.full(max(n, PIECE + 1), _BASE if kind == "up" else _BASE_INVERSE, U)
        base[0] = 1
        _powers[kind] = have = np.multiply.accumulate(base)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its row offsets (a null row is empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    offsets = np.frombuffer(offsets, kind, len(col) + 1, col.offset * np.dtype(kind).itemsize).astype(np.int64) if len(col) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def pieces(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``limit`` bytes together; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def spans(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; ``breaks`` are offsets where a text begins."""
    solid = ~_IS_SPACE[data]
    before = np.empty(len(data) + 1, bool)
    before[0] = before[-1] = True
    np.logical_not(solid[:-1], out=before[1:-1]) if len(data) > 1 else None
    before[breaks[breaks < len(data)]] = True
    starts = np.flatnonzero(solid & before[:-1])
    after = np.empty(len(data), bool)
    if len(data):
        after[:-1] = ~solid[1:]
        after[-1] = True
        cut = breaks[(breaks > 0) & (breaks <= len(data))] - 1
        after[cut] = True
    return starts, np.flatnonzero(solid & after) + 1


def _hash_piece(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, U)
    up, down = _power("up", len(data)), _power("down", len(data))
    return mix(np.add.reduceat(_VALUE[data] * up[: len(data)], starts) * down[starts])


def hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of rows ``offsets`` (relative to ``data``), and the word offsets of the rows."""
    if len(data) <= 4 * PIECE or len(offsets) > 2:
        starts, _ = spans(data, offsets[:-1])
        return _hash_piece(data, starts), np.searchsorted(starts, offsets)
    out, at = [], 0  # one long text: cut between words
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and not _IS_SPACE[data[end]]:
            gap = np.flatnonzero(_IS_SPACE[data[end : end + PIECE]])
            end = end + int(gap[0]) if len(gap) else min(len(data), end + PIECE)
        part = data[at:end]
        out.append(_hash_piece(part, spans(part, np.zeros(1, np.int64))[0]))
        at = end
    words = np.concatenate(out) if out else np.zeros(0, U)
    return words, np.array([0, len(words)])


def shingle_rows(col: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, number of words, sorted distinct hashes of its k-word shingles) for each row; fewer than k words: one for all."""
    data, offsets = buffers(col)
    for i, j in pieces(offsets):
        own = offsets[i : j + 1]
        words, at = hashes(data[own[0] : own[-1]], own - own[0])
        h = np.zeros(max(0, len(words) - k + 1), U)
        for t in range(k):
            h = h * _BASE + words[t : len(words) - k + 1 + t] if len(h) else h
        h = mix(h + U(k))
        for r in range(i, j):
            a, b = int(at[r - i]), int(at[r - i + 1])
            if b - a >= k:
                yield r, b - a, np.unique(h[a : b - k + 1])
            elif b > a:
                x = U(0)
                with np.errstate(over="ignore"):
                    for w in words[a:b]:
                        x = x * _BASE + w
                    yield r, b - a, mix(np.array([x + U(b - a)], U))
            else:
                yield r, 0, np.zeros(0, U)
