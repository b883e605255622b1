"""Word hashes and word shingles of whole Arrow slices in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        back = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, base in (("up", _BASE), ("down", back)):
            steps = np.full(n, base)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, word starts, word ends, index of each text's first word and the number of words). NULL texts have none."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    edges = offsets - offsets[0]
    if texts.null_count:  # a NULL can hide bytes
        sizes = np.diff(edges)
        gone = texts.is_null().to_numpy(zero_copy_only=False)
        if sizes[gone].any():
            data = data[np.repeat(~gone, sizes)]
            sizes = np.where(gone, 0, sizes)
            edges = np.concatenate([[0], np.cumsum(sizes)])
    if not len(data):
        return data, np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(n + 1, np.int64)
    space = _SPACE[data]
    before, after = np.append(True, space[:-1]), np.append(space[1:], True)
    inside = edges[(edges > 0) & (edges < len(data))]
    before[inside], after[inside - 1] = True, True
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    return data, starts, ends, np.searchsorted(starts, edges)


def word_hashes(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words one after the other, where each text starts: one more than texts).

    Words are runs of bytes other than 0x20 and 0x09-0x0D; ``lower`` puts A-Z in lower case.
    """
    data, starts, ends, first = word_spans(texts)
    if not len(starts):
        return np.empty(0, np.uint64), first
    up, down = _powers(len(data) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum((_LOWER[data] if lower else data).astype(np.uint64) * up[:-1] + up[:-1])])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)), first


def rolled(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words, across text ends too: len(words) - size + 1 values."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
    return mix(out)


def shingle_sets(texts: pa.Array, size: int, lower: bool = True) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of ``size`` words of each text; a shorter text is one shingle, an empty one none."""
    words, first = word_hashes(texts, lower)
    every = rolled(words, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        out.append(np.unique(every[a : b - size + 1]) if b - a >= size else rolled(words[a:b], b - a) if b > a else words[:0])
    return out
