"""Word hashes of UTF-8 texts, computed with numpy over whole texts.

A word is a run of bytes of one kind; its 64-bit hash is a polynomial of its
folded bytes, taken from running sums, so no Python object exists per word.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: bytes read at once; longer texts are cut where no word is
CHUNK = 1 << 20


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def fold_table(lower: bool = True) -> np.ndarray:
    """Bytes with A-Z as a-z."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    return table


class Splitter:
    """Splits texts into words. ``kind`` gives each byte's kind; 0 separates, a word has one kind."""

    def __init__(self, kind: np.ndarray, fold: np.ndarray):
        self.kind, self.fold = kind.astype(np.uint8), fold
        self.up = self.down = np.empty(0, np.uint64)

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, begins and ends (in bytes) of the words of a text."""
        if len(text) <= CHUNK:
            return self._split(text, 0)
        data = np.frombuffer(text, np.uint8)
        parts, begin = [], 0
        while begin < len(text):
            end = min(begin + CHUNK, len(text))
            while end < len(text) and self.kind[data[end - 1]] and self.kind[data[end]] == self.kind[data[end - 1]]:
                ahead = self.kind[data[end:end + CHUNK]] != self.kind[data[end - 1]]
                step = int(ahead.argmax()) if ahead.any() else len(ahead)
                end += step
                if ahead.any():
                    break
            parts.append(self._split(text[begin:end], begin))
            begin = end
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _split(self, text: bytes, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data = np.frombuffer(text, np.uint8)
        kind = self.kind[data]
        change = np.flatnonzero(np.diff(kind)) + 1
        edges = np.concatenate(([0], change, [len(data)])).astype(np.int64)
        begin, end = edges[:-1], edges[1:]
        is_word = (kind[begin] > 0) if len(data) else np.zeros(len(begin), bool)
        begin, end = begin[is_word], end[is_word]
        n = len(data)
        if len(self.up) < n:
            size = max(n, min(CHUNK, 2 * n))
            self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((self.fold[data].astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
            hashes = mix((sums[end] - sums[begin]) * (self.down[begin] if len(begin) else np.empty(0, np.uint64)))
        if len(self.up) > CHUNK:  # a single word longer than a chunk
            self.up = self.down = np.empty(0, np.uint64)
        return hashes, begin + shift, end + shift


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, in order; fewer words make one run, no words none."""
    if not len(hashes):
        return hashes
    n = min(n, len(hashes))
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = mix(out * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[i:len(hashes) - n + 1 + i])
    return out


def distinct(numbers: np.ndarray) -> np.ndarray:
    """The distinct numbers, ascending."""
    numbers = np.sort(numbers)
    return numbers[np.concatenate(([True], numbers[1:] != numbers[:-1]))] if len(numbers) else numbers


def white_space_splitter() -> Splitter:
    """Words are runs of bytes other than space and 0x09-0x0D; A-Z fold to a-z."""
    kind = np.ones(256, np.uint8)
    kind[[9, 10, 11, 12, 13, 32]] = 0
    return Splitter(kind, fold_table())
