"""64-bit hashes of words and word runs, a whole slice of texts at a time.

Words are runs of bytes other than ASCII white space, after lower-casing A-Z.
A run's hash is a polynomial over random byte values modulo 2**64, taken from
prefix sums, so the cost per byte is a few numpy operations and no Python
object per word is made.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0..n-1 and their inverses."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums for ``run_hash``: one more than ``values``."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def run_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair, alike wherever it stands."""
    inverse = powers(len(sums))[1]
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


class Words:
    """The words of a list of texts (UTF-8 bytes). ``start`` and ``end`` are
    byte offsets into ``data``; ``first[i]:first[i + 1]`` are text i's words."""

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join([*texts, b""]).lower()
        self.data = np.frombuffer(joined, np.uint8)
        space = _SPACE[self.data]
        before = np.empty(len(space), bool)
        if len(space):
            before[0], before[1:] = True, space[:-1]
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(space & ~before)  # each text is followed by a line break
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.first = np.searchsorted(self.start, offsets)

    def hashes(self) -> np.ndarray:
        return run_hash(run_sums(_BYTE[self.data]), self.start, self.end)
