"""Word positions and 64-bit word hashes of UTF-8 text as numpy arrays."""

from __future__ import annotations

import numpy as np

MASK = (1 << 64) - 1


def splitmix(x: int) -> int:
    """One step of the splitmix64 generator."""
    x = (x + 0x9E3779B97F4A7C15) & MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def constants(seed: int, count: int) -> np.ndarray:
    """Fixed odd 64-bit numbers."""
    return np.array([splitmix(seed * 1_000_003 + k) | 1 for k in range(count)], dtype=np.uint64)


#: A random number per byte value, and an odd base with its inverse modulo 2**64.
BYTE_CODES = constants(11, 256)
BASE = splitmix(77) | 1
INVERSE = pow(BASE, -1, 1 << 64)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, length: int) -> np.ndarray:
    """base**0, base**1 ... modulo 2**64, kept for the longest length of up to 4 MB asked for."""
    kept = _powers.get(base)
    if kept is None or len(kept) < length:
        size = max(length, 1 << 16)
        kept = np.full(size, base, dtype=np.uint64)
        kept[0] = 1
        kept = np.multiply.accumulate(kept)
        if size <= 1 << 22:
            _powers[base] = kept
    return kept[:length]


def mix(x: np.ndarray) -> np.ndarray:
    """Splitmix finaliser of an array of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: True for the bytes of [\x20\x09-\x0D].
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def spans(data: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not separators."""
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    np.logical_not(separators[data], out=inside[1:-1].view(bool))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


class Prefix:
    """Hash of any byte range of a text in constant time, from prefix sums."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODES[data] * powers(BASE, len(data)), out=self.sums[1:])
        self.back = powers(INVERSE, len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])


#: Bytes hashed at a time; a longer word is hashed in one go all the same.
PIECE = 1 << 22


def pieces(
    data: np.ndarray, separators: np.ndarray = SPACES, size: int = PIECE
) -> list[tuple[int, int]]:
    """Ranges of about ``size`` bytes that end at separators."""
    found, a = [], 0
    while a < len(data):
        b = min(a + size, len(data))
        while b < len(data):
            near = np.flatnonzero(separators[data[b : b + size]])
            if len(near):
                b += int(near[0])
                break
            b = min(b + size, len(data))
        found.append((a, b))
        a = b
    return found


def word_hashes(
    data: np.ndarray, separators: np.ndarray = SPACES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word, with memory bounded by the words and not by the bytes."""
    parts = []
    for a, b in pieces(data, separators):
        piece = data[a:b]
        starts, ends = spans(piece, separators)
        parts.append((starts + a, ends + a, Prefix(piece).of(starts, ends)))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
