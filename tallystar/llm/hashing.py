"""Hashes of all windows of a byte string at once, in numpy."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2^64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, length: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < length:
        size = 1 << max(12, int(length - 1).bit_length())
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if size <= 1 << 22:
            _powers[name] = known
    return known[:length]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_sums(text: np.ndarray) -> np.ndarray:
    """sums[i]: polynomial of the first i bytes, in powers of the inverse base."""
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(BYTE[text] * _power("inverse", INVERSE, len(text)), out=sums[1:])
    return sums


def windows(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of text[start:end]: equal for equal bytes, wherever they stand."""
    return mix((sums[ends] - sums[starts]) * _power("base", BASE, len(sums))[starts])
