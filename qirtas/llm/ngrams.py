"""Codes of short byte n-grams of whole texts, for many rows at a time."""

from __future__ import annotations

import numpy as np

from .text import U, mix

LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = True


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII letters in lower case, white space as a space."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] |= 32
    out[(data >= 9) & (data <= 13)] = 32
    return out


def gram_codes(data: np.ndarray, n: int) -> np.ndarray:
    """A 32-bit code of the n bytes from each position on (n up to 4: the bytes themselves)."""
    size = max(0, len(data) - n + 1)
    code = np.zeros(size, np.uint32)
    for i in range(n):
        code |= data[i : i + size].astype(np.uint32) << np.uint32(8 * i)
    return code


def rows_of(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def hashed(code: np.ndarray, n: int, bits: int) -> np.ndarray:
    return (mix(code.astype(U), n) >> U(64 - bits)).astype(np.int32)
