"""Words of whole batches of texts, as numpy arrays of hashes.

All of it works on the UTF-8 bytes of many texts at once. A word is a run of
bytes that are no separators; bytes of characters beyond ASCII never are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64))
_BYTE_CODES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)

#: Upper-case A-Z to lower case; all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """A table over bytes: true where a byte in one of the ranges separates words."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


#: White space: words are ``[^\x20\x09-\x0D]+``.
SPACE = separators((0x20, 0x20), (0x09, 0x0D))
#: All ASCII but digits and lower-case letters: words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
NOT_ALNUM = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** i`` modulo 2^64 for ``i`` up to ``n``; kept for the next call."""
    kept = _POWERS.get(int(base))
    if kept is None or len(kept) <= n:
        out = np.full(n + 1, base, np.uint64)
        out[0] = 1
        kept = np.cumprod(out)
        if n <= 1 << 21:
            _POWERS[int(base)] = kept
    return kept[: n + 1]


@dataclass
class Words:
    """``hashes`` of all words in order; text ``i`` has those from ``starts[i]`` to ``starts[i + 1]``."""

    hashes: np.ndarray
    starts: np.ndarray


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts after one another, and where each starts (null: no bytes)."""
    a = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(a.buffers()[1], np.int64, len(a) + 1 + a.offset)[a.offset :]
    data = a.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def words_of(texts: pa.Array, separator: np.ndarray) -> Words:
    """Hash every word of every text after lower-casing A-Z.

    Two words have one hash if they are equal, and else with odds of about 2^-63.
    """
    raw, offsets = text_bytes(texts)
    low = LOWER[raw]
    inside = np.zeros(len(low) + 2, bool)
    inside[1:-1] = ~separator[low]
    # A text's first byte starts a word even if the text before ended in one.
    joined = inside[1:] & inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(low)]
    joined[firsts] = False
    starts = np.flatnonzero(inside[1:-1] & ~joined[: len(low)])
    ends_here = inside[1:-1] & ~(joined[1:] if len(low) else joined[:0])
    ends = np.flatnonzero(ends_here) + 1
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[low] * powers(_BASE, len(low))[: len(low)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * powers(_BASE_INVERSE, len(low))[starts]
    return Words(mix(hashes), np.searchsorted(starts, offsets))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` words of one text."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    factors = powers(np.uint64(0xD6E8FEB86659FD93), n)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out += words[i : len(words) - n + 1 + i] * factors[i]
    return mix(out)
