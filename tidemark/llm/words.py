"""Words of UTF-8 text and polynomial (Rabin-Karp) hashes of words and word windows.

Everything here works on the bytes of a whole Arrow column at once. Hash
arithmetic is modulo 2**64, where an odd base has an inverse, so the hash of any
stretch is a difference of running sums. Strings of 1,024 and more terms exist that
collide under every base there; longer words than ``LONG`` are hashed by XXH64
instead, and windows have at most ``MOST_WINDOW`` words.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

#: The white space that separates words.
SPACES = b" \t\n\x0b\x0c\r"
#: Bytes hashed with one table of powers.
STRETCH = 1 << 20

#: Longest word, in bytes, that the polynomial hashes.
LONG = 128
MOST_WINDOW = 512

#: Odd bases; hashes of the two families are independent.
_BYTE_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_LENGTH = np.uint64(0xD6E8FEB86659FD93)


def spaced_table() -> np.ndarray:
    """True for bytes that belong to words parted by white space."""
    table = np.ones(256, bool)
    table[list(SPACES)] = False
    return table


def alphanumeric_table() -> np.ndarray:
    """True for ASCII letters and digits and for every byte of a non-ASCII character."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = table[0x80:] = True
    return table


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z as a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def word_spans(data: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and each row's first word (one more entry than rows).

    Words never cross a row's end.
    """
    inside = table[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = at[1:] > at[:-1]
        opens, closes = at[:-1][full], at[1:][full] - 1
        first[opens] = inside[opens]
        last[closes] = inside[closes]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=2)
def _powers(family: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        out = np.full(STRETCH + 1, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    return table(_BYTE_BASES[family]), table(pow(_BYTE_BASES[family], -1, 1 << 64))


def _stretch_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int) -> np.ndarray:
    power, inverse = _powers(family)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=sums[1:])
    return (sums[ends] - sums[starts]) * inverse[starts]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes, of one of two independent families. Words of any length are hashed whole."""
    out = np.zeros(len(starts), np.uint64)
    long = np.flatnonzero(ends - starts > LONG)
    for k in long:
        out[k] = xxhash.xxh64_intdigest(data[starts[k]:ends[k]].tobytes(), seed=family)
    low = 0
    for stop in (*long.tolist(), len(starts)):
        while low < stop:
            origin = starts[low]
            high = min(stop, int(np.searchsorted(ends, origin + STRETCH, side="right")))
            out[low:high] = _stretch_hash(data[origin:ends[high - 1]], starts[low:high] - origin, ends[low:high] - origin, family)
            low = high
        low = stop + 1
    return mix(out ^ ((ends - starts).astype(np.uint64) * _LENGTH))


def window_hashes(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """The polynomial hash of every ``width`` consecutive word hashes (rows are not looked at)."""
    if width > MOST_WINDOW:
        raise ValueError(f"a window has at most {MOST_WINDOW} words")
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:count].copy()
    for k in range(1, width):
        out *= np.uint64(base)
        out += hashes[k:k + count]
    return mix(out)


def window_rows(first_word: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start word and row of each window of ``width`` words that lies within one row."""
    rows = np.repeat(np.arange(len(first_word) - 1), np.diff(first_word))
    starts = np.arange(len(rows))
    whole = first_word[1:][rows] - starts >= width if len(rows) else np.zeros(0, bool)
    return starts[whole], rows[whole]
