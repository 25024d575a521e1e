"""Words of a batch of texts found and hashed on the batch's bytes.

Arrow hands texts over as one buffer of UTF-8 with offsets. Words are runs of
bytes of a class; a word's hash comes from prefix sums over the buffer, so no
text becomes a Python string. Hashes only ever point to candidates or to
known words; whatever must be exact is compared afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
_powers = {True: np.ones(1, np.uint64), False: np.ones(1, np.uint64)}

#: Byte classes: everything but ASCII white space; ASCII letters and digits with all bytes of other characters.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.array([chr(b).isalnum() or b == 0x5F or b >= 0x80 for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _power(n: int, up: bool) -> np.ndarray:
    """Powers of the hash's base (or its inverse) up to n."""
    have = _powers[up]
    if len(have) <= n:
        base = np.full(max(n + 1, 1 << 20), _R if up else _R_INV, np.uint64)
        base[0] = 1
        have = _powers[up] = np.cumprod(base)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a hash over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def lower(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and the Latin-1 letters."""
    out = _LOWER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) + 1
    lead = lead[(data[lead] >= 0x80) & (data[lead] <= 0x9E) & (data[lead] != 0x97)]
    out[lead] += 0x20
    return out


def texts(column: pa.Array, size: int = 1_000_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of blocks of about ``size`` bytes; no text is null."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    all_bytes = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(off, off[a] + size, "right")) - 1)
        yield a, b, all_bytes[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def alone(data: np.ndarray) -> np.ndarray:
    """Places of the first bytes of characters that are words of their own: those
    of scripts written without spaces (Thai and Lao, Myanmar, Khmer, kana, Han)."""
    lead = data[:-1] >= 0xE0
    at = np.flatnonzero(lead)
    one, two = data[at], data[at + 1]
    kana_han = (one >= 0xE3) & (one <= 0xE9)
    rare_han = (one == 0xF0) & (two >= 0xA0) & (two <= 0xB2)
    thai = (one == 0xE0) & (two >= 0xB8) & (two <= 0xBB)
    others = (one == 0xE1) & ((two == 0x80) | (two == 0x81) | (two == 0x9E) | (two == 0x9F))
    return at[kana_han | rare_han | thai | others]


def marks(data: np.ndarray) -> np.ndarray:
    """Places of the first bytes of marks of those scripts: U+3000 to U+303F and full-width ASCII marks."""
    at = np.flatnonzero((data[:-2] == 0xE3) & (data[1:-1] == 0x80) | (data[:-2] == 0xEF) & (data[1:-1] == 0xBC))
    two, three = data[at + 1], data[at + 2]
    return at[(two == 0x80) | (three <= 0x8F) | (three >= 0x9A) & (three <= 0xA0)]


def find(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, characters: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of words of each text. With
    ``characters``, those of scripts written without spaces are words each."""
    inside = kind[data]
    if characters and len(data) > 2:
        inside[marks(data)[:, None] + np.arange(3)] = False
    first = offsets[:-1][np.diff(offsets) > 0]
    before = np.r_[False, inside[:-1]]
    before[first] = False
    after = np.r_[inside[1:], False]
    after[first[1:] - 1] = False
    if characters and len(data):
        at = alone(data)
        last = np.minimum(at + 2 + (data[at] >= 0xF0), len(data) - 1)
        before[at] = False
        before[last[last + 1 < len(data)] + 1] = False
        after[last] = False
        after[at[at > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    n = len(data)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(n, True)[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(n, False)[starts] + (ends - starts).astype(np.uint64))


def hash_words(words: list[str]) -> np.ndarray:
    """The hashes of given words."""
    column = pa.array(words, pa.large_string())
    out = [np.zeros(0, np.uint64)]
    for _, _, data, offsets in texts(column):
        out.append(hashes(data, offsets[:-1], offsets[1:]))
    return np.concatenate(out)


class Lookup:
    """Places of words in a fixed vocabulary, by hash."""

    BITS = 18

    def __init__(self, words: list[str]):
        h = hash_words(words)
        self.order = np.argsort(h)
        self.sorted = h[self.order]
        self.maybe = np.zeros(1 << self.BITS, bool)
        self.maybe[h >> np.uint64(64 - self.BITS)] = True

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash's word, -1 for words outside."""
        out = np.full(len(h), -1, np.int64)
        if len(self.sorted):
            near = np.flatnonzero(self.maybe[h >> np.uint64(64 - self.BITS)])
            at = np.minimum(np.searchsorted(self.sorted, h[near]), len(self.sorted) - 1)
            out[near] = np.where(self.sorted[at] == h[near], self.order[at], -1)
        return out
