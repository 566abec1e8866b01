"""Word shingles as 64-bit hashes, in NumPy.

Texts are read as UTF-8 bytes straight from Arrow buffers, in slices; no word becomes a Python
object. A word's hash is a polynomial in its bytes modulo 2**64, mixed.

Defined cases: a null text is an empty one; an empty or blank text has no word and the empty set; a
text of fewer words than a shingle is one shingle of them all; a text longer than a slice is a
slice of its own; an empty array gives nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
S29, S32 = np.uint64(29), np.uint64(32)
#: Bytes of text worked on together; a longer text is a slice of its own.
SLICE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> S32)) * M2
    x = (x ^ (x >> S29)) * M3
    return x ^ (x >> S32)


#: Value of each byte in a word's hash: A-Z as a-z, white space (space and \x09-\x0D) 0.
BYTES = mix(np.arange(1, 257, dtype=np.uint64))
BYTES[ord("A"):ord("Z") + 1] = BYTES[ord("a"):ord("z") + 1]
BYTES[[0x20, *range(0x09, 0x0E)]] = 0


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as they were asked for."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            one = np.ones(1, dtype=np.uint64)
            self.up, self.down = (np.multiply.accumulate(np.concatenate([one, np.full(n + n // 4, b, dtype=np.uint64)]))
                                  for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


powers = Powers(M1)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds): text i is bytes[bounds[i]:bounds[i + 1]]; a null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    bounds = np.frombuffer(offsets, dtype=kind)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, kind)
    return np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, dtype=np.uint8), bounds.astype(np.int64)


def slices(bounds: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of at most ``size`` bytes together, or of one text."""
    lo = 0
    while lo < len(bounds) - 1:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + size, side="right")) - 1)
        yield lo, hi
        lo = hi


def word_hashes(data: np.ndarray, bounds: np.ndarray, values: np.ndarray = BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, before): hashes of all words of texts end to end, and the words before each text.

    Bytes of value 0 part words, and so do the ends of texts.
    """
    x = values[data]
    inside = x != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[at] = inside[at]
    starts = np.flatnonzero(begins)
    before = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), before
    up, down = powers(len(x))
    return mix(np.add.reduceat(x * up, starts) * down[starts]), before


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive values."""
    n = len(h) - k + 1
    acc = np.full(n, np.uint64(k), dtype=np.uint64)
    for j in range(k):
        acc = acc * M1 + h[j:j + n]
    return mix(acc)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each text; a shorter text is one shingle, no words none."""
    data, bounds = utf8(texts)
    for lo, hi in slices(bounds):
        h, before = word_hashes(data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo])
        runs = rolling(h, k) if len(h) >= k else h[:0]
        for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
            s = runs[a:b - k + 1] if b - a >= k else rolling(h[a:b], b - a) if b > a else h[:0]
            s = np.sort(s)
            yield s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def set_key(s: np.ndarray) -> int:
    """Signed 64-bit key of a shingle set."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)
