"""Words and word hashes of many texts at once, by numpy over UTF-8 bytes.

Only A-Z are lower-cased and only ASCII bytes can separate words, so working on bytes
equals working on code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply, twice)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_HASH = _mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0xD1342543DE82EF95
INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

# words are runs of bytes outside the separators
ASCII_SPACE = np.ones(256, bool)  # [^\x20\x09-\x0D]+
ASCII_SPACE[[32, 9, 10, 11, 12, 13]] = False
ALPHANUMERIC = np.zeros(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing
ALPHANUMERIC[48:58] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2 ** 64 (kept and grown)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        factors = np.full(max(n, 1 << 16), base, U64)
        factors[0] = 1
        have = _powers[base] = np.cumprod(factors, dtype=U64)
    return have[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, bounds): text i is ``bytes[bounds[i]:bounds[i + 1]]``; nulls
    are empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def prefix_hash(codes: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Sums of codes[i] * base ** i, with a leading 0."""
    out = np.zeros(len(codes) + 1, U64)
    np.cumsum(codes * powers(base, len(codes)), out=out[1:])
    return out


@dataclass
class Words:
    data: np.ndarray  # lower-cased bytes of all texts
    start: np.ndarray  # byte offsets of words
    end: np.ndarray
    first: np.ndarray  # words first[i]:first[i + 1] are text i's
    hash: np.ndarray

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, valid): of the k words from each word on; valid if they are of one text."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, U64), np.zeros(0, bool)
        out = np.zeros(n - k + 1, U64)
        for j in range(k):
            out = out * U64(0x9E3779B97F4A7C15) + self.hash[j : n - k + 1 + j]
        last = np.repeat(self.first[1:], np.diff(self.first))[: n - k + 1]
        return _mix(out), np.arange(k, n + 1) <= last


def word_edges(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) offsets of the words of all texts; no word goes across a bound."""
    word = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True  # a text starts or ends here
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    start = np.flatnonzero(word & (~before | edge[:-1]))
    return start, np.flatnonzero(word & (~after | edge[1:])) + 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = prefix_hash(BYTE_HASH[data])
    return _mix((sums[end] - sums[start]) * powers(INVERSE, len(data) + 1)[start])


def find_words(column: pa.Array, inside: np.ndarray) -> Words:
    raw, bounds = text_bytes(column)
    data = LOWER[raw]
    start, end = word_edges(data, bounds, inside)
    return Words(data, start, end, np.searchsorted(start, bounds), word_hashes(data, start, end))


def blocks(
    column: pa.Array, inside: np.ndarray, limit: int = 1 << 20
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, bounds): runs of texts of about ``limit`` bytes.  A longer
    text comes alone and in parts that end before a separator (rows is 0 for all but its
    last part), so that hashing one takes bounded memory."""
    raw, bounds = text_bytes(column)
    sizes = np.diff(bounds)
    at = 0
    while at < len(sizes):
        if sizes[at] > limit:
            a, b = int(bounds[at]), int(bounds[at + 1])
            while a < b:
                cut = min(a + limit, b)
                while cut < b and inside[raw[cut]]:
                    outside = np.flatnonzero(~inside[raw[cut : cut + limit]])
                    cut = min(b, cut + (int(outside[0]) if len(outside) else limit))
                yield at, int(cut == b), raw[a:cut], np.array([0, cut - a])
                a = cut
            at += 1
            continue
        to = at + 1
        while to < len(sizes) and bounds[to + 1] - bounds[at] <= limit:
            to += 1
        yield at, to - at, raw[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to
