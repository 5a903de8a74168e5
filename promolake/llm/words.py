"""Words of many texts as numpy arrays.

A word is a maximal run of bytes other than \\x20 and \\x09-\\x0D, which for UTF-8 is the same as a run of such
characters.  Hashes are 64 bits wide: a polynomial over randomly weighted bytes, read off one running sum."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240229)
_WEIGHT = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_R = np.uint64(0x9E3779B97F4A7C15 | 5)
_R_INVERSE = np.uint64(pow(int(_R), -1, 1 << 64))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 1 << 16)
        p, q = np.full(size, _R), np.full(size, _R_INVERSE)
        p[0] = q[0] = 1
        _powers, _inverses = np.cumprod(p), np.cumprod(q)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of uint64 values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def running(values: np.ndarray) -> np.ndarray:
    """Running sums (one longer than values) for span_hash; values: uint64 weights of symbols."""
    _grow(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers[: len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end); equal contents have equal hashes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * _inverses[starts] + (ends - starts).astype(np.uint64))


def byte_sums(buf: np.ndarray) -> np.ndarray:
    return running(_WEIGHT[buf])


class Words:
    """starts, ends: byte offsets in `buf`; first: index of each text's first word, with a last entry; hash."""

    def __init__(self, texts: list[bytes], lower: bool = True, hashed: bool = True):
        joined = b"\n" + b"\n".join(texts) + b"\n"
        self.raw = joined
        self.buf = np.frombuffer(joined.lower() if lower else joined, np.uint8)
        inside = ~IS_SPACE[self.buf]
        flips = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.starts, self.ends = flips[0::2], flips[1::2]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offsets = np.concatenate([[1], 1 + np.cumsum(sizes + 1)])
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        if hashed:
            self.sums = byte_sums(self.buf)
            self.hash = span_hash(self.sums, self.starts, self.ends)

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


_A, _B, _C = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of a sequence of hashes."""
    out = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        out = out * _A + (p ^ _B) * _C
    return mix(out)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each run of k words; a text with 1 to k-1 words has its whole sequence as the only one."""
    h, n, first = words.hash, words.counts, words.first
    each = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), each)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each) + first[:-1][doc]
    short = n[doc] < k
    out = np.empty(len(doc), np.uint64)
    full = at[~short]
    out[~short] = combine([h[full + j] for j in range(k)])
    for i in np.flatnonzero(short):
        d = doc[i]
        out[i] = combine([h[j : j + 1] for j in range(first[d], first[d] + n[d])])[0] ^ np.uint64(n[d])
    return doc, out


def shingle_sizes(words: Words, k: int) -> np.ndarray:
    """Bytes of the words of each run, in the order of shingles()."""
    n, first = words.counts, words.first
    ends = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    each = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), each)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each) + first[:-1][doc]
    return ends[at + np.minimum(k, n[doc])] - ends[at]
