"""Word shingles and MinHash bands, in numpy, for use inside tasks."""

from __future__ import annotations

import hashlib

import numpy as np

SHINGLE_WORDS = 5
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: A random code for each byte; blanks add nothing to a word.
_CODE = np.where(_BLANK, 0, np.random.default_rng(11).integers(1, 1 << 63, 256, np.int64)).astype(np.uint64)


def mix(h):
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def hashed_words(texts: list[str | None]):
    """64-bit hashes of the words (runs between ASCII blanks) of many texts, in a
    row; how many words each text has; and the words' line numbers, counted
    through all texts. A word's hash is a polynomial in its bytes' random codes,
    made for all bytes at once."""
    raw = np.frombuffer(b"\n".join([(t or "").encode() for t in texts]) + b"\n", np.uint8)
    blank = _BLANK[raw]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64), starts
    span = np.diff(np.append(starts, len(raw)))
    power = np.cumprod(np.full(int(span.max()), _BASE, np.uint64), dtype=np.uint64)
    tail = raw[starts[0]:]
    place = np.arange(len(tail)) - np.repeat(starts - starts[0], span)
    hashes = mix(np.add.reduceat(_CODE[tail] * power[place], starts - starts[0]))
    breaks = np.flatnonzero(raw == 10)
    lines = np.searchsorted(breaks, starts)
    text_ends = np.cumsum([len((t or "").encode()) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, text_ends), prepend=0), lines


def shingles(hashes, size: int = SHINGLE_WORDS):
    """The distinct shingles (64-bit, sorted) of a text's word hashes. A text of
    fewer words, but not none, is one shingle."""
    n = len(hashes) - size + 1
    if n < 1:
        if not len(hashes):
            return np.empty(0, np.uint64)
        size, n = len(hashes), 1
    h = np.full(n, size, np.uint64)
    for j in range(size):
        h = h * _MIX + hashes[j:j + n]
    return np.unique(mix(h))


def many_shingles(hashes, begins, sizes, size: int = SHINGLE_WORDS):
    """Distinct shingles of many texts of ``size`` words or more, text after text
    and sorted in each, and where each text's end. ``begins`` and ``sizes`` are the
    texts' places among the word hashes."""
    h = np.full(max(0, len(hashes) - size + 1), size, np.uint64)
    for j in range(size):
        h = h * _MIX + hashes[j:j + len(h)]
    n = sizes - size + 1
    text = np.repeat(np.arange(len(begins)), n)
    h = mix(h)[np.repeat(begins - np.cumsum(n) + n, n) + np.arange(n.sum())]
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])])
    return h[new], np.cumsum(np.bincount(text[new], minlength=len(begins)))


def set_names(grams, ends):
    """128-bit names of shingle sets, as rows of bytes."""
    starts = np.concatenate([[0], ends[:-1]])
    one = mix(np.add.reduceat(mix(grams ^ _MIX), starts) + (ends - starts).astype(np.uint64))
    other = mix(np.bitwise_xor.reduceat(mix(grams + _MIX), starts) + one)
    return np.ascontiguousarray(np.stack([one, other], 1)).view(np.uint8)


def set_id(grams) -> bytes:
    """128-bit name of a shingle set."""
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


class Bands:
    """``bands`` hashes of ``rows`` minima each. Two sets of Jaccard similarity
    s share a band with probability 1 - (1 - s**rows)**bands."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.shape = (bands, rows)
        self.a = rng.integers(0, 1 << 32, bands * rows, np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, bands * rows, np.uint32)
        self.salt = rng.integers(0, 1 << 63, bands, np.int64).astype(np.uint64)

    def of_many(self, grams, ends):
        """Band hashes of many sets that lie in a row (a line for each)."""
        x = (grams >> np.uint64(32)).astype(np.uint32)
        starts = np.concatenate([[0], ends[:-1]])
        bands, rows = self.shape
        out = np.repeat(self.salt[:, None], len(starts), axis=1)
        for j in range(rows):
            for k in range(bands):
                i = k * rows + j
                low = np.minimum.reduceat(x * self.a[i] + self.b[i], starts)
                out[k] = mix((out[k] ^ low) * _MIX)
        return np.ascontiguousarray(out.T).view(np.int64)

    def of(self, grams):
        x = (grams >> np.uint64(32)).astype(np.uint32)[:, None]
        low = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 2048):
            np.minimum(low, (x[i:i + 2048] * self.a + self.b).min(0), out=low)
        h = self.salt.copy()
        for column in low.reshape(self.shape).T:
            h = mix((h ^ column) * _MIX)
        return h.view(np.int64)
