"""Words and word shingles of whole batches of texts, on their UTF-8 bytes.

A word is a run of bytes other than space and 0x09-0x0D, which is the same as
the character class [^\\x20\\x09-\\x0D]+ since those are all ASCII. Words are
numbered exactly within a batch and named by a keyed cryptographic hash of each
distinct one; features have hashes of their own, a polynomial over the bytes.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Java and DuckDB pattern of a word.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the next batch."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n + n // 2, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def packed(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, end to end, and n + 1 offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def names(words: pa.Array, lane: int = 0) -> np.ndarray:
    """64-bit names of words (bytes) by a keyed cryptographic hash; lanes are independent of each other."""
    key = b"longtide %d" % lane
    return np.frombuffer(b"".join([blake2b(w, digest_size=8, key=key).digest() for w in words.to_pylist()]), np.uint64)


class Words:
    """Where the words of a batch start and end, which text each is in, and their hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _SPACES, lower: bool = True):
        self.data, self.offsets = data, offsets
        n = len(data)
        space = breaks[data]
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        inner = offsets[(offsets > 0) & (offsets < n)]
        before[inner] = True
        after[inner - 1] = True
        self.starts = np.flatnonzero(before & ~space)
        self.ends = np.flatnonzero(after & ~space) + 1
        self.firsts = np.searchsorted(self.starts, offsets)  # n + 1: the first word of each text
        self.counts = np.diff(self.firsts)
        self._lower, self._run = lower, None

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """A number of each word, the same for equal words and no others, and the distinct words (bytes) by it."""
        lengths = self.ends - self.starts
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[self.starts] += 1
        inside[self.ends] -= 1
        solid = self.data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        if self._lower:
            solid = _LOWER[solid]
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)))
        array = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(solid))]).dictionary_encode()
        return array.indices.to_numpy(), array.dictionary

    def hashes(self, first: int | None = None) -> np.ndarray:
        """A hash of each word, or of its first bytes only, for features: words that share one can be made."""
        n = len(self.data)
        up, down = _powers_to(n + 1)
        if self._run is None:
            data = _LOWER[self.data] if self._lower else self.data
            self._run = np.zeros(n + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=self._run[1:])
        ends = self.ends if first is None else np.minimum(self.ends, self.starts + first)
        return mix((self._run[ends] - self._run[self.starts]) * down[self.starts] + (ends - self.starts).astype(np.uint64))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k items in a row, at every position that has k from there on."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    out = hashes[: len(hashes) - k + 1].copy()
    for i in range(1, k):
        out = out * np.uint64(_BASE) + hashes[i : len(hashes) - k + 1 + i]
    return mix(out + np.uint64(k))


def chained(named: np.ndarray, k: int) -> np.ndarray:
    """Shingles of k names in a row, mixed at every step, so that sums of names don't make equal ones."""
    if len(named) < k:
        return np.zeros(0, np.uint64)
    out = np.full(len(named) - k + 1, k, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(_BASE) + named[i : len(named) - k + 1 + i])
    return out


def shingle_sets(texts: pa.Array | pa.ChunkedArray, k: int, lanes: int = 1) -> list[np.ndarray]:
    """For each text its sorted distinct k-word shingles; with fewer words the whole sequence is one.

    A shingle is made of its words' names. With two lanes each set is 2 x n: the shingles, and under each another
    64 bits of it by independent names.
    """
    data, offsets = packed(texts)
    words = Words(data, offsets)
    codes, distinct = words.coded()
    named = [names(distinct, lane)[codes] for lane in range(lanes)]
    every = [chained(n, k) for n in named]
    out = []
    for a, b in zip(words.firsts[:-1].tolist(), words.firsts[1:].tolist(), strict=True):
        if b - a >= k:
            own = [e[a : b - k + 1] for e in every]
        else:
            own = [chained(n[a:b], b - a) if b > a else np.zeros(0, np.uint64) for n in named]
        if lanes == 1:
            first = np.sort(own[0])
            out.append(first[np.concatenate(([True], first[1:] != first[:-1]))] if len(first) else first)
        else:
            first, at = np.unique(own[0], return_index=True)
            out.append(np.stack([first, *(x[at] for x in own[1:])]))
    return out
