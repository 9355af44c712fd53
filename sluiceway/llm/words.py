"""Words of UTF-8 texts as 64-bit hashes, a whole batch at a time in numpy.

A word is a longest run of bytes of a given class. Texts are taken in blocks, cut between
words, so the memory does not depend on how long a text is (only on its longest word).
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from sluiceway.llm.frames import worker_cache

BLOCK = 1 << 18

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def space_separated() -> np.ndarray:
    """Which bytes belong to a word: all but space and ``\\t`` to ``\\r``."""
    member = np.ones(256, bool)
    member[[0x20, *range(0x09, 0x0E)]] = False
    return member


def letters_and_digits() -> np.ndarray:
    """Which bytes belong to a word: ASCII letters and digits and all that is not ASCII."""
    member = np.zeros(256, bool)
    member[0x30:0x3A] = member[0x41:0x5B] = member[0x61:0x7B] = member[0x80:] = True
    return member


def lower_ascii() -> np.ndarray:
    """Byte to byte, A-Z to lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words under which near values end far apart."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of several texts in order; those of text ``i`` are ``first[i]:first[i + 1]``."""

    hashes: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray

    def of(self, text: int) -> np.ndarray:
        return self.hashes[self.first[text] : self.first[text + 1]]


def words_of(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> Words:
    """All words of the texts in ``data``; case of A-Z does not count."""
    hashes, starts, stops = [], [], []
    value = (lower_ascii().astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    for low, high in _blocks(data, offsets, member):
        block = data[low:high]
        inside = member[block]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        # A word never runs from one text into the next.
        bounds = offsets[np.searchsorted(offsets, low, "right") : np.searchsorted(offsets, high)]
        bounds = bounds - low
        begins[bounds] = inside[bounds]
        ends[bounds - 1] = inside[bounds - 1]
        begin, end = np.flatnonzero(begins), np.flatnonzero(ends)
        if not len(begin):
            continue
        power, inverse = _powers(len(block))
        terms = value[block] * power[: len(block)]
        sums = np.cumsum(terms, dtype=np.uint64)
        total = (sums[end] - sums[begin] + terms[begin]) * inverse[begin]
        hashes.append(mix(total + (end - begin + 1).astype(np.uint64)))
        starts.append(begin + low)
        stops.append(end + low + 1)
    none = np.zeros(0, np.int64)
    start = np.concatenate(starts) if starts else none
    return Words(
        np.concatenate(hashes) if hashes else none.astype(np.uint64),
        start,
        np.concatenate(stops) if stops else none,
        np.searchsorted(start, offsets),
    )


def _blocks(
    data: np.ndarray, offsets: np.ndarray, member: np.ndarray
) -> Iterator[tuple[int, int]]:
    """Ranges of about ``BLOCK`` bytes that end between words."""
    low, size = 0, len(data)
    while low < size:
        high = min(low + BLOCK, size)
        reach = BLOCK
        while high < size and high not in offsets[np.searchsorted(offsets, high) :][:1]:
            gaps = np.flatnonzero(~member[data[low:high]])
            bound = int(offsets[np.searchsorted(offsets, high) - 1])
            cut = max(low + int(gaps[-1]) + 1 if len(gaps) else low, bound)
            if cut > low:
                high = cut
                break
            reach *= 2
            high = min(low + reach, size)
        yield low, high
        low = high


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, kept for blocks of the usual size."""
    cache = worker_cache()
    if "powers" not in cache or len(cache["powers"][0]) < length:
        size = max(length, BLOCK)
        inverse = pow(_MULTIPLIER, -1, 1 << 64)
        made = []
        for base in (_MULTIPLIER, inverse):
            steps = np.full(size, np.uint64(base & _MASK))
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        if size > BLOCK:
            return tuple(made)
        cache["powers"] = tuple(made)
    return cache["powers"]


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words, sorted within each text, and where each text begins.

    A text of fewer words has one shingle of all its words, a text without words none.
    """
    counts = np.diff(words.first)
    h = words.hashes
    joined = h[: max(len(h) - size + 1, 0)].copy()
    for k in range(1, size):
        joined *= np.uint64(0x9FB21C651E98DF25)
        joined += h[k : len(h) - size + 1 + k] ^ np.uint64(k)
    joined = mix(joined)
    parts = []
    for i, (n, at) in enumerate(zip(counts.tolist(), words.first.tolist())):
        if n >= size:
            own = np.sort(joined[at : at + n - size + 1])
            parts.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif n:
            whole = np.full(1, n, np.uint64)
            for k in range(n):
                whole = mix(whole * np.uint64(0x9FB21C651E98DF25) + h[at + k : at + k + 1])
            parts.append(whole)
        else:
            parts.append(h[:0])
    first = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))
    return (np.concatenate(parts) if parts else h[:0]), first
