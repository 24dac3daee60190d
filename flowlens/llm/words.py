"""Words and shingles of many texts at once: positions and 64-bit hashes as numpy arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from flowlens.llm.common import text_bytes

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Multipliers of a public 64-bit finaliser.
_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], dtype=np.uint64)


def _times(n: int) -> np.uint64:
    return np.uint64(n * int(_STEP) % 2**64)


class Words(NamedTuple):
    """Word i is data[starts[i]:ends[i]]; the words of text j are first[j] to first[j + 1]."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def find_words(column: pa.Array, lower: bool, is_word: np.ndarray = _IS_WORD) -> Words:
    offsets, raw = text_bytes(column)
    n = len(raw)
    data = np.zeros(n + 8, dtype=np.uint8)
    data[:n] = _LOWER[raw] if lower else raw
    inside = is_word[data[:n]]
    begin, end = inside.copy(), inside.copy()
    if n:
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < n)]
        begin[edges] = inside[edges]
        end[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def word_hashes(words: Words) -> np.ndarray:
    """One 64-bit hash per word, from its bytes alone."""
    length = words.ends - words.starts
    hashes = length.astype(np.uint64) * _STEP
    if not len(length):
        return hashes
    eights = np.ndarray(shape=(len(words.data) - 7,), dtype="<u8", buffer=words.data, strides=(1,))
    at, left, who = words.starts, length, None
    while True:
        part = eights[at] & _MASKS[np.minimum(left, 8)]
        if who is None:
            hashes = mix(hashes ^ part) + _STEP
        else:
            hashes[who] = mix(hashes[who] ^ part) + _STEP
        more = left > 8
        if not more.any():
            return mix(hashes)
        who = np.flatnonzero(more) if who is None else who[more]
        at, left = at[more] + 8, left[more] - 8


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` consecutive words, whoever owns them."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    out = hashes[: len(hashes) - size + 1] + _times(size)
    for j in range(1, size):
        out = mix(out + _STEP) ^ hashes[j : len(hashes) - size + 1 + j]
    return mix(out)


def shingle_sets(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of the shingles of each text, repeats included; a text with fewer words is one shingle."""
    hashes = word_hashes(words)
    whole = window_hashes(hashes, size)
    owner = words.owner
    here = np.flatnonzero(np.arange(len(whole)) + size <= words.first[1:][owner[: len(whole)]])
    owners, found = [owner[here]], [whole[here]]
    counts = words.counts
    for n in range(1, size):
        texts = np.flatnonzero(counts == n)
        if len(texts):
            at = words.first[texts]
            value = hashes[at] + _times(n)
            for j in range(1, n):
                value = mix(value + _STEP) ^ hashes[at + j]
            owners.append(texts)
            found.append(mix(value))
    if len(owners) == 1:
        return owners[0], found[0]
    owners, found = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(owners, kind="stable")
    return owners[order], found[order]


def distinct_sets(words: Words, size: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    owners, found = shingle_sets(words, size)
    bounds = np.searchsorted(owners, np.arange(len(words.first)))
    return [np.unique(found[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
