"""Words of many texts at once, as numpy arrays over their bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from lexiquarry.llm.rows import raw_bytes

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def byte_set(*spans: tuple[int, int]) -> np.ndarray:
    """A table that is true for the bytes within the spans, ends included."""
    table = np.zeros(256, bool)
    for low, high in spans:
        table[low : high + 1] = True
    return table


# Fixed value: digits, letters (upper case is lowered first) and all beyond ASCII.
WORD_BYTES = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


@dataclass
class Words:
    """Lower-cased words: their bytes one after another, their text, and their place in the input."""

    data: np.ndarray  # bytes of all words
    ends: np.ndarray  # where each word begins in data, and the end
    text: np.ndarray  # index of the text a word is in
    first: np.ndarray  # where it begins in the input bytes
    last: np.ndarray  # where it ends there
    texts: int

    def __len__(self) -> int:
        return len(self.text)

    def counts(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.texts).astype(np.int64)

    def arrow(self) -> pa.LargeBinaryArray:
        buffers = [None, pa.py_buffer(self.ends), pa.py_buffer(self.data)]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self), buffers)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.ends[:-1], np.diff(self.ends))


def words_of(texts: pa.Array, word: np.ndarray = WORD_BYTES) -> Words:
    """Maximal runs of word bytes; a run never goes from one text into the next."""
    raw, offsets = raw_bytes(texts)
    return words_in(raw, offsets, word)


def words_in(
    raw: np.ndarray, offsets: np.ndarray, word: np.ndarray = WORD_BYTES, fold: np.ndarray = LOWER
) -> Words:
    """As `words_of`; `fold` has the byte that stands for each byte of a word."""
    inside = word[raw]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    begins[cuts[cuts < len(raw)]] |= inside[cuts[cuts < len(raw)]]
    ends[cuts[cuts > 0] - 1] |= inside[cuts[cuts > 0] - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(
        data=fold[raw[inside]],
        ends=np.concatenate(([0], np.cumsum(last - first))),
        text=np.searchsorted(offsets, first, "right") - 1,
        first=first,
        last=last,
        texts=len(offsets) - 1,
    )


_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(256, np.uint64)
np.cumprod(np.full(255, _BASE, np.uint64), out=_POWERS[1:])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of adjacent spans of bytes that cover data; equal bytes, equal hash."""
    global _POWERS
    if not len(begins):
        return np.zeros(0, np.uint64)
    longest = int(lengths.max())
    if longest > len(_POWERS):
        _POWERS = np.concatenate(([np.uint64(1)], np.cumprod(np.full(longest, _BASE, np.uint64))))
    at = np.arange(len(data), dtype=np.int64) - np.repeat(begins, lengths)
    return mix(np.add.reduceat(_BYTE[data] * _POWERS[at], begins) + lengths.astype(np.uint64))


def shingle_hashes(words: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words, and their texts; a text of fewer words, but not none, has one run."""
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    edge = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    size = np.diff(np.append(edge, len(text)))
    seed = np.zeros(len(words), np.uint64)
    reach = np.zeros(len(words), np.int64)
    left = np.repeat(edge + size, size) - np.arange(len(words))  # words up to the end of the text
    for k in range(n):
        there = left > k
        w = np.zeros(len(words), np.uint64)
        w[: max(len(words) - k, 0)] = words[k:]
        seed = np.where(there, mix(seed * _BASE + w + np.uint64(k + 1)), seed)
        reach += there
    whole = left >= n
    short = np.repeat(size < n, size)
    short &= np.concatenate(([True], text[1:] != text[:-1]))
    keep = whole | short
    return seed[keep], text[keep]
