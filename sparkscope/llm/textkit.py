"""Vectorised text kernels for Arrow batches: word spans, word hashes, shingles.

Texts are handled as UTF-8 bytes. A separator is put between documents, so that one
pass over a block of many documents finds every word and no word crosses documents.
A word hash is a polynomial over random 64-bit values of its bytes, finished by a
bit mixer; two different words share one with a chance of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Bytes of a word between white space: everything but space and 0x09 to 0x0D.
SPACED = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))

_RANDOM = np.random.default_rng(20240531)
_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` or more powers of the step and of its inverse modulo 2^64."""
    if 0 not in _powers or len(_powers[0][0]) < n:
        size = max(n, BLOCK_BYTES + (1 << 16))
        with np.errstate(over="ignore"):
            pair = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
                         for base in (_STEP, _STEP_BACK))
        if size > BLOCK_BYTES + (1 << 16):
            return pair  # for one long text; not kept
        _powers[0] = pair
    return _powers[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def text_values(column: pa.Array) -> list[bytes]:
    """The values of a binary (or string) column; null counts as empty."""
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes; a longer document stands alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


class Words:
    """All words of a block of documents.

    ``start`` and ``end`` are positions in ``data``; ``doc_first[i]`` to
    ``doc_first[i + 1]`` are the words of document ``i``.
    """

    def __init__(self, texts: list[bytes], table: np.ndarray = SPACED, lower: bool = True):
        self.data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        if lower:
            self.data = LOWER[self.data]
        inside = table[self.data]
        inside[np.cumsum([len(x) + 1 for x in texts], dtype=np.int64) - 1] = False
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        self.start, self.end = edge[0::2], edge[1::2]
        self.doc_begin = np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts], dtype=np.int64)])
        self.doc_first = np.searchsorted(self.start, self.doc_begin)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.doc_first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.doc_first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """The hash of every word, a block of words at a time: a hash does not depend on where its word begins."""
        out, low = np.empty(len(self), np.uint64), 0
        while low < len(self):
            begin = self.start[low]
            high = max(low + 1, int(np.searchsorted(self.end, begin + BLOCK_BYTES, "right")))
            data = self.data[begin: self.end[high - 1]]
            forth, back = powers(len(data) + 1)
            with np.errstate(over="ignore"):
                total = np.zeros(len(data) + 1, np.uint64)
                np.cumsum(_VALUE[data] * forth[: len(data)], out=total[1:])
                start = self.start[low:high] - begin
                out[low:high] = mix((total[self.end[low:high] - begin] - total[start]) * back[start])
            low = high
        return out

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i]: self.end[i]].tobytes()


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Order-sensitive hashes of ``n`` consecutive values, at every start position."""
    size = max(0, len(hashes) - n + 1)
    with np.errstate(over="ignore"):
        out = np.full(size, np.uint64(n), np.uint64)
        for i in range(n):
            out = (out * _STEP) ^ hashes[i: i + size]
            out += out >> np.uint64(29)
        return mix(out)


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingles of each document, as (document, hash), sorted by both.

    A document of fewer words, but not none, has its whole word sequence as its one shingle.
    """
    hashes, counts, doc = words.hashes(), words.counts, words.doc
    grams = ngrams(hashes, n)
    whole = doc[: len(grams)] == doc[n - 1: n - 1 + len(grams)]
    docs, values = [doc[: len(grams)][whole]], [grams[whole]]
    for size in range(1, n):
        short = np.flatnonzero(counts == size)
        if len(short):
            docs.append(short)
            values.append(ngrams(hashes, size)[words.doc_first[short]])
    d, v = np.concatenate(docs), np.concatenate(values)
    order = np.lexsort((v, d))
    d, v = d[order], v[order]
    first = np.ones(len(d), bool)
    first[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    return d[first], v[first]
