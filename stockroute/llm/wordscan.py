"""Vectorised word scanning of Arrow string columns.

Words are ``[^\\x20\\x09-\\x0D]+`` over the UTF-8 bytes (those six are the only
separators, so bytes and code points split alike).  A word is known by a 64-bit
hash of its bytes and length.  Texts are scanned whole; a batch is cut into
blocks of whole documents to keep the temporaries small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
BLOCK_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser on 64-bit hashes."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    column = pa.array(column) if not isinstance(column, (pa.Array, pa.ChunkedArray)) else column
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def spans(flags: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of set flags, cut at document borders."""
    if not len(flags):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty_like(flags)
    before[0], before[1:] = False, flags[:-1]
    before[off[:-1][off[:-1] < len(flags)]] = False
    after = np.empty_like(flags)
    after[-1], after[:-1] = False, flags[1:]
    last = off[1:] - 1
    after[last[last >= 0]] = False
    return np.flatnonzero(flags & ~before), np.flatnonzero(flags & ~after) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes at a time."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    words = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    size = ends - starts
    h = mix((words[starts] & _MASK[np.minimum(size, 8)]) * _ODD
            + size.astype(np.uint64) + np.uint64(seed))
    k, more = 8, np.flatnonzero(size > 8)
    while len(more):
        part = words[starts[more] + k] & _MASK[np.minimum(size[more] - k, 8)]
        h[more] = mix((h[more] ^ part) * _ODD + np.uint64(k))
        k += 8
        more = more[size[more] > k]
    return h


@dataclass
class Words:
    """Words of the documents ``first`` .. ``first + len(bounds) - 1`` of a batch."""
    first: int
    data: np.ndarray        # the block's bytes (lower-cased if asked for)
    offsets: np.ndarray     # byte offset of each document in data, and the end
    starts: np.ndarray      # byte span of each word
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray      # index of each document's first word, and the end

    @property
    def docs(self) -> int:
        return len(self.bounds) - 1

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.docs), np.diff(self.bounds))


def byte_blocks(off: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``limit`` bytes; a longer one stands alone."""
    d, n = 0, len(off) - 1
    while d < n:
        e = max(d + 1, int(np.searchsorted(off, off[d] + limit, side="right")) - 1)
        yield d, min(e, n)
        d = min(e, n)


def scan(column: pa.Array, lower: bool = False, limit: int = BLOCK_BYTES,
         is_word: np.ndarray = _IS_WORD) -> Iterator[Words]:
    """The words of every document of a column, block by block."""
    buf, off = text_buffers(column)
    for d, e in byte_blocks(off, limit):
        data, own = buf[off[d]:off[e]], off[d:e + 1] - off[d]
        if lower:
            data = _LOWER[data]
        starts, ends = spans(is_word[data], own)
        yield Words(d, data, own, starts, ends, span_hashes(data, starts, ends),
                    np.searchsorted(starts, own))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Order-sensitive hash of each run of k words (document borders ignored)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    s = np.zeros(n, np.uint64)
    for i in range(k):
        s = (s + h[i:i + n]) * _ODD
    return mix(s)


def whole_grams(bounds: np.ndarray, k: int) -> np.ndarray:
    """For each word position with k - 1 successors in the array, whether all are in one document."""
    n = int(bounds[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return doc[:n] == doc[k - 1:]


def sequence_keys(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each document's sequence of hashes (128 bits in all)."""
    place = (np.arange(int(bounds[-1]))
             - np.repeat(bounds[:-1], np.diff(bounds))).astype(np.uint64)
    keys = []
    for seed in (0x243F6A8885A308D3, 0x13198A2E03707344):
        each = mix(h * np.uint64(seed | 1) ^ mix(place * _ODD + np.uint64(seed)))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each, dtype=np.uint64)])
        size = np.diff(bounds).astype(np.uint64)
        keys.append(mix(total[bounds[1:]] - total[bounds[:-1]] + size * _ODD))
    return keys[0], keys[1]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenation of arange(s, s + n) over all pairs."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return np.repeat(starts - shift, sizes) + np.arange(total)
