"""Vectorised text kernels: words, lines and n-gram hashes of Arrow string batches.

A batch is cut into chunks of whole documents of about ``CHUNK_BYTES`` (one document at least), so
that the numpy temporaries stay small whatever the batch holds. Words are found on the UTF-8
bytes: every separator in use is ASCII, so a multi-byte character never splits. A word's hash is
a polynomial in its bytes modulo 2**64, put through a finalising mix together with its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0xD6E8FEB86659FD93)

_ALL = np.arange(256)
#: Words between ASCII white space: space and U+0009 to U+000D.
NOT_SPACE = ~np.isin(_ALL, [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
#: Words of ASCII letters, digits and everything beyond ASCII.
ALNUM = (_ALL >= 0x80) | ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x41) & (_ALL <= 0x5A)) | ((_ALL >= 0x61) & (_ALL <= 0x7A))
AS_IS = _ALL.astype(np.uint64) + np.uint64(1)
#: Byte values with A-Z lower-cased.
LOWER = np.where((_ALL >= 0x41) & (_ALL <= 0x5A), _ALL + 32, _ALL).astype(np.uint64) + np.uint64(1)

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (the public splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, CHUNK_BYTES * 2)
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


class Chunk:
    """Some whole documents: ``data`` their bytes, ``offsets`` where each begins (and the last ends)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first
        self.n_docs = len(offsets) - 1

    def spans(self, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends (byte positions) of the words, and each document's first word number (and the end)."""
        inside = is_word[self.data]
        edge = np.empty(len(inside) + 1, bool)
        edge[0] = edge[-1] = True
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[self.offsets] = True
        at = np.flatnonzero(edge)
        begin = at[:-1][inside[at[:-1]]] if len(inside) else at[:0]
        end = at[1:][inside[at[:-1]]] if len(inside) else at[:0]
        return begin, end, np.searchsorted(begin, self.offsets)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the lines between ``\\n``; an empty document has one empty line."""
        cut = np.flatnonzero(self.data == 0x0A)
        starts = np.concatenate([self.offsets[:-1], cut + 1])
        ends = np.concatenate([cut, self.offsets[1:]])
        doc = np.concatenate([np.arange(self.n_docs), np.searchsorted(self.offsets, cut, "right") - 1])
        order = np.lexsort((starts, doc))
        starts = starts[order]
        ends = ends[np.lexsort((ends, np.concatenate([np.searchsorted(self.offsets, cut, "right") - 1, np.arange(self.n_docs)])))]
        return starts, ends, np.searchsorted(doc[order], np.arange(self.n_docs + 1))

    def hashes(self, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each byte span, with bytes mapped through ``values``."""
        power, inverse = _powers_to(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(values[self.data] * power[: len(self.data)], out=total[1:])
        return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _STEP)


def chunks(texts: pa.Array | pa.ChunkedArray) -> Iterator[Chunk]:
    """The documents of a string column, nulls as empty texts, in order."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if len(texts) == 0:
        return
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        yield Chunk(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at)
        at = to


def ngrams(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows inside documents, and the word number at which each begins."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = words[:count].copy()
    for j in range(1, n):
        total *= _STEP
        total += words[j : j + count]
    whole = np.ones(count, bool)
    for j in range(1, n):  # a window that begins less than n words before a document's end runs over it
        late = first[1:] - j
        whole[late[(late >= 0) & (late < count)]] = False
    short = np.flatnonzero(np.diff(first) < n)
    for d in short:
        whole[first[d] : min(first[d + 1], count)] = False
    return mix(total[whole]), np.flatnonzero(whole)


_letters: list[np.ndarray] = []


def letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter, and its lower case where that is one code point."""
    if not _letters:
        points = [chr(c) for c in range(0x110000)]
        _letters.append(np.fromiter((c.isalpha() for c in points), bool, len(points)))
        _letters.append(np.fromiter((ord(x) if len(x := c.lower()) == 1 else ord(c) for c in points), np.int64, len(points)))
    return _letters[0], _letters[1]


def code_points(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """All code points of a chunk, and each document's first one (and the end)."""
    begins = np.cumsum(np.concatenate([[0], (chunk.data & 0xC0) != 0x80]))[chunk.offsets]
    return np.frombuffer(chunk.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64), begins


def sequence_hash(words: np.ndarray) -> np.uint64:
    """The hash of one word sequence: that of :func:`ngrams` for a window of its length."""
    total = np.zeros(1, np.uint64)
    for w in words:
        total = total * _STEP + w
    return mix(total)[0]


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between successive positions of ``first``."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def common(a: pa.Array, b: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of sets (distinct values of ``kind``, as bytes): values in both, and the sizes' sum."""

    def flat(x: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        _, off, data = x.buffers()
        offsets = np.frombuffer(off, np.int64 if pa.types.is_large_binary(x.type) else np.int32)[x.offset : x.offset + len(x) + 1].astype(np.int64)
        values = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind) if data is not None else np.zeros(0, kind)
        return values, np.diff(offsets) // np.dtype(kind).itemsize

    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    (x, n), (y, m) = flat(a), flat(b)
    pair = np.concatenate([np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(m)), m)])
    values = np.concatenate([x, y])
    if np.dtype(kind).itemsize == 4:
        both = pair.astype(np.uint64) << np.uint64(32) | values
        both.sort()
        again = (both[1:][both[1:] == both[:-1]] >> np.uint64(32)).astype(np.int64)
    else:
        order = np.lexsort((values, pair))
        values, pair = values[order], pair[order]
        again = pair[1:][(values[1:] == values[:-1]) & (pair[1:] == pair[:-1])]
    return np.bincount(again, minlength=len(n)), n + m
