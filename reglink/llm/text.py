"""Word kernels over Arrow text columns, shared by the operators of ``llm``.

A batch of texts is one byte buffer plus offsets, so words, word hashes and
the hashes of word windows are array operations over the whole batch instead
of Python loops over words. Batches are cut into slices of a bounded number
of bytes first, so the working arrays stay small however many rows Arrow
hands over; one very long text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
# Odd multipliers of the two independent polynomial word hashes.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_U = np.uint64

_bytes = np.arange(256)
# Words [^\x20\x09-\x0D]+ : everything but the six ASCII white-space bytes.
PLAIN = ~np.isin(_bytes, (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D))
# Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z is lower-cased: ASCII digits
# and letters and every byte of a non-ASCII character.
ALNUM = (_bytes >= 0x80) | ((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes >= 0x61) & (_bytes <= 0x7A))
FOLD = _bytes.astype(np.uint8)
FOLD[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element-wise."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        have = np.ones(size, _U)
        have[1:] = _U(base)
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


@dataclass
class Words:
    """The words of a slice of texts: byte ``starts`` and ``ends`` in ``data``
    (folded when asked for; ``inside`` marks the bytes of words); text ``i`` has the words ``first[i]:first[i+1]``
    and the bytes ``offsets[i]:offsets[i+1]``."""

    data: np.ndarray
    inside: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def joined(self, a: int, b: int) -> bytes:
        """Words a..b-1 joined by one space."""
        return b" ".join(self.word(i) for i in range(a, b))

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.starts):
            return np.empty(0, _U)
        length = self.ends - self.starts
        begin = np.cumsum(length) - length
        place = np.arange(int(length.sum()), dtype=np.int32) - np.repeat(begin.astype(np.int32), length)
        value = powers(BASES[which], int(length.max()))[place]
        value *= self.data[self.inside].astype(_U) + _U(1)
        sums = np.add.reduceat(value, begin)
        return mix(sums + length.astype(_U) * _U(0xA0761D6478BD642F))


def find_words(column: pa.Array, kind: np.ndarray, fold: bool) -> Words:
    """Words of a string array; null counts as the empty text."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, off, buf = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(buf, np.uint8) if buf is not None else np.empty(0, np.uint8)
    data = raw[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    if fold:
        data = FOLD[data]
    inside = kind[data]
    # A text's first byte starts a word whatever ends the text before it.
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    gap = np.ones(len(data) + 1, bool)
    gap[1:] = ~inside
    starts = np.flatnonzero(inside & (gap[:-1] | cut[:-1]))
    gap[:-1], gap[-1] = ~inside, True
    ends = np.flatnonzero(inside & (gap[1:] | cut[1:])) + 1
    return Words(data, inside, offsets, starts, ends, np.searchsorted(starts, offsets))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive pieces of about ``limit`` bytes of text, at
    least one row each."""
    text = batch.column(column)
    if not len(text):
        return
    if not pa.types.is_large_string(text.type):
        text = text.cast(pa.large_string())
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset + 1:text.offset + len(text) + 1]
    begin, base = 0, int(np.frombuffer(text.buffers()[1], np.int64)[text.offset])
    while begin < len(text):
        stop = max(begin + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(begin, stop - begin)
        begin, base = stop, int(ends[stop - 1])


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes (over the whole
    slice: the caller drops runs that cross texts)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, _U)
    total = np.zeros(n, _U)
    step = powers(0x2545F4914F6CDD1D, size)
    if size <= 6:
        for j in range(size):
            total += words[j:j + n] * step[j]
    else:
        # Prefix sums of w[i]*c^i; c is odd, so dividing by c^i is a product.
        c = powers(0x2545F4914F6CDD1D, len(words))
        prefix = np.zeros(len(words) + 1, _U)
        np.cumsum(words * c, out=prefix[1:])
        inverse = pow(0x2545F4914F6CDD1D, -1, 1 << 64)
        total = (prefix[size:] - prefix[:n]) * powers(inverse, n)
    return mix(total + _U(size))


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Mask over ``window_hashes``: which runs lie within one text."""
    total = int(first[-1])
    n = max(0, total - size + 1)
    inside = np.ones(n, bool)
    for end in first[1:-1]:
        inside[max(0, end - size + 1):min(n, end)] = False
    return inside


def covered(n_words: int, starts: np.ndarray, size) -> np.ndarray:
    """Mask of the words inside the windows [start, start + size)."""
    edge = np.zeros(n_words + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.subtract.at(edge, starts + size, 1)
    return np.cumsum(edge[:-1]) > 0
