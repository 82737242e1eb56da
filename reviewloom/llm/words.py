"""Words of whole texts as numpy arrays: places in the UTF-8 bytes and a 64-bit digest of each word.

Two kinds of words, both after lower-casing A-Z: `alnum` is [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ and `blank`
is [^\\x20\\x09-\\x0D]+. All bytes above 0x7F belong to words of either kind, so bytes can be looked at one
by one. Two words count as equal if their digests are: of a polynomial in 64 bits, mixed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: texts are worked on in pieces of about so many bytes (one text at least)
PIECE = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
BLANK = np.ones(256, bool)
BLANK[32] = BLANK[9:14] = False
KINDS = {"alnum": ALNUM, "blank": BLANK}

BASE = 0x9E3779B97F4A7C15
BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values (the finalizer of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the n + 1 offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


class Words:
    """starts, ends: places of the words in `data` (lower-cased); first[i]:first[i + 1] are those of text i."""

    def __init__(self, texts: pa.Array, kind: str):
        data, self.offsets = raw(texts)
        self.data = LOWER[data]
        self.inside = KINDS[kind][self.data]
        n = len(self.data)
        before = np.zeros(n + 1, bool)
        before[1:] = self.inside
        after = np.zeros(n + 1, bool)
        after[:-1] = self.inside
        before[self.offsets] = False
        after[self.offsets] = False
        self.starts = np.flatnonzero(self.inside & ~before[:-1])
        self.ends = np.flatnonzero(self.inside & ~after[1:]) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def digests(self) -> np.ndarray:
        """One per word."""
        return span_digests(self.data, self.starts, self.ends)


def span_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """A digest of data[start:end] for rising, disjoint spans; summed in pieces, so that much data needs little more
    memory than PIECE bytes."""
    out, back = np.empty(len(starts), np.uint64), pow(base, -1, 1 << 64)
    at, up, down = 0, powers(base, 1), powers(back, 1)
    while at < len(starts):
        begin = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, begin + PIECE, "right")))
        n = int(ends[to - 1] - begin)
        if n > len(up):
            up, down = powers(base, n), powers(back, n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE[data[begin:begin + n]] * up[:n], out=total[1:])
        s, e = starts[at:to] - begin, ends[at:to] - begin
        out[at:to] = (total[e] - total[s]) * down[np.minimum(s, len(down) - 1)]
        at = to
    return mix(out)


def text_digests(texts: pa.Array, base: int = BASE) -> np.ndarray:
    """A digest of each whole string, case kept."""
    data, offsets = raw(texts)
    return span_digests(data, offsets[:-1], offsets[1:], base)


def digest_of(words: Iterable[str], kind: str = "alnum") -> np.ndarray:
    """Digests of single words (each must be one word of the kind)."""
    return Words(pa.array(list(words), pa.string()), kind).digests()


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in order, in slices of about `limit` bytes of the text column, one row at least."""
    for batch in batches:
        _, offsets = raw(batch.column(column))
        at = 0
        while at < len(offsets) - 1:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
