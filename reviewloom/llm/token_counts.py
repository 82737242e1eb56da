"""Token counts of a byte-level BPE vocabulary without building the tokens.

Method: rank-synchronous merging. The pre-tokens of a piece of the corpus that were not met before are held
as one ragged array of symbols. In each round every sequence finds its pair of lowest rank and merges all
places of that pair at once; a sequence without a pair leaves with the number of its symbols.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows give repeated results; an
empty table gives an empty result; other columns of the input are not looked at. Very long texts and very
long pre-tokens are whole, work per round is proportional to the symbols still in play. Memory in a task is
a piece of text (words.PIECE, or one longer text) and at most MEMO counts of pre-tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from reviewloom.llm.shipping import ship, small_batches
from reviewloom.llm.words import pieces

#: counts of distinct pre-tokens that a task remembers; beyond, it forgets all and goes on
MEMO = 300_000

#: Fixed value: the published pattern that splits text before byte-level merges
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary files (published rule of byte-level BPE)."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(extra)
            extra += 1
    return [letters[b] for b in range(256)]


class Merges:
    """Ids of the bytes and the merges of a vocabulary, as an open hash table in arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, model = spec["model"]["vocab"], spec["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.bytes = np.array([vocab[c] for c in byte_letters()], np.int64)
        self.bits = max(8, int(4 * len(pairs)).bit_length())
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        self.made = np.zeros(1 << self.bits, np.int64)
        slots = self._slots(keys)
        for rank, (key, slot, (a, b)) in enumerate(zip(keys.tolist(), slots.tolist(), pairs)):
            while self.keys[slot] not in (-1, key):
                slot = (slot + 1) & ((1 << self.bits) - 1)
            if self.keys[slot] == -1:
                self.keys[slot], self.ranks[slot], self.made[slot] = key, rank, vocab[a + b]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair, or -1."""
        keys = left << 32 | right
        slots, out = self._slots(keys), np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            found = self.keys[slots[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = slots[todo[hit]]
            todo = todo[~hit & (found != -1)]
            slots[todo] = (slots[todo] + 1) & ((1 << self.bits) - 1)
        return out


def count_symbols(tokens: list[bytes], merges: Merges) -> np.ndarray:
    """How many symbols are left of each (non-empty) byte string."""
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    out = np.zeros(len(tokens), np.int64)
    symbols = merges.bytes[np.frombuffer(b"".join(tokens), np.uint8)]
    owner = np.repeat(np.arange(len(tokens)), lengths)  # the sequence of each symbol
    slots = np.full(len(symbols), -1, np.int64)  # of the pair that begins at each symbol
    inner = np.flatnonzero(owner[:-1] == owner[1:])
    slots[inner] = merges.find(symbols[inner], symbols[inner + 1])
    while len(symbols):
        ranks = np.where(slots >= 0, merges.ranks[slots], NONE)
        starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        sizes = np.diff(np.append(starts, len(owner)))
        lowest = np.minimum.reduceat(ranks, starts)
        done = lowest == NONE
        out[owner[starts[done]]] = sizes[done]
        low = np.repeat(lowest, sizes)
        hit = (ranks == low) & (low != NONE)
        # runs of hits are runs of one symbol: every other pair of a run merges, from the left
        at = np.arange(len(hit))
        begins = hit & ~np.concatenate(([False], hit[:-1]))
        run = np.maximum.accumulate(np.where(begins, at, -1))
        hit &= (at - run) % 2 == 0
        symbols[hit] = merges.made[slots[hit]]
        stay = np.repeat(~done, sizes)
        stay[1:] &= ~hit[:-1]
        place = np.cumsum(stay) - 1
        changed = place[hit]
        symbols, owner, slots = symbols[stay], owner[stay], slots[stay]
        slots[changed] = -1
        before = changed[changed > 0] - 1
        anew = np.unique(np.concatenate([changed, before]))
        anew = anew[anew + 1 < len(owner)]
        anew = anew[owner[anew] == owner[anew + 1]]
        slots[anew] = merges.find(symbols[anew], symbols[anew + 1])
    return out


class Counter:
    """Counts tokens of texts, with a bounded memory of pre-tokens."""

    def __init__(self, merges: Merges, memo: int = MEMO):
        self.merges, self.memo, self.known = merges, memo, {}
        self.split = regex.compile(PATTERN)
        special = "|".join(regex.escape(s) for s in sorted(merges.special, key=len, reverse=True))
        self.cut = regex.compile(special) if special else None

    def counts(self, texts: list[str]) -> list[int]:
        parts: list[list[str]] = []
        extra: list[int] = []
        for text in texts:
            pieces = self.cut.split(text) if self.cut else [text]
            found = self.split.findall(pieces[0])
            for piece in pieces[1:]:
                found += self.split.findall(piece)
            parts.append(found)
            extra.append(len(pieces) - 1)
        if len(self.known) > self.memo:
            self.known.clear()
        new = set().union(*parts).difference(self.known)
        if new:
            new = list(new)
            self.known.update(zip(new, count_symbols([t.encode() for t in new], self.merges).tolist()))
        known = self.known.__getitem__
        return [sum(map(known, found)) + more for found, more in zip(parts, extra)]


def token_counts(
    docs: DataFrame, path: str, text: str = "text", id: str = "doc_id", limit: int = 1024
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row; `path` names a byte-level BPE file (.json).

    The driver reads the file once and broadcasts its tables (some MB, fixed by the vocabulary).
    """
    small_batches(docs.sparkSession)
    merges = ship(docs.sparkSession, Merges(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(merges())
        for piece in pieces(batches, "text"):
            tokens = counter.counts(piece.column("text").fill_null("").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), piece.column("n_bytes"), pa.array(tokens, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    rows = docs.select(
        F.col(id).alias("id"), F.col(text).alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    kind = dict(docs.select(id).dtypes)[id]
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
