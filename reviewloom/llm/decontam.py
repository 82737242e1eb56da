"""Benchmark decontamination with suffix arrays of the training documents.

Method: every piece of the corpus is a shard. A shard's words become numbers of the benchmark's vocabulary
(0 for any other word, and between documents), the places of known words are sorted into a suffix array,
and each window of the benchmark is binary-searched in it. The range found holds all locations of the
window; from the locations whose left neighbours differ, the longest verbatim matches are read off.
A shard's documents lie in one task, so no text and no match is shuffled.

Windows: `window` consecutive words of an item; an item of fewer words, but not none, is one window.

Defined results: null or wordless texts have no words and no hits; null or wordless items have no windows;
an item without an id hits words but is not listed; repeated rows give repeated results; empty tables of
documents give empty results, an empty benchmark hits nothing; further columns are passed on or left out,
whatever their names. Texts are looked at whole.

Size: the benchmark reaches the tasks in blocks of at most `block_bytes` of text (one item at least), one
pass over the documents for each block, hits carried from pass to pass. A task holds one block and one
shard at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from reviewloom.llm.shipping import ship, small_batches
from reviewloom.llm.words import Words, pieces

#: words of a window
WINDOW = 10
#: benchmark text that is broadcast at once
BLOCK_BYTES = 16 << 20


def packed(ids: np.ndarray, bits: int, words: int) -> np.ndarray:
    """For each place the next `words` numbers in one integer; what follows a 0 counts as 0."""
    out = ids.astype(np.int64)
    alive = ids > 0
    ahead = ids
    for _ in range(words - 1):
        ahead = np.append(ahead[1:], 0)
        alive = alive & (ahead > 0)
        out = (out << bits) | np.where(alive, ahead, 0)
    return out


def suffix_array(ids: np.ndarray, keys: np.ndarray, words: int, depth: int) -> np.ndarray:
    """Places of non-zero numbers, sorted by the up to `depth` numbers from there on (a 0 ends a suffix).

    `keys` are the first `words` numbers packed; what they leave equal is sorted by prefix doubling, of which
    only the groups that are still equal take part.
    """
    places = np.flatnonzero(ids > 0)
    order = places[np.argsort(keys[places], kind="stable")]
    rank = np.zeros(len(ids) + 1, np.int64)  # 1 + first index of the group of equal prefixes
    sorted_keys = keys[order]
    new = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
    group = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    rank[order] = group + 1
    done = words
    open_at = np.flatnonzero(~(new & np.append(new[1:], True)))  # indexes in groups of two or more
    while done < depth and len(open_at):
        at = order[open_at]
        ahead = rank[np.minimum(at + done, len(ids))]
        old = rank[at]
        sub = np.lexsort((ahead, old))
        at, ahead, old = at[sub], ahead[sub], old[sub]
        order[open_at] = at
        new = np.concatenate(([True], (old[1:] != old[:-1]) | (ahead[1:] != ahead[:-1])))
        group = np.maximum.accumulate(np.where(new, open_at, 0))
        rank[at] = group + 1
        open_at = open_at[~(new & np.append(new[1:], True))]
        done *= 2
    return order


class Block:
    """Items of a benchmark block: vocabulary, windows and the places of the windows in the items."""

    def __init__(self, rows: list[tuple[str | None, str | None]], window: int):
        words = Words(pa.array([text for _, text in rows], pa.string()), "alnum")
        digests = words.digests()
        self.names = [name for name, _ in rows]
        self.vocabulary, numbers = np.unique(digests, return_inverse=True)
        counts = words.counts()
        # items in a row with a 0 behind each
        self.ids = np.zeros(len(digests) + len(rows) + 1, np.int64)
        owner = np.repeat(np.arange(len(rows)), counts)
        self.ids[np.arange(len(digests)) + owner] = numbers + 1
        self.depth = max([window, *counts.tolist()])
        self.bits = max(1, int(len(self.vocabulary)).bit_length())
        self.packed = max(1, 62 // self.bits)
        starts, lengths, items = [], [], []
        first = words.first[:-1] + np.arange(len(rows))
        for item, (begin, n) in enumerate(zip(first.tolist(), counts.tolist())):
            if n:
                size = min(n, window)
                starts.append(np.arange(begin, begin + n - size + 1))
                lengths.append(np.full(n - size + 1, size))
                items.append(np.full(n - size + 1, item))
        self.window = window
        starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.lengths = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
        self.items = np.concatenate(items) if items else np.zeros(0, np.int64)
        self.starts = starts
        # equal windows are searched once
        grid = np.where(np.arange(window) < self.lengths[:, None], self.ids[np.minimum(starts[:, None] + np.arange(window), len(self.ids) - 1)], 0)
        self.grid, self.kind = np.unique(grid, axis=0, return_inverse=True) if len(grid) else (grid, np.zeros(0, np.int64))
        self.kind = self.kind.reshape(-1)
        self.size = (self.grid > 0).sum(axis=1)
        by_kind = np.argsort(self.kind, kind="stable")
        self.by_kind = by_kind  # windows grouped by kind
        self.kind_first = np.searchsorted(self.kind[by_kind], np.arange(len(self.grid) + 1))

    def numbers(self, digests: np.ndarray) -> np.ndarray:
        """Vocabulary numbers from 1; 0 for words that are in no item."""
        if not len(self.vocabulary):
            return np.zeros(len(digests), np.int64)
        at = np.searchsorted(self.vocabulary, digests)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == digests, at + 1, 0)


def ranges(block: Block, order: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each distinct window the range of the suffix array whose suffixes begin with it, by binary search."""
    n = block.packed
    low, high = np.zeros(len(block.grid), np.int64), np.full(len(block.grid), len(order), np.int64)
    for step in range(0, block.window, n):
        todo = np.flatnonzero((block.size > step) & (low < high))
        want = np.zeros(len(todo), np.int64)
        room = np.zeros(len(todo), np.int64)  # words of the packed integer that the window does not name
        for j in range(n):
            word = block.grid[todo, step + j] if step + j < block.window else np.zeros(len(todo), np.int64)
            want = (want << block.bits) | word
            room += word == 0
        top = want + (np.int64(1) << (room * block.bits)) - 1
        bounds = []
        for limit, after in ((want, False), (top, True)):
            lo, hi = low[todo].copy(), high[todo].copy()
            while (go := lo < hi).any():
                mid = (lo + hi) // 2
                value = keys[np.minimum(order[np.minimum(mid, len(order) - 1)] + step, len(keys) - 1)]
                right = go & ((value <= limit) if after else (value < limit))
                lo = np.where(right, mid + 1, lo)
                hi = np.where(go & ~right, mid, hi)
            bounds.append(lo)
        low[todo], high[todo] = bounds
    return low, high


def search(texts: pa.Array, block: Block) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts, hit mask of the words, pairs (text, item) that meet, longest match of each text."""
    words = Words(texts, "alnum")
    n_docs = len(texts)
    owner = np.repeat(np.arange(n_docs), words.counts())
    ids = np.zeros(len(words) + n_docs + 1, np.int64)
    ids[np.arange(len(words)) + owner] = block.numbers(words.digests())
    mask = np.zeros(len(words), bool)
    longest = np.zeros(n_docs, np.int64)
    none = np.zeros(0, np.int64)
    if not len(block.grid) or not ids.any():
        return words, mask, none, none, longest
    keys = packed(ids, block.bits, block.packed)
    order = suffix_array(ids, keys, block.packed, block.depth)
    low, high = ranges(block, order, keys)
    found = np.flatnonzero(low < high)
    if not len(found):
        return words, mask, none, none, longest
    times = high[found] - low[found]
    kind = np.repeat(found, times)
    at = order[np.repeat(low[found], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
    begins = words.first + np.arange(n_docs + 1)  # of the documents in ids
    doc = np.searchsorted(begins, at, "right") - 1
    steps = np.bincount(at, minlength=len(ids) + 1) - np.bincount(at + block.size[kind], minlength=len(ids) + 1)
    mask = (np.cumsum(steps) > 0)[np.arange(len(words)) + owner]
    # items: each (document, window) once, then the items that hold the window
    pair = np.unique(doc * len(block.grid) + kind)
    pair_doc, pair_kind = pair // len(block.grid), pair % len(block.grid)
    many = block.kind_first[pair_kind + 1] - block.kind_first[pair_kind]
    begin = np.repeat(block.kind_first[pair_kind] - (np.cumsum(many) - many), many)
    item = block.items[block.by_kind[begin + np.arange(many.sum())]]
    both = np.unique(np.repeat(pair_doc, many) * len(block.names) + item)
    # the longest match: from every location, as far as document and item agree, for one item place of the
    # window at a time; only matches that cannot be prolonged to the left are followed
    deepest = int((block.kind_first[1:] - block.kind_first[:-1])[found].max())
    for turn in range(deepest):
        use = block.kind_first[kind] + turn < block.kind_first[kind + 1]
        here, there = at[use], block.starts[block.by_kind[block.kind_first[kind[use]] + turn]]
        before = np.where(here > 0, ids[here - 1], 0)
        left = (before == 0) | (there == 0) | (block.ids[np.maximum(there - 1, 0)] != before)
        here, there, its = here[left], there[left], doc[use][left]
        length = block.size[kind[use][left]].copy()
        go = np.arange(len(here))
        while len(go):
            a, b = here[go] + length[go], there[go] + length[go]
            same = (ids[np.minimum(a, len(ids) - 1)] == block.ids[np.minimum(b, len(block.ids) - 1)]) & (ids[np.minimum(a, len(ids) - 1)] > 0)
            go = go[same]
            length[go] += 1
        np.maximum.at(longest, its, length)
    return words, mask, both // len(block.names), both % len(block.names), longest


def benchmark_blocks(benchmark: DataFrame, text: str, item: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks of about block_bytes, brought to the driver one block at a time."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // block_bytes) or 1
    for number in range(count):
        part = items if count == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == number)
        yield [(r["item"], r["text"]) for r in part.collect()]


def suffix_matches(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", bench_text: str = "text", item: str = "item_id",
    keep: list[str] | None = None, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every document as two columns: row, a struct of the kept columns, and match, one of n_words, n_hit, longest, items.

    n_hit counts the words inside any location of any window, longest is the length in words of the longest
    verbatim match that holds a window, items are the ids of the items with occurring windows (distinct).
    """
    spark = docs.sparkSession
    small_batches(spark)
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text"))
    state = "n_words long, n_hit long, longest long, items array<string>, hit binary"
    frame = rows.withColumn("match", F.lit(None).cast(f"struct<{state.replace(' ', ':').replace(',:', ',')}>"))
    blocks = list(ship(spark, Block(b, window)) for b in benchmark_blocks(benchmark, bench_text, item, block_bytes))
    schema = T.StructType([f for f in frame.schema if f.name != "text"])

    for number, block in enumerate(blocks):
        last = number == len(blocks) - 1

        def scan(batches: Iterator[pa.RecordBatch], block=block, last=last) -> Iterator[pa.RecordBatch]:
            own = block()
            for piece in pieces(batches, "text"):
                words, mask, doc, item, longest = search(piece.column("text"), own)
                names: list[list[str]] = [[] for _ in range(len(piece))]
                for d, i in zip(doc.tolist(), item.tolist()):
                    if own.names[i] is not None:
                        names[d].append(own.names[i])
                masks = [mask[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
                for i, old in enumerate(piece.column("match").to_pylist()):
                    if old is not None:
                        masks[i] = masks[i] | np.unpackbits(np.frombuffer(old["hit"], np.uint8), count=len(masks[i])).astype(bool)
                        names[i] += old["items"]
                        longest[i] = max(longest[i], old["longest"])
                match = pa.StructArray.from_arrays(
                    [
                        pa.array(words.counts(), pa.int64()), pa.array([int(m.sum()) for m in masks], pa.int64()),
                        pa.array(longest, pa.int64()), pa.array([sorted(set(n)) for n in names], pa.list_(pa.string())),
                        pa.array([None if last else np.packbits(m).tobytes() for m in masks], pa.binary()),
                    ],
                    ["n_words", "n_hit", "longest", "items", "hit"],
                )
                out, cols = [piece.column("row"), match], ["row", "match"]
                yield pa.RecordBatch.from_arrays(out + ([] if last else [piece.column("text")]), cols + ([] if last else ["text"]))

        shape = schema if last else T.StructType([*schema, T.StructField("text", T.StringType())])
        frame = frame.mapInArrow(scan, shape)
    return frame.select("row", F.col("match").dropFields("hit").alias("match"))


def contamination(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and longest of every document."""
    found = suffix_matches(docs, benchmark, keep=[id], **options)
    items = F.array_sort("match.items")
    return found.select(
        F.col("row")[id].alias(id), "match.n_words", "match.n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("match.n_hit") > 0).alias("contaminated"), "match.longest",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any word inside a window of the benchmark, all columns as they were."""
    found = suffix_matches(docs, benchmark, **options)
    return found.where(F.col("match.n_hit") == 0).select("row.*")
