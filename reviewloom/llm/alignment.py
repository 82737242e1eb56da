"""Alignment of two tokenizers over a corpus: which tokens of one meet which of the other, and in how many documents.

Method: minimal perfect hashing of the distinct pairs. A first pass encodes every text with both tokenizers and links the
tokens whose byte ranges overlap; a task sends each id pair with its number of documents in what it read. The distinct
pairs are dealt over shards, each shard gets a minimal perfect hash: levels of bit arrays, where a pair stays in the first
level in which it meets no other, numbered by the bits set before its own. The hash numbers the pairs of a block of
shards; tasks add their counts to dense vectors by that number, the vectors are summed in a tree of FAN at a time. A
second pass aligns the documents again and looks up their links' counts. Each shard keeps its pairs in hash order, so
every look-up is verified, and a pair that is not there is an error.

A is a byte-level BPE (.json), encoded by tiktoken from the ids and pattern of that file, which is the same function (runs of
BLANK_RUN blanks, which tiktoken cannot take, go to the tokenizers library); B is a sentencepiece model. Both files
are read on the driver and broadcast; their size is that of the vocabularies.

Links: both sides cover the same bytes, so every stretch between neighbouring token ends, of either side, is one link, and
there are fewer links than tokens. Places where both end cut the tokens into groups.

Memory: a task holds a piece of text with its tokens, PAIRS pairs before it sends them, and one block: BLOCK pairs of 16
bytes and half a byte of hash. One block is broadcast at a time; with more pairs than a block, further blocks are counted
and looked up in further passes, whose sums are added. The best counts by id of A are one number per vocabulary entry.

Defined results: texts that are null or empty, or that the tokens of either side don't spell, have no tokens: zeros and an
empty string; each row counts as a document, repeated rows repeat; an empty table gives an empty result; other
columns don't matter. Texts are whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from reviewloom.llm.components import runs
from reviewloom.llm.shipping import ship
from reviewloom.llm.token_counts import PATTERN, byte_letters
from reviewloom.llm.words import mix, pieces
from reviewloom.session import cut_lineage

#: pairs of a shard; of a block; that a task gathers before it sends them; vectors that one task of the tree sums
SHARD, BLOCK, PAIRS, FAN = 1 << 16, 1 << 23, 1 << 21, 16
BLANK_RUN = 100_000
NO_IDS = np.zeros(0, np.int32)


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        with open(a_path, encoding="utf-8") as file:
            self.a_json = file.read()
        with open(b_path, "rb") as file:
            self.b_model = file.read()
        spec = json.loads(self.a_json)
        special = {t["content"] for t in spec["added_tokens"]}
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        self.ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        made = [spec["model"]["vocab"][m.replace(" ", "", 1)] for m in merges]
        if made != sorted(made):
            raise ValueError("ids must rise in the order of merges")
        self.start()

    def start(self) -> None:
        import sentencepiece
        import tiktoken

        self.a = tiktoken.Encoding("pairs", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=self.b_model)
        a_bytes: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            a_bytes[i] = token
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        self.a_size, self.b_size = len(a_bytes), len(self.b_bytes)
        self.a_lengths = np.array(list(map(len, a_bytes)), np.int64)
        self.b_lengths = np.array(list(map(len, self.b_bytes)), np.int64)

    def __getstate__(self) -> dict:
        return {"a_json": self.a_json, "b_model": self.b_model, "ranks": self.ranks}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.start()

    def encode_a(self, text: str) -> np.ndarray:
        if len(text) > BLANK_RUN and re.search(rf"\s{{{BLANK_RUN}}}", text):
            import tokenizers

            library = tokenizers.Tokenizer.from_str(self.a_json)
            library.encode_special_tokens = True
            return np.array(library.encode(text, add_special_tokens=False).ids, np.int32)
        return np.array(self.a.encode_ordinary(text), np.int32)

    def encode_b(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; empty where the tokens don't spell a blank and the text."""
        out, spell = self.b.encode(texts, num_threads=1), self.b_bytes.__getitem__
        return [np.array(ids if b"".join(map(spell, ids)) == b" " + t.encode() else [], np.int32) for ids, t in zip(out, texts)]


class Aligned:
    """Tokens and links of a piece of texts. a_ids, b_ids: tokens of all texts in a row; a_first, b_first, l_first:
    bounds of each text's; link_a, link_b: places in a_ids and b_ids."""

    def __init__(self, texts: list[str | None], tokenizers: Tokenizers):
        here = [i for i, t in enumerate(texts) if t]
        b = dict(zip(here, tokenizers.encode_b([texts[i] for i in here])))
        a = {i: tokenizers.encode_a(" " + texts[i]) for i in here if len(b[i])}
        self.a_ids, self.a_first = flat([a.get(i, NO_IDS) for i in range(len(texts))])
        self.b_ids, self.b_first = flat([b.get(i, NO_IDS) for i in range(len(texts))])
        a_ends, b_ends = np.cumsum(tokenizers.a_lengths[self.a_ids]), np.cumsum(tokenizers.b_lengths[self.b_ids])
        # a mark at the last byte of each token; a link ends at each marked byte
        a_marks, b_marks = np.zeros((2, a_ends[-1] if len(a_ends) else 0), np.uint8)
        a_marks[a_ends - 1] = b_marks[b_ends - 1] = 1
        ends = np.flatnonzero(a_marks | b_marks)
        a_here, b_here = a_marks[ends], b_marks[ends]
        self.link_a, self.link_b = np.cumsum(a_here, dtype=np.int64) - a_here, np.cumsum(b_here, dtype=np.int64) - b_here
        #: links after which both tokens end
        self.cuts = (a_here & b_here).astype(bool)
        self.l_first = np.searchsorted(ends, np.append(0, a_ends)[self.a_first])
        self.codes = self.a_ids[self.link_a] * tokenizers.b_size + self.b_ids[self.link_b]

    def owners(self) -> np.ndarray:
        """The text of each link."""
        return np.repeat(np.arange(len(self.l_first) - 1), np.diff(self.l_first))

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over the links of each text."""
        total = np.append(0, np.cumsum(values))
        return total[self.l_first[1:]] - total[self.l_first[:-1]]

    def groups(self, tokens: np.ndarray) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of each text; tokens: the strings of `group_strings`."""
        n_a, n_b = len(self.a_ids), len(self.b_ids)
        last_a, last_b = np.zeros((2, max(n_a, n_b)), np.int64)
        last_a, last_b = last_a[:n_a], last_b[:n_b]
        last_a[self.link_a[self.cuts]] = last_b[self.link_b[self.cuts]] = 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        b_until, a_until = np.append(0, np.flatnonzero(last_b) + 1), np.append(0, np.flatnonzero(last_a) + 1)
        out = np.empty(n_a + n_b, np.int64)
        quarter = len(tokens) // 4
        out[np.arange(n_a) + b_until[group_a]] = self.a_ids + last_a * quarter
        out[np.arange(n_b) + a_until[group_b + 1]] = self.b_ids + (2 + last_b) * quarter
        parts = tokens[out].tolist()
        bounds = (self.a_first + self.b_first).tolist()
        return ["".join(parts[x:y])[:-1] for x, y in zip(bounds, bounds[1:])]


def group_strings(size: int) -> np.ndarray:
    """Each id with what follows it: a comma or, as the last of a group, | for A (second quarter) and ; for B (fourth)."""
    return np.array([f"{i}{end}" for end in ",|,;" for i in range(size)], object)


def flat(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, and the bounds of each array."""
    return np.concatenate([NO_IDS, *arrays]).astype(np.int64), np.cumsum([0, *map(len, arrays)])


class PerfectHash:
    """Numbers of the pairs of a block of shards: bits[shard][level] one after the other, a pair's number is the count of bits
    before its own."""

    def __init__(self, shards: int, parts: dict[int, tuple[list[int], bytes, bytes]]):
        """parts: of a shard the sizes of its levels (multiples of 64), its bits, and its pairs in hash order."""
        self.shards = shards
        self.depth = max([len(sizes) for sizes, *_ in parts.values()], default=0)
        self.starts, self.sizes = np.zeros((2, shards, self.depth), np.int64)
        at, words, keys, self.first = 0, [], [], {}
        done = 0
        for shard, (sizes, bits, pairs) in sorted(parts.items()):
            self.sizes[shard, :len(sizes)] = sizes
            self.starts[shard, :len(sizes)] = at + np.cumsum([0, *sizes[:-1]])
            at += sum(sizes)
            words.append(np.frombuffer(bits, np.uint64))
            keys.append(np.frombuffer(pairs, np.int64))
            self.first[shard] = (done, done + len(keys[-1]))
            done += len(keys[-1])
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def find(self, codes: np.ndarray) -> np.ndarray:
        """The number of each pair, -1 for pairs of other blocks. Verified: an unknown pair of a shard held here is an error."""
        out = np.full(len(codes), -1, np.int64)
        shard = shard_of(codes, self.shards)
        todo = np.flatnonzero(self.sizes[shard, 0] > 0) if self.depth else np.zeros(0, np.int64)
        asked = todo
        for level in range(self.depth):
            size = self.sizes[shard[todo], level]
            todo, size = todo[size > 0], size[size > 0]
            place = self.starts[shard[todo], level] + level_place(codes[todo], level, size)
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            mine = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word[mine]] & ((np.uint64(1) << bit[mine]) - np.uint64(1))
            out[todo[mine]] = self.before[word[mine]] + np.bitwise_count(below)
            todo = todo[~mine]
        if (out[asked] < 0).any() or (self.keys[out[asked]] != codes[asked]).any():
            raise ValueError("a pair is not among the distinct pairs")
        return out


def shard_of(codes: np.ndarray, shards: int) -> np.ndarray:
    return (mix(codes.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)


def level_place(codes: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return (mix(codes.astype(np.uint64) ^ seed) % np.asarray(size).astype(np.uint64)).astype(np.int64)


def build_hash(codes: np.ndarray) -> tuple[list[int], bytes, bytes]:
    """Sizes of the levels, bits, and pairs in hash order, of distinct pairs. A level has two places per pair left."""
    sizes, words, keys, level = [], [], [], 0
    while len(codes):
        size = ceil(2 * len(codes) / 64) * 64
        place = level_place(codes, level, size)
        alone = np.bincount(place, minlength=size)[place] == 1
        order = np.argsort(place[alone])
        keys.append(codes[alone][order])
        bits = np.zeros(size, np.uint8)
        bits[place[alone]] = 1
        words.append(np.packbits(bits, bitorder="little").view(np.uint64))
        sizes.append(size)
        codes, level = codes[~alone], level + 1
    return sizes, np.concatenate(words or [np.zeros(0, np.uint64)]).tobytes(), np.concatenate(keys or [np.zeros(0, np.int64)]).tobytes()


def merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    code, count = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code, kind="stable")
    code, count = code[order], count[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])[:len(code)])
    return code[first], np.add.reduceat(count, first) if len(first) else count


def found_pairs(texts: DataFrame, load: Callable[[], Tokenizers]) -> DataFrame:
    """code, n: linked id pairs and their numbers of documents; a pair may come several times."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = load()
        codes, counts, held = [], [], 0
        for piece in pieces(batches, "text"):
            aligned = Aligned(piece.column("text").to_pylist(), tokenizers)
            both = np.unique(aligned.owners() * (tokenizers.a_size * tokenizers.b_size) + aligned.codes)
            code, count = np.unique(both % (tokenizers.a_size * tokenizers.b_size), return_counts=True)
            codes.append(code)
            counts.append(count.astype(np.int64))
            held += len(code)
            if held > PAIRS:
                code, count = merged(codes, counts)
                if len(code) > PAIRS // 2:
                    yield pairs_batch(code, count)
                    code, count = code[:0], count[:0]
                codes, counts, held = [code], [count], len(code)
        if codes:
            yield pairs_batch(*merged(codes, counts))

    return texts.mapInArrow(find, "code long, n long")


def pairs_batch(codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(counts, pa.int64())], ["code", "n"])


def hashed_shards(distinct: DataFrame, shards: int) -> DataFrame:
    """shard, sizes, bits, keys: the minimal perfect hash of each shard of distinct codes."""
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("code")
            yield pa.RecordBatch.from_arrays([codes, pa.array(shard_of(codes.to_numpy(), shards), pa.int64())], ["code", "shard"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "shard"):
            sizes, bits, keys = build_hash(rows.column("code").to_numpy())
            yield pa.RecordBatch.from_pylist(
                [{"shard": rows.column("shard")[0].as_py(), "sizes": sizes, "bits": bits, "keys": keys}],
                pa.schema([("shard", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("keys", pa.binary())]),
            )

    rows = distinct.mapInArrow(dealt, "code long, shard long").repartition("shard").sortWithinPartitions("shard")
    return rows.mapInArrow(build, "shard long, sizes array<long>, bits binary, keys binary")


def summed_vectors(pairs: DataFrame, load: Callable[[], PerfectHash]) -> DataFrame:
    """shard, counts: dense vectors of the shards of a block, in hash order, summed over all tasks."""
    schema = "shard long, task long, counts binary"

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, vector = load(), None
        for batch in batches:
            if vector is None:
                vector = np.zeros(len(own.keys), np.int64)
            at = own.find(batch.column("code").to_numpy())
            np.add.at(vector, at[at >= 0], batch.column("n").to_numpy()[at >= 0])
        if vector is not None:
            yield from vectors_of({s: vector[a:b] for s, (a, b) in own.first.items()}, TaskContext.get().partitionId())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, None
        for batch in batches:
            for shard, task, counts in zip(*[batch.column(c) for c in ("shard", "task", "counts")]):
                key, vector = (shard.as_py(), task.as_py()), np.frombuffer(counts.as_buffer(), np.int64)
                if key != last:
                    if last:
                        yield from vectors_of({last[0]: total}, last[1])
                    last, total = key, vector.copy()
                else:
                    total += vector
        if last:
            yield from vectors_of({last[0]: total}, last[1])

    vectors, tasks = pairs.mapInArrow(dense, schema), (pairs.select(F.spark_partition_id().alias("p")).agg(F.max("p")).first()[0] or 0) + 1
    while True:
        tasks = ceil(tasks / FAN)
        group = F.floor(F.col("task") / FAN) if tasks > 1 else F.lit(0).cast("long")
        vectors = vectors.withColumn("task", group).repartition("shard", "task").sortWithinPartitions("shard", "task")
        vectors = vectors.mapInArrow(add, schema)
        if tasks <= 1:
            return vectors.drop("task")


def vectors_of(vectors: dict[int, np.ndarray], task: int) -> Iterator[pa.RecordBatch]:
    for shard, vector in vectors.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([task], pa.int64()), pa.array([vector.tobytes()], pa.binary())], ["shard", "task", "counts"]
        )


def best_counts(shards: DataFrame, a_size: int, b_size: int) -> np.ndarray:
    """The highest count of a pair of each id of A; one number per id comes to the driver."""
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.zeros(a_size, np.int64)
        for batch in batches:
            for keys, counts in zip(batch.column("keys"), batch.column("counts")):
                np.maximum.at(most, np.frombuffer(keys.as_buffer(), np.int64) // b_size, np.frombuffer(counts.as_buffer(), np.int64))
        some = np.flatnonzero(most)
        yield pairs_batch(some, most[some])

    out = np.zeros(a_size, np.int64)
    rows = shards.select("keys", "counts").mapInArrow(best, "code long, n long").groupBy("code").agg(F.max("n").alias("n"))
    for row in rows.toLocalIterator():
        out[row["code"]] = row["n"]
    return out


class Block:
    """Counts of the pairs of a block, in hash order."""

    def __init__(self, pairs: PerfectHash, counts: np.ndarray, best: np.ndarray):
        self.pairs, self.counts, self.best = pairs, counts, best


def load_hash(rows: DataFrame, shards: int, low: int, high: int) -> PerfectHash:
    """The hash of the shards low .. high, at most about BLOCK pairs."""
    own = rows.where((F.col("shard") >= low) & (F.col("shard") < high)).select("shard", "sizes", "bits", "keys")
    return PerfectHash(shards, {r["shard"]: (list(r["sizes"]), bytes(r["bits"]), bytes(r["keys"])) for r in own.toLocalIterator()})


def alignments(
    docs: DataFrame, a_path: str, b_path: str, text: str = "text", id: str = "doc_id", shard: int = SHARD, block: int = BLOCK
) -> DataFrame:
    """Of every row: id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose count is the highest of their A id),
    count_sum (over links) and groups (`a1,a2|b1;a3|b2,b3`, ids in order). Runs jobs when called."""
    spark = docs.sparkSession
    load = ship(spark, tokenizers := Tokenizers(a_path, b_path))
    sizes = tokenizers.a_size, tokenizers.b_size
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    pairs = cut_lineage(found_pairs(rows.select("text"), load), "pairs")
    distinct = cut_lineage(pairs.select("code").distinct(), "distinct")
    shards = max(1, ceil(distinct.count() / shard))
    hashes = cut_lineage(hashed_shards(distinct, shards), "hashes")
    step = max(1, block // shard)
    blocks = [(low, min(low + step, shards)) for low in range(0, shards, step)]
    counts = None
    for low, high in blocks:
        part = cut_lineage(summed_vectors(pairs, ship(spark, load_hash(hashes, shards, low, high))), "vectors")
        counts = part if counts is None else counts.unionByName(part)
    counted = cut_lineage(hashes.join(counts, "shard"), "counted")
    best = best_counts(counted, *sizes)
    kind = dict(rows.dtypes)["id"]
    found = None
    for low, high in blocks:
        own = load_hash(hashes, shards, low, high)
        vector = np.zeros(len(own.keys), np.int64)
        for row in counted.where((F.col("shard") >= low) & (F.col("shard") < high)).select("shard", "counts").toLocalIterator():
            vector[slice(*own.first[row["shard"]])] = np.frombuffer(row["counts"], np.int64)
        look = looked_up(load, ship(spark, Block(own, vector, best)), max(sizes), found is None)
        if len(blocks) == 1:
            return rows.mapInArrow(look, f"id {kind}, {LOOKED}").drop("digest").withColumnRenamed("id", id)
        # rows of one id and text have one result: the sums of all blocks meet by them
        part = cut_lineage(rows.mapInArrow(look, f"id {kind}, {LOOKED}"), "looked")
        sums = part.select("id", "digest", "n_best", "count_sum").dropDuplicates(["id", "digest"])
        first, found = (part, sums) if found is None else (first, found.unionByName(sums))
    total = found.groupBy("id", "digest").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    same = first["id"].eqNullSafe(total["id"]) & (first["digest"] == total["digest"])
    columns = [total[c] if c in ("n_best", "count_sum") else first[c] for c in first.columns if c != "digest"]
    return first.join(total, same).select(columns).withColumnRenamed("id", id)


LOOKED = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string, digest binary"


def looked_up(
    load: Callable[[], Tokenizers], block: Callable[[], Block], size: int, groups: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers, own, strings = load(), block(), group_strings(size) if groups else None
        for piece in pieces(batches, "text"):
            texts = piece.column("text").to_pylist()
            aligned = Aligned(texts, tokenizers)
            at = own.pairs.find(aligned.codes)
            count = np.where(at >= 0, own.counts[at], 0) if len(own.counts) else np.zeros(len(at), np.int64)
            is_best = (at >= 0) & (count == own.best[aligned.a_ids[aligned.link_a]])
            numbers = [
                np.diff(aligned.a_first), np.diff(aligned.b_first), aligned.per_text(aligned.cuts), np.diff(aligned.l_first),
                aligned.per_text(is_best), aligned.per_text(count),
            ]
            shown = aligned.groups(strings) if groups else [""] * len(texts)
            digests = [hashlib.md5((t or "").encode()).digest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), *[pa.array(n, pa.int64()) for n in numbers], pa.array(shown, pa.string()), pa.array(digests, pa.binary())],
                ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "digest"],
            )

    return look
