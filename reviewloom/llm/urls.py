"""URL verdicts by cascades of Bloom filters: exact membership of every key of the corpus, without joins.

Method: level 0 of a cascade holds the listed keys. The keys of the corpus that pass it though they are not
listed are level 1; the listed keys that pass level 1 are level 2, and so on until nothing is left. A key of the
corpus is listed if the first level that it fails is an odd one. The key universe is complete: all keys that any
url of the corpus can ask for, so the answers are exact for it.

A rule is host/path: it fits its host and all subdomains if the url's path starts with the rule's. A url asks for
all suffixes of its host with all beginnings of its path that are as long as some rule's path; the longest listed
one wins (between equally long ones that of the longer host). Three cascades answer: is the key a rule, is the
rule a blocking one, is the host on the list of unwanted hosts. The last decides where no rule fits.

Defined results: null urls and urls without `://` have empty host and path, no rule, and the default verdict; a
rule both allowed and blocked blocks; repeated rows give repeated results; empty tables give empty results, empty
lists give the default verdict; other columns don't matter. Urls are looked at whole.

Size: a filter is about 10 bits for each listed key and 1.5 for each false positive of level 0. Lists are
split by hash into shards of at most SHARD_KEYS keys; each shard is one pass over the urls with its own broadcast
cascade, so a task holds one shard however long the lists are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewloom.llm.shipping import ship
from reviewloom.llm.words import mix, text_digests
from reviewloom.session import cut_lineage

#: listed keys of a shard (a filter of about 12 MB)
SHARD_KEYS = 10_000_000
#: share of strange keys that pass level 0, and a later level
FIRST, LATER = 0.01, 0.5
OTHER_BASE = 0xD1342543DE82EF95


class Filter:
    def __init__(self, count: int, rate: float, seed: int, most_bits: int | None = None):
        self.size = min(max(64, ceil(-count * log(rate) / log(2) ** 2)), most_bits or 1 << 62)
        self.hashes = max(1, round(-log(rate) / log(2)))
        self.seed = np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
        self.bits = np.zeros(ceil(self.size / 64), np.uint64)

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """(hashes, keys) bit numbers from two digests of each key."""
        a, b = mix(a ^ self.seed), mix(b + self.seed) | np.uint64(1)
        return np.stack([(a + np.uint64(i) * b) % np.uint64(self.size) for i in range(self.hashes)])

    def has(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = self.places(a, b)
        return ((self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


class Cascade:
    def __init__(self):
        self.levels: list[Filter] = []

    def has(self, keys: pa.Array) -> np.ndarray:
        a, b = text_digests(keys), text_digests(keys, OTHER_BASE)
        out = np.full(len(keys), len(self.levels) % 2 == 1)
        open_ = np.ones(len(keys), bool)
        for number, level in enumerate(self.levels):
            failed = open_.copy()
            failed[open_] = ~level.has(a[open_], b[open_]).astype(bool)
            out[failed] = number % 2 == 1
            open_ &= ~failed
        return out


def filled(keys: DataFrame, count: int, rate: float, seed: int, most_bits: int | None = None) -> Filter:
    """A filter of all keys; tasks send the words of 64 bits that they set, Spark joins them."""
    out = Filter(count, rate, seed, most_bits)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = Filter(count, rate, seed, most_bits)
        for batch in batches:
            col = batch.column(0)
            at = np.unique(empty.places(text_digests(col), text_digests(col, OTHER_BASE)))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

    for row in keys.mapInArrow(fill, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
        out.bits[row["word"]] = np.int64(row["bits"]).view(np.uint64)
    return out


def _passing(keys: DataFrame, level: Filter) -> DataFrame:
    load = ship(keys.sparkSession, level)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load()
        for batch in batches:
            col = batch.column(0)
            yield batch.filter(pa.array(own.has(text_digests(col), text_digests(col, OTHER_BASE)).astype(bool)))

    return keys.mapInArrow(check, "key string")


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """A cascade that is exact for the keys of both one-column tables (key string). listed must be distinct."""
    cascade, sides = Cascade(), [listed, universe]
    while True:
        number = len(cascade.levels)
        side = sides[number % 2]
        count = side.count()
        if not count:
            return cascade
        cascade.levels.append(filled(side, count, LATER if number else FIRST, number))
        passed = _passing(sides[(number + 1) % 2], cascade.levels[-1])
        if number == 0:
            passed = passed.distinct().join(listed, "key", "left_anti")
        sides[(number + 1) % 2] = cut_lineage(passed, "cascade")


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case (A-Z) and path."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, path = rest[:end], rest[end:]
    if path[:1] != "/":
        path = ""
    end = min([i for i in map(path.find, "?#") if i >= 0], default=len(path))
    return host.translate(_LOWER), path[:end]


_LOWER = {c: c + 32 for c in range(65, 91)}


def asked_keys(host: str, path: str, lengths: Sequence[int]) -> list[str]:
    """The keys of a url, longest first, of equal length that of the longer host first."""
    labels = host.split(".")
    hosts = [".".join(labels[i:]) for i in range(len(labels))] if host else []
    found = [(len(h) + n, len(h), h + path[:n]) for h in hosts for n in lengths if n <= len(path)]
    return [key for *_, key in sorted(found, reverse=True)]


def _keys(pages: DataFrame, make: Callable[[str, str], Iterable[str]]) -> DataFrame:
    """What all urls ask for; distinct within each batch only."""
    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = {k for url in batch.column(0).to_pylist() for k in make(*split_url(url))}
            yield pa.RecordBatch.from_arrays([pa.array(list(keys), pa.string())], ["key"])

    return pages.mapInArrow(every, "key string")


def shards(listed: DataFrame, shard_keys: int) -> list[DataFrame]:
    """A distinct list in parts of about shard_keys keys, one empty part at least."""
    listed = cut_lineage(listed.where(F.col("key").isNotNull()).distinct(), "listed")
    count = max(1, ceil(listed.count() / shard_keys))
    return [listed.where(F.pmod(F.xxhash64("key"), F.lit(count)) == n) for n in range(count)]


def url_verdicts(
    pages: DataFrame, rules: DataFrame, unwanted: DataFrame, url: str = "url", id: str = "page_id",
    default: str = "allow", shard_keys: int = SHARD_KEYS,
) -> DataFrame:
    """page_id, host, path, rule and verdict of every row.

    rules: (host, path, verdict), unwanted: (host). The lengths of rule paths are few and go to the driver.
    """
    spark = pages.sparkSession
    rules = rules.select(F.concat("host", "path").alias("key"), F.length("path").alias("n"), (F.col("verdict") == "block").alias("blocks"))
    lengths = [r["n"] for r in rules.select("n").where("n is not null").distinct().collect()]
    urls = pages.select(F.col(url).alias("url"))
    keys, blocking = rules.select("key"), rules.where("blocks").select("key")
    kind = dict(pages.dtypes)[id]
    frame = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), F.lit(None).cast("string").alias("rule"), F.lit(False).alias("blocks"), F.lit(False).alias("bad"))
    schema = f"id {kind}, url string, rule string, blocks boolean, bad boolean"

    def asked(host: str, path: str) -> list[str]:
        return asked_keys(host, path, lengths)

    for part in shards(keys, shard_keys):
        block = part.join(blocking.distinct(), "key", "left_semi")
        load = ship(spark, (build_cascade(part, _keys(urls, asked)), build_cascade(block, part)))

        def judge(batches: Iterator[pa.RecordBatch], load=load) -> Iterator[pa.RecordBatch]:
            is_rule, is_block = load()
            for batch in batches:
                wanted = [asked(*split_url(u)) for u in batch.column("url").to_pylist()]
                flat = pa.array([k for keys in wanted for k in keys], pa.string())
                hit, bad, at = is_rule.has(flat), is_block.has(flat), 0
                rule, blocks = batch.column("rule").to_pylist(), batch.column("blocks").to_pylist()
                for i, keys in enumerate(wanted):
                    for j, key in enumerate(keys, at):
                        if hit[j] and (rule[i] is None or keys.index(key) < keys.index(rule[i])):
                            rule[i], blocks[i] = key, bool(bad[j])
                            break
                    at += len(keys)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(rule, pa.string()), pa.array(blocks), batch.column("bad")], ["id", "url", "rule", "blocks", "bad"])

        frame = frame.mapInArrow(judge, schema)

    for part in shards(unwanted.select(F.col("host").alias("key")), shard_keys):
        load = ship(spark, build_cascade(part, _keys(urls, lambda host, path: [host])))

        def mark(batches: Iterator[pa.RecordBatch], load=load) -> Iterator[pa.RecordBatch]:
            own = load()
            for batch in batches:
                bad = own.has(pa.array([split_url(u)[0] for u in batch.column("url").to_pylist()], pa.string()))
                bad |= np.asarray(batch.column("bad"))
                yield batch.set_column(4, "bad", pa.array(bad))

        frame = frame.mapInArrow(mark, schema)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [split_url(u) for u in batch.column("url").to_pylist()]
            host, path = pa.array([h for h, _ in split], pa.string()), pa.array([p for _, p in split], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), host, path, *(batch.column(c) for c in ("rule", "blocks", "bad"))], ["id", "host", "path", "rule", "blocks", "bad"])

    out = frame.mapInArrow(parts, f"id {kind}, host string, path string, rule string, blocks boolean, bad boolean")
    by_rule = F.when(F.col("blocks"), F.lit("block")).otherwise(F.lit("allow"))
    verdict = F.when(F.col("rule").isNotNull(), by_rule).when(F.col("bad"), F.lit("block")).otherwise(F.lit(default))
    return out.select(F.col("id").alias(id), "host", "path", "rule", verdict.alias("verdict"))


def hosts_with_words(pages: DataFrame, words: Sequence[str], url: str = "url") -> DataFrame:
    """The distinct hosts of the corpus with one of the words as a part between dots and hyphens."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = {split_url(u)[0] for u in batch.column(0).to_pylist()}
            bad = [h for h in hosts if not set(h.replace("-", ".").split(".")).isdisjoint(words)]
            yield pa.RecordBatch.from_arrays([pa.array(bad, pa.string())], ["host"])

    return pages.select(url).mapInArrow(find, "host string").distinct()


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")
