"""Connected components of a table of links, and rows of a partition in runs of equal keys."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewloom.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (its smallest reachable node) of every node that has a link to another.

    Alternating large-star and small-star steps: each is an aggregate with partial sums and a join on the
    node, and its edges are written to the shared folder. The number of steps grows with the logarithm of
    the longest chain; a node of very many links is only ever a join key whose rows Spark can split.
    """
    def smallest(pairs: DataFrame) -> DataFrame:
        return cut_lineage(pairs.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "stars")

    def linked(pairs: DataFrame) -> DataFrame:
        return cut_lineage(pairs.where(F.col("a") != F.col("b")).distinct(), "links")

    edges = linked(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")))
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(smallest(both), "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = linked(large)
        stars = smallest(large)
        small = large.join(stars, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = linked(small.unionByName(stars.select("a", F.col("m").alias("b"))))
        before, state = state, _state(edges)
        if state == before:
            break
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def runs(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, of a partition sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        values = list(zip(*[batch.column(k).to_pylist() for k in keys]))
        at = 0
        for i in range(1, len(values) + 1):
            if i < len(values) and values[i] == values[at]:
                continue
            if held and values[at] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(at, i - at))
            last, at = values[at], i
    if held:
        yield pa.Table.from_batches(held)
