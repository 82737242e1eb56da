"""Exact top-k by inner product with segment statistics, coarse to fine.

Method: a vector is cut into 1, 2, 4, ... segments; of each segment the mean and the deviation are kept. With
them |q - x|^2 >= sum of l ((mean q - mean x)^2 + (dev q - dev x)^2) over segments of l components, which for
given lengths is the same as q.x <= sum of l (mean q mean x + dev q dev x). A candidate that can't reach a
query's k-th best score at a coarse level is not looked at on a finer one; survivors of the finest level
get their exact product. Scores are whole numbers, bounds get a margin above their rounding error.

Work is cut into blocks: candidates in slices of about SLICE rows, queries in blocks of about QUERIES rows; a task
meets one block of each and returns its best k per query. A first pass over one slice gives each query a score
that k candidates reach, which later tasks start from.

Defined results: vectors that are null, empty or hold null or non-finite components, and rows without an id,
take no part; shorter vectors count as filled up with zeros; a query does not meet rows of its own id; repeated
candidate rows are candidates each, equal query rows are one query; ties go to the smaller id; an empty table, or
one without queries, gives an empty result. Products are exact while sums stay below 2^63.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from reviewloom.session import cut_lineage

SLICE, QUERIES = 16_384, 2_048
#: segments of the levels
LEVELS = (1, 2, 4, 8, 16)


def matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of whole numbers as the rows of a matrix, filled up with zeros."""
    flat = vectors.combine_chunks()
    lengths = np.diff(np.asarray(flat.offsets))
    values = np.asarray(flat.flatten())
    out = np.zeros((len(lengths), width), np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def features(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, times the root of their length: products of two rows bound q.x."""
    size = -(-x.shape[1] // segments)
    padded = np.zeros((len(x), size * segments))
    padded[:, : x.shape[1]] = x
    parts = padded.reshape(len(x), segments, size)
    mean = parts.mean(axis=2)
    dev = np.sqrt(((parts - mean[:, :, None]) ** 2).mean(axis=2))
    return np.concatenate([mean, dev], axis=1) * np.sqrt(size)


def best_in_slice(q: np.ndarray, q_id: np.ndarray, floor: np.ndarray, x: np.ndarray, x_id: np.ndarray, k: int):
    """(query row, candidate row, score) of the best k candidates of each query, as far as they reach floor."""
    small = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] < 2**53
    qs, xs = (q.astype(np.float64), x.astype(np.float64)) if small else (q, x)
    q_feat, x_feat = [features(q, s) for s in LEVELS], [features(x, s) for s in LEVELS]
    margin = 1e-9 * np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
    out = []
    for row in range(len(q)):
        slack = margin * np.sqrt((q[row].astype(np.float64) ** 2).sum()) + 1e-6
        alive = np.flatnonzero(x_id != q_id[row])
        bound = x_feat[0][alive] @ q_feat[0][row] + slack[alive]
        first = alive[np.argpartition(-bound, 4 * k)[: 4 * k]] if len(alive) > 4 * k else alive
        reach = np.sort((xs[first] @ qs[row]).astype(np.int64))[::-1]
        least = max(floor[row], reach[k - 1]) if len(reach) >= k else floor[row]
        alive = alive[bound >= least]
        for x_level, q_level in zip(x_feat[1:], q_feat[1:]):
            alive = alive[x_level[alive] @ q_level[row] + slack[alive] >= least]
        score = (xs[alive] @ qs[row]).astype(np.int64)
        keep = score >= least
        alive, score = alive[keep], score[keep]
        order = np.lexsort((x_id[alive], -score))[:k]
        out.append((np.full(len(order), row), alive[order], score[order]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _scan(queries: DataFrame, candidates: DataFrame, k: int, blocks: int, slices: int, width: int) -> DataFrame:
    """The best k of every (query, slice)."""
    right = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    left = queries.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))) if slices > 1 else queries.withColumn("slice", F.lit(0))
    none = np.iinfo(np.int64).min

    def meet(key, mine: pa.Table, theirs: pa.Table) -> pa.Table:
        names = ["key", "query_id", "vec_id", "score"]
        if not len(mine) or not len(theirs):
            return pa.table([pa.array([], pa.int64())] * 4, names=names)
        q, x = matrix(mine.column("v"), width), matrix(theirs.column("v"), width)
        q_id, x_id = np.asarray(mine.column("vec_id")), np.asarray(theirs.column("vec_id"))
        floor = np.asarray(mine.column("floor").fill_null(none))
        a, b, score = best_in_slice(q, q_id, floor, x, x_id, k)
        return pa.table([np.asarray(mine.column("key"))[a], q_id[a], x_id[b], score], names=names)

    both = left.groupBy("block", "slice").cogroup(right.groupBy("block", "slice"))
    return both.applyInArrow(meet, "key long, query_id long, vec_id long, score long")


def top_products(
    vectors: DataFrame, is_query, k: int = 10, scale: int = 1024, id: str = "vec_id", vector: str = "embedding",
    slice_rows: int = SLICE, query_rows: int = QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for the rows where `is_query` holds.

    Components count as floor(scale * x). Runs jobs when called.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(id).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = rows.select(F.col(id).cast("long").alias("vec_id"), whole.alias("v"), is_query.alias("asks"))
    rows = cut_lineage(rows, "vectors")
    count, asking, width = rows.agg(F.count(F.lit(1)), F.count_if("asks"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    slices, blocks = max(1, ceil(count / slice_rows)), max(1, ceil(asking / query_rows))
    place = F.xxhash64("vec_id", F.monotonically_increasing_id())  # rows of one id spread too
    candidates = rows.select("vec_id", "v", F.pmod(place, F.lit(slices)).cast("int").alias("slice"))
    key = F.xxhash64("vec_id", "v")
    queries = rows.where("asks").select("vec_id", "v").distinct().select("vec_id", "v", key.alias("key"), F.pmod(key, F.lit(blocks)).cast("int").alias("block"))
    queries = cut_lineage(queries.withColumn("floor", F.lit(None).cast("long")), "queries")
    best = Window.partitionBy("key").orderBy(F.col("score").desc(), "vec_id")
    if slices > 1:
        pilot = _scan(queries, candidates.where("slice = 0"), k, blocks, 1, width)
        reached = pilot.groupBy("key").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
        queries = cut_lineage(queries.drop("floor").join(reached, "key", "left").select("vec_id", "v", "key", "block", "floor"), "queries")
    found = _scan(queries, candidates, k, blocks, slices, width)
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
