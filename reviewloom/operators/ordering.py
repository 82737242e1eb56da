"""Row positions inside a key, without sorting a hot key in one task.

A plain `row_number` window sends every row of a key to one task. Here rows are range-partitioned by key and
order with sampled bounds, so that a partition holds a stretch of the order, of one key or of several; the
partitions are written, rows are numbered inside (partition, key) and shifted by the number of the key's rows
in earlier partitions. It is one plan whatever the ids look like and however many rows a key or a day has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from reviewloom.session import cut_lineage


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def positions(df: DataFrame, keys: str | Sequence[str], order: Sequence[str], name: str = "n") -> DataFrame:
    """Adds the 1-based position of each row of a key in `order` (ascending, last column unique).

    Runs a job when called, which writes the partitions. Offsets are counts per partition and key: at most one
    row per key and one more per partition.
    """
    keys, order = as_list(keys), as_list(order)
    parted = cut_lineage(df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = parted.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_size"))
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    same = [f"_k{i}" for i in range(len(keys))]
    offsets = sizes.select(
        *[F.col(k).alias(s) for k, s in zip(keys, same)], F.col("_part").alias("_at"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
    )
    numbered = parted.withColumn("_rn", F.row_number().over(W.partitionBy(*keys, "_part").orderBy(*order)))
    met = F.col("_part") == F.col("_at")
    for k, s in zip(keys, same):
        met = met & F.col(k).eqNullSafe(F.col(s))  # null is a key like any other
    return numbered.join(offsets, met).select(*df.columns, (F.col("_rn") + F.col("_offset")).cast("long").alias(name))


def global_positions(df: DataFrame, order: str, name: str = "n") -> DataFrame:
    """Adds the 1-based position of each row in the order of one unique column over the whole table.

    As `positions` with one key; the offsets are one row per partition.
    """
    return positions(df.withColumn("_all", F.lit(0)), "_all", [order], name).drop("_all")


def number_values(df: DataFrame, col: str, name: str, buckets: int = 65_536) -> DataFrame:
    """One row per distinct value of `col` with a dense 0-based number.

    Values are spread over hash buckets and numbered there; the running sum goes over at most
    `buckets` counts. The numbers depend on the values alone, so a recomputed task agrees.
    """
    values = df.select(col).filter(F.col(col).isNotNull()).distinct().withColumn(
        "_bucket", F.pmod(F.xxhash64(col), F.lit(buckets))
    )
    sizes = values.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        values.withColumn("_rn", F.row_number().over(W.partitionBy("_bucket").orderBy(col)))
        .join(F.broadcast(offsets), "_bucket")  # at most `buckets` rows
        .select(col, (F.col("_rn") - 1 + F.col("_offset")).cast("int").alias(name))
    )


def top_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First n rows of each key. Spark limits each key before the shuffle (WindowGroupLimit)."""
    window = W.partitionBy(*as_list(keys)).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")
