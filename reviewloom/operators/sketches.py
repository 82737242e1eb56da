"""Sizes and overlaps of categories from theta sketches, which are stored, merged and intersected instead of the businesses.

A sketch keeps the smallest hashes of a set, about 2^lg at least, so its size does not grow with the set. Sketches of parts
of the businesses (days, regions) merge to the sketch of all, whether the parts share businesses or not, so new businesses
are added without reading old ones again. Results are exact for sets of up to 2^lg businesses. Beyond, the standard error is
at most n / sqrt(2^lg) for a size n, and sqrt(both * larger / 2^lg) for two sets with `both` in common; `error` is three of them
(`both` taken as one kept hash at least, so that it also holds for sets that share no kept hash).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.operators.aggregates import CATEGORY
from reviewloom.session import cut_lineage

#: 2^16 hashes: 512 KB at most, exact up to 65,536 businesses, a standard error of 0.4 % beyond
LG = 16
#: sketches of either side of a pair that one task intersects
GROUP = 32


def set_sketches(biz_cat: DataFrame, category: str = CATEGORY, key: str = "business_id", lg: int = LG) -> DataFrame:
    """(category, sketch): a sketch of the businesses of each category. Null businesses do not count, a null category does."""
    named = F.concat(F.lit("="), F.col(key).cast("string"))  # an empty text would not enter a sketch
    return biz_cat.select(category, named.alias("_key")).groupBy(category).agg(F.theta_sketch_agg("_key", lg).alias("sketch"))


def merge_sketches(*tables: DataFrame, category: str = CATEGORY, lg: int = LG) -> DataFrame:
    """(category, sketch): the sketches of all tables together, by category."""
    first, *others = tables
    for other in others:
        first = first.unionByName(other)
    return first.groupBy(category).agg(F.theta_union_agg("sketch", lg).alias("sketch"))


def _size_error(size: Column, lg: int) -> Column:
    return F.when(size <= 2**lg, 0.0).otherwise(3 * size / 2 ** (lg / 2))


def sketched_sizes(sketches: DataFrame, category: str = CATEGORY, lg: int = LG) -> DataFrame:
    """(category, businesses, error): the number of businesses, right within the error (0: exact)."""
    sized = sketches.select(category, F.theta_sketch_estimate("sketch").alias("businesses"))
    return sized.withColumn("error", _size_error(F.col("businesses"), lg))


def sketched_overlap(sketches: DataFrame, min_count: int = 100, category: str = CATEGORY, lg: int = LG) -> DataFrame:
    """(i, j, share, error): category_overlap from sketches, for the categories of more than `min_count` businesses.

    All pairs of kept categories, 0 included, as in the dense overlap matrix; share is 1 on the diagonal. A pair is intersected
    once, in blocks of GROUP by GROUP sketches, for which each sketch is copied categories / GROUP times. Runs a job when
    called, which writes the kept sketches.
    """
    sized = sketches.filter(F.col(category).isNotNull()).select(
        F.col(category).alias("name"), "sketch", F.theta_sketch_estimate("sketch").alias("size"))
    kept = cut_lineage(sized.filter(F.col("size") > min_count), "sketches")
    groups = -(-max(1, kept.count()) // GROUP)
    group = F.pmod(F.xxhash64("name"), F.lit(groups)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    left = kept.select(F.struct("name", "sketch", "size").alias("a"), group.alias("ga"), every.alias("gb"))
    right = kept.select(F.struct("name", "sketch", "size").alias("b"), group.alias("gb"), every.alias("ga"))
    met = left.join(right, ["ga", "gb"]).filter(F.col("a.name") < F.col("b.name"))
    both = F.theta_sketch_estimate(F.theta_intersection(F.col("a.sketch"), F.col("b.sketch"))).cast("double")
    pairs = met.select(F.col("a.name").alias("x"), F.col("b.name").alias("y"), F.col("a.size").alias("nx"), F.col("b.size").alias("ny"), both.alias("both"))
    larger = F.greatest("nx", "ny")
    wrong = F.when(larger <= 2**lg, 0.0).otherwise(3 * F.sqrt(F.greatest("both", larger / 2**lg) * larger / 2**lg))
    sides = [F.struct(F.col(i).alias("i"), F.col(j).alias("j"), (F.col("both") / F.col(n)).alias("share"), (wrong / F.col(n)).alias("error"))
             for i, j, n in (("x", "y", "nx"), ("y", "x", "ny"))]
    diagonal = kept.select(F.col("name").alias("i"), F.col("name").alias("j"), F.lit(1.0).alias("share"), F.lit(0.0).alias("error"))
    return pairs.select(F.inline(F.array(*sides))).unionByName(diagonal)
