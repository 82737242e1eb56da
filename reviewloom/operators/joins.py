"""Joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.operators.ordering import as_list
from reviewloom.operators.userpairs import user_pairs
from reviewloom.session import cut_lineage


def restrict(df: DataFrame, ids: DataFrame, key: str = "business_id") -> DataFrame:
    """Rows of the listed businesses. A semi join: repeated ids do not repeat rows."""
    return df.join(ids.select(key), key, "left_semi")


def with_categories(business: DataFrame, biz_cat: DataFrame, key: str = "business_id") -> DataFrame:
    """One row per business and category; the fan-out is part of the result."""
    return business.join(biz_cat, key)


def restaurant_category_counts(biz_cat: DataFrame, ids: DataFrame, key: str = "business_id",
                               category: str = "categories_value") -> DataFrame:
    return restrict(biz_cat, ids, key).groupBy(category).agg(F.count(F.lit(1)).alias("n"))


def left_totals(df: DataFrame, totals: DataFrame, key: str = "business_id") -> DataFrame:
    """Totals beside the rows; missing totals stay null."""
    return df.join(totals, key, "left")


def lookup_total(business: DataFrame, totals: DataFrame, key: str = "business_id",
                 total: str = "total_checkins", name: str = "checkins") -> DataFrame:
    """Total check-ins of each business, 0 if it has none."""
    renamed = totals.select(key, F.col(total).alias(name))
    return left_totals(business, renamed, key).withColumn(name, F.coalesce(name, F.lit(0)))


def co_reviews(review: DataFrame, user: str = "user_id", key: str = "business_id",
               ids: DataFrame | None = None) -> DataFrame:
    """(business, other business, user, n, other_n): each pair of businesses a user reviewed, with the
    user's number of reviews of either. n * other_n pairs of reviews stand behind a row. With `ids` only the
    pairs of those businesses are made. Pairs are dealt out by business, so sums per pair of businesses are made without
    another shuffle. Runs a job when called."""
    counts = cut_lineage(review.groupBy(user, key).agg(F.count(F.lit(1)).alias("n")), "counts")
    focal = counts if ids is None else counts.join(ids.select(key), key, "left_semi")
    other = counts.select(F.col(user), F.col(key).alias(f"other_{key}"), F.col("n").alias("other_n"))
    pairs, _ = user_pairs(focal.select(user, key, "n"), other, key, user, f"other_{key}", split=False)
    return pairs.filter(F.col(key) != F.col(f"other_{key}"))


def spread_join(rows: DataFrame, table: DataFrame, key: str, by: str, slices: int = 16, parts: int | None = None) -> DataFrame:
    """Inner join of many rows per key with a table of one row per key, in `parts` tasks (None: the usual number).

    A key may hold much of `rows`. They are dealt over `slices` by a digest of `by`, and the short rows of the
    table are repeated for each slice, so no task gets more than its share of a key.
    """
    dealt = rows.withColumn("_slice", F.pmod(F.xxhash64(by), F.lit(slices)).cast("int"))
    repeated = table.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    if parts is not None:
        dealt, repeated = [t.repartition(parts, key, "_slice") for t in (dealt, repeated)]
    return dealt.join(repeated, [key, "_slice"]).drop("_slice")


def with_name(df: DataFrame, business: DataFrame, key: str = "business_id", name: str = "name") -> DataFrame:
    return df.join(business.select(key, name), key)


def left_stats(top: DataFrame, stats: DataFrame, key: str = "business_id") -> DataFrame:
    return top.join(stats, key, "left")


def combine(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Two aggregates side by side; keys of either are kept."""
    return a.join(b, as_list(key), "full_outer")


def bind_meta(dtm: DataFrame, review: DataFrame, doc: str = "review_id",
              cols: Sequence[str] = ("business_id", "stars")) -> DataFrame:
    """Review fields beside the terms of its document, matched by id."""
    return dtm.join(review.select(doc, *cols), doc)


def densify(df: DataFrame, keys: str | Sequence[str], axis: Column, name: str, cols: Sequence[str],
            fill: int | float = 0) -> DataFrame:
    """One row per key and value of the `axis` array; cells that are missing get `fill`.

    Each key row explodes the axis in place, so no cross join is planned.
    """
    keys = as_list(keys)
    grid = df.select(*keys).distinct().select(*keys, F.explode(axis).alias(name))
    filled = [F.coalesce(c, F.lit(fill)).alias(c) for c in cols]
    return grid.join(df, [*keys, name], "left").select(*keys, name, *filled)
