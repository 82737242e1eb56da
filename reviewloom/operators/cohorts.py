"""Rating change over the life of a business, and top-n with ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from reviewloom.operators.aggregates import quantile
from reviewloom.operators.filters import having
from reviewloom.operators.ordering import as_list

# First and last review (in date order) of each cohort
COHORTS = {"100": (1, 100), "200": (101, 200), "500": (501, 600)}


def review_counts(review: DataFrame, key: str = "business_id") -> DataFrame:
    return review.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def review_count_quantile(review: DataFrame, q: float = 0.85, key: str = "business_id") -> DataFrame:
    return quantile(review_counts(review, key), "n", q)


def age_cohorts(
    review: DataFrame, min_reviews: int = 500, key: str = "business_id",
    order: Sequence[str] = ("date", "review_id"), stars: str = "stars",
) -> DataFrame:
    """Mean stars of reviews 1-100, 101-200 and 501-600 of each business with more than `min_reviews`.

    Only the first 600 reviews of a business matter; Spark drops the others before the shuffle.
    """
    many = having(review, key, F.count(F.lit(1)), min_reviews).select(key)
    last = max(end for _, end in COHORTS.values())
    window = W.partitionBy(key).orderBy(*order)
    first = (
        review.select(key, *order, stars).withColumn("_rn", F.row_number().over(window))
        .filter(F.col("_rn") <= last)
    )
    means = [
        F.avg(F.when(F.col("_rn").between(start, end), F.col(stars))).alias(name)
        for name, (start, end) in COHORTS.items()
    ]
    return first.groupBy(key).agg(*means).join(many, key, "left_semi")


def cohort_change(cohorts: DataFrame) -> DataFrame:
    """better / worse: the second hundred differs from the first by more than a fifth of its deviation."""
    margin = F.lit(2) * cohorts.agg(F.stddev_samp("100")).scalar() / F.lit(10)
    first, second, later = F.col("100"), F.col("200"), F.col("500")
    return cohorts.select(
        "*",
        (second > first + margin).alias("better"),
        (second < first - margin).alias("worse"),
        (second - first).alias("diff"),
        (later - first).alias("diff_500"),
    )


def top_n_ties(df: DataFrame, key: str | Sequence[str], by: str, n: int) -> DataFrame:
    """Rows among the n highest of their key, with all ties of the last place."""
    window = W.partitionBy(*as_list(key)).orderBy(F.desc(by))
    return df.withColumn("_rank", F.rank().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def dense_businesses(review: DataFrame, n: int = 5, min_reviews: int = 500, key: str = "business_id") -> DataFrame:
    """The first n businesses, by id, with more than `min_reviews` reviews."""
    return having(review, key, F.count(F.lit(1)), min_reviews).select(key).orderBy(key).limit(n)

