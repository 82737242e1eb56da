"""Sorts, limits and top-k. Per key: row_number with a limit before the shuffle. Overall: orderBy + limit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.functions.columns import vote
from reviewloom.operators.ordering import as_list, top_per_key


def top_useful(review: DataFrame, n: int = 5, key: str = "business_id", review_id: str = "review_id",
               votes: str = "votes") -> DataFrame:
    """The n most useful reviews of each business; equal votes in order of review id."""
    useful = review.withColumn("usefulness", vote(votes, "useful"))
    return top_per_key(useful, key, [F.desc("usefulness"), F.col(review_id)], n)


def top_words_limit(df: DataFrame, key: str | Sequence[str], n: int, by: str = "frequency",
                    word: str = "word") -> DataFrame:
    return top_per_key(df, key, [F.desc(by), F.col(word)], n)


def head_tail(df: DataFrame, by: str, n: int = 30, key: str | Sequence[str] = (), tie: str = "word") -> DataFrame:
    """The first n and the last n rows of a descending ranking, marked `head` and `tail`.

    Two ranked branches, so that both are limited per key before their shuffle.
    """
    keys = as_list(key)
    first, last = [F.desc(by), F.col(tie)], [F.col(by), F.desc(tie)]
    if keys:
        head, tail = top_per_key(df, keys, first, n), top_per_key(df, keys, last, n)
    else:
        head, tail = df.orderBy(*first).limit(n), df.orderBy(*last).limit(n)
    return head.withColumn("part", F.lit("head")).unionByName(tail.withColumn("part", F.lit("tail")))


def top_overlap(df: DataFrame, n: int = 15, key: str = "business_id", by: str = "review", name: str = "name") -> DataFrame:
    return top_per_key(df, key, [F.desc(by), F.col(name)], n)


def drop_largest(df: DataFrame, by: str, tie: str) -> DataFrame:
    """All rows but the one with the largest value (of equal ones, the first by `tie`)."""
    first = df.filter(F.col(by) == df.agg(F.max(by)).scalar()).agg(F.min(tie)).scalar()
    return df.filter(F.col(tie) != first)


def extremes(df: DataFrame, by: str, tie: str, top: int = 11, bottom: int = 10) -> DataFrame:
    """The `top` highest and `bottom` lowest rows."""
    high = df.orderBy(F.desc(by), tie).limit(top).withColumn("part", F.lit("top"))
    low = df.orderBy(F.col(by), tie).limit(bottom).withColumn("part", F.lit("bottom"))
    return high.unionByName(low)


def top_cities(business: DataFrame, n: int = 30) -> DataFrame:
    return business.groupBy("city").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "city").limit(n)


def most_reviewed(business: DataFrame, n: int = 5, key: str = "business_id") -> DataFrame:
    return business.orderBy(F.desc("review_count"), key).limit(n)


def rows_between(df: DataFrame, by: Sequence[str | Column], offset: int, n: int) -> DataFrame:
    return df.orderBy(*by).offset(offset).limit(n)


def funniest(review: DataFrame, n: int = 30, review_id: str = "review_id", votes: str = "votes") -> DataFrame:
    return review.withColumn("funny", vote(votes, "funny")).orderBy(F.desc("funny"), review_id).limit(n)


def top_with_names(review: DataFrame, business: DataFrame, n: int = 30, review_id: str = "review_id") -> DataFrame:
    """The n funniest reviews with name and city of their business, order kept."""
    top = F.broadcast(funniest(review, n, review_id))  # n rows
    named = top.join(business.select("business_id", "name", "city"), "business_id")
    return named.orderBy(F.desc("funny"), review_id)


def sort_search(df: DataFrame) -> DataFrame:
    return df.orderBy("name", "city", "state", "business_id")


def cloud_feed(df: DataFrame, min_freq: int = 3, n: int = 300, freq: str = "freq", word: str = "term") -> DataFrame:
    return df.filter(F.col(freq) >= min_freq).orderBy(F.desc(freq), word).limit(n)


def first_docs(df: DataFrame, m: int, doc: str = "review_id") -> DataFrame:
    """The first m documents by id, to train a model on."""
    return df.orderBy(doc).limit(m)

