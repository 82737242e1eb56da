"""Projections, filters, predicates and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.operators.ordering import as_list

SEARCH_COLUMNS = ["name", "business_id", "city", "state", "stars", "review_count", "categories"]


def for_business(df: DataFrame, business_id, key: str = "business_id") -> DataFrame:
    """Rows of one business. The id is a literal, never part of a SQL text."""
    return df.filter(F.col(key) == F.lit(business_id))


def search_names(business: DataFrame, text: str, wildcards: bool = False) -> DataFrame:
    """Businesses whose name contains `text`, whatever the case. With wildcards `%` and `_` match as in LIKE."""
    found = business.select(*SEARCH_COLUMNS)
    if not text:
        return found.filter(F.lit(False))
    name = F.lower("name")
    if wildcards:
        return found.filter(name.like(f"%{text.lower()}%"))
    return found.filter(F.contains(name, F.lit(text.lower())))


def star_band(review: DataFrame, kind: str = "all", col: str = "stars") -> DataFrame:
    """good: 4 stars and more; bad: fewer than 3; all."""
    if kind == "good":
        return review.filter(F.col(col) >= 4)
    if kind == "bad":
        return review.filter(F.col(col) < 3)
    if kind != "all":
        raise ValueError(f"kind must be all, good or bad, not {kind!r}")
    return review


def with_category(business: DataFrame, category: str, col: str = "categories") -> DataFrame:
    return business.filter(F.array_contains(col, category))


def with_category_like(business: DataFrame, text: str, col: str = "categories") -> DataFrame:
    """Businesses with a category that contains `text`, also as part of a longer name."""
    return business.filter(F.exists(col, lambda c: F.contains(c, F.lit(text))))


def keep_ids(df: DataFrame, ids: DataFrame, key: str | Sequence[str] = "business_id") -> DataFrame:
    """Rows whose key is among the ids; Spark broadcasts the ids only if they measure small."""
    return df.join(ids.select(*as_list(key)), as_list(key), "left_semi")


def peers_filter(biz_cat: DataFrame, ids: DataFrame, cats: DataFrame, key: str = "business_id",
                 category: str = "categories_value") -> DataFrame:
    return keep_ids(keep_ids(biz_cat, ids, key), cats, category)


def having(df: DataFrame, group: str | Sequence[str], agg: Column, min_count: int, name: str = "n") -> DataFrame:
    """Groups whose aggregate is above `min_count`."""
    return df.groupBy(*as_list(group)).agg(agg.alias(name)).filter(F.col(name) > min_count)


def nonzero(df: DataFrame, col: str = "n") -> DataFrame:
    return df.filter(F.col(col) != 0)


def drop_empty_docs(docs: DataFrame, dtm: DataFrame, doc: str = "doc", n: str = "n") -> DataFrame:
    """Documents that keep at least one term."""
    return docs.join(nonzero(dtm, n).select(doc), doc, "left_semi")


def drop_terms(dtm: DataFrame, terms: Sequence[str], col: str = "term") -> DataFrame:
    return dtm.filter(~F.col(col).isin(list(terms)))


def project(df: DataFrame, cols: Sequence[str], renames: Mapping[str, str] | None = None) -> DataFrame:
    renames = renames or {}
    return df.select(*[F.col(c).alias(renames.get(c, c)) for c in cols])


def with_const(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def submatrix(long: DataFrame, rows: Sequence, cols: Sequence, row: str = "i", col: str = "j") -> DataFrame:
    """Chosen rows and columns of a matrix in long form."""
    return long.filter(F.col(row).isin(list(rows)) & F.col(col).isin(list(cols)))


def since(df: DataFrame, date_col: str, day: str) -> DataFrame:
    """Rows from `day` on. Applied to a finished series; Spark does not move it below a window."""
    return df.filter(F.col(date_col) >= F.lit(day).cast("date"))


def flag(df: DataFrame, name: str, predicate: Column) -> DataFrame:
    return df.withColumn(name, predicate)


def union_parts(dfs: Sequence[DataFrame]) -> DataFrame:
    """All rows, columns matched by name; a column that a part lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def terms_in_all_parts(dtm: DataFrame, part: str, term: str = "term", parts: DataFrame | None = None) -> DataFrame:
    """Terms that occur in every part. `parts` has a row of each part, those without any term too; without it the
    parts of the matrix count."""
    parts = (dtm if parts is None else parts).agg(F.countDistinct(part)).scalar()
    return dtm.groupBy(term).agg(F.countDistinct(part).alias("_parts")).filter(F.col("_parts") == parts).select(term)


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def append_docs(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b.select(*a.columns))
