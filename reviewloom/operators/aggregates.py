"""Aggregations. Each is one hash aggregate with partial sums before its shuffle unless it says otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from reviewloom.functions.columns import explode_map, safe_ratio, split_slot
from reviewloom.functions.text import explode_words
from reviewloom.operators.joins import densify, left_totals
from reviewloom.operators.ordering import as_list, positions

CATEGORY = "categories_value"


def _rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def count_by_date(review: DataFrame, key: str = "business_id", date: str = "date") -> DataFrame:
    return review.groupBy(key, date).agg(_rows("n"))


def category_sizes(biz_cat: DataFrame, category: str = CATEGORY, key: str = "business_id") -> DataFrame:
    """Distinct businesses per category; duplicates are removed before the count shuffles."""
    return biz_cat.select(category, key).distinct().groupBy(category).agg(_rows("businesses"))


def categories_per_business_hist(biz_cat: DataFrame, category: str = CATEGORY, key: str = "business_id") -> DataFrame:
    per_business = biz_cat.groupBy(key).agg(F.countDistinct(category).alias("categories"))
    return per_business.groupBy("categories").agg(_rows("businesses"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(_rows("n")).orderBy(F.desc("n"), col)


def mean_stars(df: DataFrame, group: str | Sequence[str], col: str = "stars") -> DataFrame:
    return df.groupBy(*as_list(group)).agg(F.avg(col).alias("mean_stars"))


def review_total(df: DataFrame, group: str | Sequence[str], col: str = "review_count") -> DataFrame:
    return df.groupBy(*as_list(group)).agg(F.sum(col).alias("reviews"))


def reviews_per_business(df: DataFrame, group: str | Sequence[str], key: str = "business_id",
                         col: str = "review_count") -> DataFrame:
    """Review total / distinct businesses, in one aggregate."""
    sums = df.groupBy(*as_list(group), key).agg(F.sum(col).alias("_s"))  # one row per business and group
    totals = sums.groupBy(*as_list(group)).agg(F.sum("_s").alias("reviews"), _rows("businesses"))
    return totals.withColumn("reviews_per_business", safe_ratio("reviews", "businesses"))


def checkin_total(df: DataFrame, totals: DataFrame, key: str = "business_id", dedupe: bool = False) -> DataFrame:
    """Check-ins per business over its category rows: k category rows count them k times.

    With dedupe each business counts its check-ins once.
    """
    ks = df.groupBy(key).agg(_rows("_k"))
    joined = left_totals(ks, totals, key)
    value = F.col("total_checkins") if dedupe else F.col("total_checkins") * F.col("_k")
    return joined.select(key, value.alias("checkins"))


def checkins_by_rating(df: DataFrame, rating: str = "avg_rating", checkins: str = "avg_checkins") -> DataFrame:
    return df.groupBy(rating).agg(F.avg(checkins).alias("mean_checkins"))


def city_mean(business: DataFrame, biz_cat: DataFrame, key: str = "business_id", dedupe: bool = False) -> DataFrame:
    """Mean stars per city, each business weighted by its number of categories (or once, with dedupe)."""
    ks = biz_cat.groupBy(key).agg(_rows("_k"))
    joined = business.select(key, "city", "stars").join(ks, key)
    weight = F.lit(1) if dedupe else F.col("_k")
    sums = joined.groupBy("city").agg(F.sum(F.col("stars") * weight).alias("_s"), F.sum(weight).alias("_w"))
    return sums.select("city", safe_ratio("_s", "_w").alias("mean_stars"))


def good_bad_counts(df: DataFrame, group: str | Sequence[str], stars: str = "stars") -> DataFrame:
    """Reviews, those with 4 stars and more, and those with 2 and fewer."""
    return df.groupBy(*as_list(group)).agg(
        _rows("review"),
        F.count_if(F.col(stars) >= 4).alias("good_reviews"),
        F.count_if(F.col(stars) <= 2).alias("bad_reviews"),
    )


def checkin_slots(checkin: DataFrame, key: str = "business_id", col: str = "checkin_info") -> DataFrame:
    """(business, hour, day, checkins) from the check-in maps."""
    rows = explode_map(checkin.select(key, col), col, "slot", "checkins")
    hour, day = split_slot("slot")
    return rows.select(key, hour.alias("hour"), day.alias("day"), "checkins")


def checkins_by(slots: DataFrame, part: str, key: str = "business_id") -> DataFrame:
    """Check-ins per business and `part`, day or hour."""
    return slots.groupBy(key, part).agg(F.sum("checkins").alias("checkins"))


def business_stats(review: DataFrame, key: str = "business_id") -> DataFrame:
    return review.groupBy(key).agg(F.avg("stars").alias("avg_stars"), _rows("num_reviews"))


def doc_freq(dtm: DataFrame, term: str = "term", n: str = "n") -> DataFrame:
    """Documents per term; the matrix holds a document and term once.

    Counting n > 0 keeps the matrix the same plan here and where it is joined, so that Spark computes
    and shuffles it once and reuses the exchange.
    """
    return dtm.groupBy(term).agg(F.count_if(F.col(n) > 0).alias("num"))


def doc_freq_by(dtm: DataFrame, key: str = "business_id", term: str = "term", n: str = "n") -> DataFrame:
    return dtm.groupBy(term, key).agg(F.count_if(F.col(n) > 0).alias("num"))


def term_totals(dtm: DataFrame, min_total: int = 0, term: str = "term", n: str = "n") -> DataFrame:
    return dtm.groupBy(term).agg(F.sum(n).alias("freq")).filter(F.col("freq") >= min_total)


def token_counts(tokens: DataFrame, key: str | Sequence[str], col: str = "tokens", name: str = "word") -> DataFrame:
    """Occurrences of each token of an array column per key."""
    key = as_list(key)
    return explode_words(tokens, col, name, *key).groupBy(*key, name).agg(_rows("frequency"))


def quantile(df: DataFrame, col: str, q: float, name: str = "quantile") -> DataFrame:
    """Exact quantile with linear interpolation, in one row.

    Equal values are counted first. A sketch gives bounds around the wanted ranks; values outside them
    are only counted, and one window ranks the distinct values between them (under rows / 1,000).
    """
    counts = df.groupBy(F.col(col).alias("_v")).agg(_rows("_n")).filter(F.col("_v").isNotNull())
    around = F.array(F.lit(max(q - 2e-4, 0.0)), F.lit(min(q + 2e-4, 1.0)))
    sketch = df.agg(F.percentile_approx(col, around, F.lit(10_000)).alias("_b"))
    low, high = sketch.select(F.get("_b", F.lit(0))).scalar(), sketch.select(F.get("_b", F.lit(1))).scalar()
    v, n = F.col("_v"), F.col("_n")
    facts = counts.agg(
        F.sum(n).alias("_all"), F.coalesce(F.sum(F.when(v < low, n)), F.lit(0)).alias("_below"),
        F.max(F.when(v < low, v)).alias("_prev"), F.min(F.when(v > high, v)).alias("_next"),
    ).select("*", ((F.col("_all") - 1) * F.lit(float(q))).alias("_place"))
    fact = {c: facts.select(c).scalar() for c in facts.columns}
    upto = W.orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    band = counts.filter(v.between(low, high)).select("_v", (F.sum(n).over(upto) + fact["_below"]).alias("_end"))

    def at(rank: Column) -> Column:
        # the first value whose 1-based last rank lies beyond the 0-based rank; the neighbours of the
        # band cover the one rank by which the bounds may miss
        inside = F.coalesce(F.min(F.when(F.col("_end") > rank, v)), fact["_next"])
        return F.when(rank < fact["_below"], fact["_prev"]).otherwise(inside).cast("double")

    ends = band.agg(at(F.floor(fact["_place"])).alias("_lo"), at(F.ceil(fact["_place"])).alias("_hi"))
    share = fact["_place"] - F.floor(fact["_place"])
    return ends.select((F.col("_lo") + (F.col("_hi") - F.col("_lo")) * share).alias(name))


def std_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sample standard deviation and mean of each column, one row per column."""
    aggs = [a for c in cols for a in (F.stddev_samp(c).alias(f"{c}_std"), F.avg(c).alias(f"{c}_mean"))]
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}_std").alias("std"), F.col(f"{c}_mean").alias("mean"))
        for c in cols
    ])
    return df.agg(*aggs).select(F.inline(rows))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Counts in `bins` equal bins between minimum and maximum; the last bin holds its upper end."""
    values = df.select(F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    ends = values.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    place = F.floor(F.coalesce(F.try_divide(F.col("_x") - lo, hi - lo), F.lit(0.0)) * bins)
    counted = values.select(F.least(place, F.lit(bins - 1)).cast("int").alias("bin")).groupBy("bin").agg(_rows("n"))
    axis = F.sequence(F.lit(0), F.lit(bins - 1))
    grid = ends.select("lo", "hi", F.explode(axis).alias("bin"))
    return grid.join(counted, "bin", "left").select(
        "bin", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / bins).alias("left_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def to_wide(long: DataFrame, rows: str, cols: str, value: str, values: Sequence | None = None) -> DataFrame:
    """Long to wide with max; absent cells are 0. Give `values` to spare the pass that finds the columns."""
    return long.groupBy(rows).pivot(cols, list(values) if values is not None else None).agg(F.max(value)).na.fill(0)


def to_long(wide: DataFrame, id_cols: str | Sequence[str], name: str = "term", value: str = "n") -> DataFrame:
    ids = as_list(id_cols)
    return wide.unpivot(ids, [c for c in wide.columns if c not in ids], name, value)


def tokens_per_key(tokens: DataFrame, key: str, doc: str, col: str = "tokens", docs_per_row: int = 1000) -> DataFrame:
    """(key, chunk, tokens): all tokens of a key in document order.

    A key with many documents has several rows, so that no row or task holds a whole hot key.
    """
    chunked = positions(tokens.select(key, doc, col), key, [doc])
    chunk = F.floor((F.col("n") - 1) / docs_per_row)
    grouped = chunked.groupBy(key, chunk.alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("n", col))).alias("_d"))
    return grouped.select(key, "chunk", F.flatten(F.col("_d")[col]).alias("tokens"))


def row_sums(long: DataFrame, row: str = "i", value: str = "share") -> DataFrame:
    return long.groupBy(row).agg(F.sum(value).alias("total")).orderBy("total", row)


def dense_checkins(slots: DataFrame, part: str, key: str = "business_id") -> DataFrame:
    """checkins_by with all 7 days or 24 hours of each known business."""
    axis = F.sequence(F.lit(0), F.lit(6 if part == "day" else 23))
    return densify(checkins_by(slots, part, key), key, axis, part, ["checkins"])
