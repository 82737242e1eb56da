import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W, functions as F

from reviewloom.operators import cohorts, series
from reviewloom.operators.ordering import global_positions, number_values, positions


@pytest.fixture(scope="module")
def reviews(spark):
    """A hot key with a third of the rows, many of them on one day, and some small keys."""
    rng = random.Random(7)
    rows = []
    for i in range(15000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(20)}"
        day = dt.date(2015, 1, 1) + dt.timedelta(days=0 if i % 4 == 0 else rng.randrange(400))
        rows.append((key, day, f"{rng.randrange(10**6):06d}-{i}", rng.randrange(1, 6)))
    return spark.createDataFrame(rows, "business_id string, date date, review_id string, stars int").cache()


def frame(reviews):
    return reviews.toPandas().sort_values(["business_id", "date", "review_id"]).reset_index(drop=True)


def test_positions_of_a_hot_key(reviews):
    plain = F.row_number().over(W.partitionBy("business_id").orderBy("date", "review_id"))
    got = positions(reviews, "business_id", ["date", "review_id"]).withColumn("m", plain)
    assert got.count() == reviews.count()
    assert got.filter("n <> m").count() == 0


def test_positions_by_a_number(spark):
    df = spark.range(0, 400_000, 3).select((F.col("id") % 2).alias("k"), "id")
    plain = F.row_number().over(W.partitionBy("k").orderBy("id"))
    got = positions(df, "k", ["id"]).withColumn("m", plain)
    assert got.filter("n <> m").count() == 0


@pytest.mark.parametrize("make", [lambda i: f"r-{i:06d}", lambda i: f"{i * 0x9E3779B97F4A7C15 % 2**64:020d}"], ids=["prefix", "random"])
def test_positions_of_one_key_on_one_day(spark, make):
    """Ids with one prefix, or random over 64 bits: several tasks share the key, and the numbers are right."""
    rows = [("k", dt.date(2020, 1, 1), make(i)) for i in range(5000)] + [(None, dt.date(2020, 1, 1), make(i)) for i in range(7)]
    df = spark.createDataFrame(rows, "k string, date date, id string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is far too small to be cut else
    try:
        got = positions(df, "k", ["date", "id"])
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for key, n in (("k", 5000), (None, 7)):
        mine = sorted((r.n, r.id) for r in got.collect() if r.k == key)
        assert [a for a, _ in mine] == list(range(1, n + 1)) and [b for _, b in mine] == sorted(b for _, b in mine)


def test_global_positions(reviews):
    got = global_positions(reviews.select("review_id"), "review_id").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, len(got) + 1))
    assert [r.review_id for r in got] == sorted(r.review_id for r in got)


def test_number_values_are_dense(reviews):
    got = [r.n for r in number_values(reviews, "review_id", "n", buckets=16).collect()]
    assert sorted(got) == list(range(len(got)))


@pytest.mark.parametrize("span", [1, 5, 28, 500])
def test_ewm_equals_pandas(reviews, span):
    pdf = frame(reviews)  # the hot key has more rows than a block
    want = pdf.groupby("business_id").stars.apply(lambda s: s.ewm(span=span).mean()).to_numpy()
    got = series.ewm_mean(reviews, "business_id", ["date", "review_id"], "stars", span).toPandas()
    got = got.sort_values(["business_id", "date", "review_id"]).moving_avg.to_numpy()
    assert abs(want - got).max() < 1e-12


def test_rating_trend_equals_pandas(reviews):
    pdf = frame(reviews)
    got = series.rating_trend(reviews, "2015-03-01").toPandas()
    for key in ("hot", "k3"):
        one = pdf[pdf.business_id == key].copy()
        one["avg"] = one.stars.ewm(span=28).mean()
        one["date"] = pd.to_datetime(one.date)
        want = one.groupby("date").avg.last().resample("D").ffill()["2015-03-01":]
        mine = got[got.business_id == key].sort_values("date")
        assert list(pd.to_datetime(mine.date)) == list(want.index)
        assert abs(mine.avg_rating.to_numpy() - want.to_numpy()).max() < 1e-12


def test_rolling_mean_equals_pandas(reviews):
    pdf = frame(reviews)
    want = pdf.groupby("business_id").stars.apply(lambda s: s.rolling(7).mean()).to_numpy()
    got = series.rolling_mean(reviews).toPandas()
    assert len(got) == len(pdf)
    got = got.sort_values(["business_id", "date", "review_id"]).rolling_mean.to_numpy(dtype=float)
    assert (pd.isna(want) == pd.isna(got)).all()
    assert abs(pd.Series(want).fillna(0) - pd.Series(got).fillna(0)).max() < 1e-12


def test_cumulative_ends_at_all_reviews_and_has_every_day(reviews):
    got = series.cumulative_reviews(reviews, "2015-01-01").groupBy("business_id").agg(
        F.max("review_count").alias("last"), F.count("*").alias("days"),
        (F.datediff(F.max("date"), F.min("date")) + 1).alias("span"),
    )
    want = reviews.groupBy("business_id").agg(F.count("*").alias("all"))
    assert got.join(want, "business_id").filter("last <> all OR days <> span").count() == 0


def test_no_review_after_the_cut(reviews):
    assert series.cumulative_reviews(reviews, "2030-01-01").count() == 0
    assert series.rating_trend(reviews, "2030-01-01").count() == 0


def test_competitors_share_city_and_category(spark):
    business = spark.createDataFrame(
        [("a", "x"), ("b", "x"), ("c", "x"), ("d", "y")], "business_id string, city string")
    cats = spark.createDataFrame(
        [("a", "p"), ("a", "q"), ("b", "q"), ("c", "r"), ("d", "p")], "business_id string, categories_value string")
    focal, members, peers = series.peer_groups(business, cats)
    got = {}
    both = focal.join(peers.join(members.withColumnRenamed("business_id", "peer"), ["city", "_set"]), "peer_group")
    for row in both.collect():
        got.setdefault(row.business_id, set()).add(row.peer)
    assert got == {"a": {"a", "b"}, "b": {"a", "b"}, "c": {"c"}, "d": {"d"}}


def test_businesses_with_the_same_peers_share_a_group(spark):
    business = spark.createDataFrame([(i, "x") for i in range(30)], "business_id int, city string")
    cats = spark.createDataFrame(
        [(i, c) for i in range(30) for c in ("Restaurants", f"c{i}")], "business_id int, categories_value string")
    focal, members, peers = series.peer_groups(business, cats)
    assert focal.select("peer_group").distinct().count() == 1
    assert peers.count() == members.count() == 30


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame([("a", w, n) for w, n in (("u", 3), ("v", 2), ("w", 2), ("x", 1))], "k string, w string, n int")
    assert {r.w for r in cohorts.top_n_ties(df, "k", "n", 2).collect()} == {"u", "v", "w"}


def test_cohorts_leave_out_small_businesses(spark):
    rows = [("big", dt.date(2015, 1, 1), f"{i:04d}", 1 if i < 100 else 5) for i in range(550)]
    rows += [("small", dt.date(2015, 1, 1), f"{i:04d}", 3) for i in range(500)]
    got = cohorts.age_cohorts(spark.createDataFrame(rows, "business_id string, date date, review_id string, stars int")).collect()
    assert [tuple(r) for r in got] == [("big", 1.0, 5.0, 5.0)]


def competitor_tables(spark, seed=4):
    """Businesses of two cities with overlapping categories, and reviews of few days with ids dealt over all businesses."""
    rng = np.random.default_rng(seed)
    business = [(f"b{i:02d}", "xyz"[i % 2] if i else None) for i in range(20)]
    cats = [(b, c) for b, _ in business for c in rng.choice(list("pqrstu"), 2, replace=False)]
    rows = [(business[int(rng.integers(20))][0], dt.date(2015, 1, 1) + dt.timedelta(days=int(rng.integers(12)) ** 2), f"r{i:05d}", int(rng.integers(1, 6)))
            for i in rng.permutation(3000)]
    return (spark.createDataFrame(rows, "business_id string, date date, review_id string, stars int").repartition(5),
            spark.createDataFrame(business, "business_id string, city string"),
            spark.createDataFrame(cats, "business_id string, categories_value string"), rows, business, cats)


@pytest.mark.parametrize("peer_rows", [series.PEER_ROWS, 0])
@pytest.mark.parametrize("day_rows", [series.DAY_ROWS, 40])
def test_competitor_trend_equals_pandas(spark, monkeypatch, peer_rows, day_rows):
    """With long days cut in pieces or not, with peers broadcast or masks."""
    monkeypatch.setattr(series, "DAY_ROWS", day_rows)
    plain = series.competitor_days
    monkeypatch.setattr(series, "competitor_days", lambda *args: plain(*args, peer_rows=peer_rows))
    review, business, biz_cat, rows, businesses, cats = competitor_tables(spark)
    got = series.competitor_trend(review, business, biz_cat, "2015-01-03").toPandas()
    own = {b: {c for x, c in cats if x == b} for b, _ in businesses}
    pdf = pd.DataFrame(rows, columns=["business_id", "date", "review_id", "stars"])
    city = dict(businesses)
    assert set(got.business_id) == {b for b in own if city[b]}
    for b in ("b01", "b02", "b13"):
        peers = [p for p in own if city[p] == city[b] and own[p] & own[b]]
        one = pdf[pdf.business_id.isin(peers)].sort_values(["date", "review_id"])
        one["avg"] = one.stars.ewm(span=28).mean()
        one["date"] = pd.to_datetime(one.date)
        want = one.groupby("date").avg.last().resample("D").ffill()["2015-01-03":]
        mine = got[got.business_id == b].sort_values("date")
        assert list(pd.to_datetime(mine.date)) == list(want.index)
        assert abs(mine.avg_rating.to_numpy() - want.to_numpy()).max() < 1e-9


@pytest.mark.parametrize("day_rows", [series.DAY_ROWS, 30])
@pytest.mark.parametrize("span", [1, 5])
def test_rating_trend_of_long_days(spark, monkeypatch, day_rows, span):
    monkeypatch.setattr(series, "DAY_ROWS", day_rows)
    review, *_, rows, _, _ = competitor_tables(spark, 9)
    one_day = review.withColumn("business_id", F.lit("hot"))
    got = series.rating_trend(one_day, "2015-01-01", span).toPandas().sort_values("date")
    pdf = pd.DataFrame(rows, columns=["business_id", "date", "review_id", "stars"]).sort_values(["date", "review_id"])
    pdf["avg"] = pdf.stars.ewm(span=span).mean()
    pdf["date"] = pd.to_datetime(pdf.date)
    want = pdf.groupby("date").avg.last().resample("D").ffill()
    assert abs(got.avg_rating.to_numpy() - want.to_numpy()).max() < 1e-9


def test_repeats_of_reviews_are_not_shuffled(spark):
    """Between the one exchange of reviews and the summaries no exchange sees a review per peer group."""
    review, business, biz_cat, *_ = competitor_tables(spark)
    focal, members, peers = series.peer_groups(business, biz_cat)
    plan = series.competitor_days(review, members, peers, 0.9)._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("peer_group") if "Exchange hashpartitioning(city" not in plan else plan.index("Exchange hashpartitioning(city")]
    assert "Window" in above and "Exchange hashpartitioning" not in above
