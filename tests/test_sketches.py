"""Sketches of category sets against the exact counts: equal up to the sketch's size, within the stated error beyond."""

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import sketches as S
from reviewloom.operators.aggregates import category_sizes
from reviewloom.operators.categories import category_overlap


def by(frame, *keys):
    return {tuple(r[k] for k in keys): r for r in frame.collect()}


@pytest.fixture(scope="module")
def biz_cat(spark):
    """Categories m2, m3, .. hold the multiples of their number, `one` a single business, `all` everyone."""
    ids = spark.range(1, 20_001).withColumnRenamed("id", "business_id")
    names = F.array_compact(F.array(F.lit("all"), *[F.when(F.col("business_id") % k == 0, F.lit(f"m{k}")) for k in (2, 3, 5, 400)],
                                    F.when(F.col("business_id") == 7, F.lit("one"))))
    return ids.select("business_id", F.explode(names).alias("categories_value"))


def test_exact_up_to_the_size_of_the_sketch(spark, biz_cat):
    sketches = S.set_sketches(biz_cat)
    sizes = by(S.sketched_sizes(sketches), "categories_value")
    want = by(category_sizes(biz_cat), "categories_value")
    assert {k: (r.businesses, r.error) for k, r in sizes.items()} == {k: (r.businesses, 0.0) for k, r in want.items()}
    got, exact = by(S.sketched_overlap(sketches, 100), "i", "j"), by(category_overlap(biz_cat, 100), "i", "j")
    assert set(got) == set(exact) and len(got) == 16
    assert all(got[k].share == pytest.approx(exact[k].share) and got[k].error == 0 for k in exact)


def test_within_the_error_beyond(spark, biz_cat):
    sketches = S.set_sketches(biz_cat, lg=8)
    want = by(category_sizes(biz_cat), "categories_value")
    for k, r in by(S.sketched_sizes(sketches, lg=8), "categories_value").items():
        assert abs(r.businesses - want[k].businesses) <= r.error
    got, exact = by(S.sketched_overlap(sketches, 100, lg=8), "i", "j"), by(category_overlap(biz_cat, 100), "i", "j")
    assert set(got) == set(exact)
    assert all(abs(got[k].share - exact[k].share) <= got[k].error + 1e-9 for k in exact)
    assert any(r.error > 0 for r in got.values())


def test_parts_merge_also_when_they_share_businesses(spark, biz_cat):
    low, high = biz_cat.filter("business_id <= 12000"), biz_cat.filter("business_id > 8000")
    merged = S.merge_sketches(S.set_sketches(low), S.set_sketches(high))
    want = by(category_sizes(biz_cat), "categories_value")
    assert {k: r.businesses for k, r in by(S.sketched_sizes(merged), "categories_value").items()} == {k: r.businesses for k, r in want.items()}


def test_blocks_of_more_categories_than_a_group(spark):
    rows = spark.range(3000).select(F.col("id").alias("business_id"), F.explode(F.array(
        F.concat(F.lit("c"), (F.col("id") % 70).cast("string")), F.concat(F.lit("d"), (F.col("id") % 3).cast("string")))).alias("categories_value"))
    got, exact = by(S.sketched_overlap(S.set_sketches(rows), 0), "i", "j"), by(category_overlap(rows, 0), "i", "j")
    assert set(got) == set(exact) and len(got) == 73 * 73
    assert all(got[k].share == pytest.approx(exact[k].share) for k in exact)


def test_nulls_empty_texts_and_empty_tables(spark):
    rows = spark.createDataFrame([("a", ""), ("a", "x"), ("a", "x"), ("a", None), (None, "x"), ("n", None)], "categories_value string, business_id string")
    sizes = {k[0]: r.businesses for k, r in by(S.sketched_sizes(S.set_sketches(rows)), "categories_value").items()}
    assert sizes == {"a": 2, None: 1, "n": 0}
    assert {(r.i, r.j, r.share) for r in S.sketched_overlap(S.set_sketches(rows), 0).collect()} == {("a", "a", 1.0)}
    none = S.set_sketches(rows.limit(0))
    assert S.sketched_sizes(none).count() == 0 and S.sketched_overlap(none).count() == 0
