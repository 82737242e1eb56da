"""One document of each class: no row goes but near copies."""

import random

from pyspark.sql import functions as F

from reviewloom.llm.jaccard import one_of_each

CLASH = ["row", "key", "n", "component_id", "id", "maybe"]


def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


def text(seed, n=60):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10_000)}" for _ in range(n))


def kept(spark, rows):
    df = one_of_each(table(spark, rows))
    assert df.columns == ["doc_id", "text", *CLASH]
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_unrelated_texts_of_one_id_stay(spark):
    rows = [(1, text(1)), (1, text(2)), (2, text(3))]
    assert kept(spark, rows) == sorted(rows, key=repr)


def test_of_repeated_ids_only_near_copies_go(spark):
    rows = [(5, text(1)), (5, text(2)), (-7, text(2) + " end"), (6, text(1)), (6, text(4)), (6, text(4)), (10, text(4)), (9, text(9)),
            (None, text(1)), (None, None), (3, None), (3, ""), (4, None)]
    want = [(5, text(1)), (-7, text(2) + " end"), (6, text(4)), (9, text(9)), (None, text(1)), (None, None), (3, None), (3, ""), (4, None)]
    assert kept(spark, rows) == sorted(want, key=repr)


def test_the_smallest_id_of_a_class_stays(spark):
    rows = [(30, text(1)), (4, text(1)), (200, text(1) + " more"), (8, text(2)), (None, text(2))]
    assert kept(spark, rows) == sorted([(4, text(1)), (8, text(2)), (None, text(2))], key=repr)


def test_empty(spark):
    assert kept(spark, []) == []
