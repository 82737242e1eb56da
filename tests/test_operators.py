import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.functions import columns as X
from reviewloom.functions.text import blank_words, corpus_text, ngrams, tokenize
from reviewloom.operators import aggregates as A, categories as C, corpus as T, filters as P, ranking as K
from reviewloom.operators import reviewwords as R
from reviewloom.operators.checkins import checkin_profile
from reviewloom.operators.overlap import customer_overlap, overlap_counts
from reviewloom.operators.ranking import top_overlap


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr.alias("o")).first().o


# ---- expressions

def test_sanitized_keys_keep_the_last(spark):
    got = one(spark, X.sanitize_keys("v"), {"a b": "1", "c": "2", "a,b": "3", "x{y}=(z);": "4"}, "map<string,string>")
    assert got == {"a_b": "3", "c": "2", "x_y___z__": "4"}


def test_empty_list_gives_no_row(spark):
    df = spark.createDataFrame([("a", []), ("b", ["x", "y"])], "k string, l array<string>")
    assert [(r.k, r.l_value) for r in X.explode_list(df, "l").collect()] == [("b", "x"), ("b", "y")]


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 2)], "a int, b int").select(X.safe_ratio("a", "b").alias("r"))
    assert [r.r for r in df.collect()] == [None, 0.5]


def test_search_with_signs_in_the_name(spark):
    df = spark.createDataFrame(
        [("50% off; Joe's", "1"), ("500 Joes", "2")], "name string, business_id string"
    ).selectExpr("*", "'c' city", "'s' state", "1.0D stars", "1L review_count", "array('x') categories")
    assert [r.business_id for r in P.search_names(df, "50%").collect()] == ["1"]
    assert P.search_names(df, "joe's").count() == 1
    assert P.search_names(df, "50%", wildcards=True).count() == 2
    assert P.search_names(df, "").count() == 0


def test_star_bands_differ_from_classes(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 6)], "stars int")
    assert [r.stars for r in P.star_band(df, "bad").collect()] == [1, 2]
    assert [r.stars for r in P.star_band(df, "good").collect()] == [4, 5]
    assert [r.b for r in df.select(X.binarize_stars("stars").alias("b")).collect()] == [0, 0, 0, 1, 1]


def test_accents_split_words(spark):
    assert one(spark, tokenize("v"), "Café au lait, 2x!") == ["caf", "au", "lait", "2x"]


def test_corpus_order_of_steps(spark):
    text = "I don't think the 3 cafés' don’t-miss Tacos;  can't be beat!"
    assert one(spark, corpus_text("v"), text) == "think cafés don’tmiss tacos beat"


def test_bigrams(spark):
    assert one(spark, ngrams(blank_words("v")), "a b c") == ["a b", "b c"]
    assert one(spark, ngrams(blank_words("v")), "a") == []
    assert one(spark, ngrams(blank_words("v")), "") == []


STEMS = dict([
    ("happy", "happi"), ("vegas", "vega"), ("service", "servic"), ("really", "realli"), ("definitely", "definit"),
    ("consistency", "consist"), ("knackeries", "knackeri"), ("relational", "relat"), ("hopping", "hop"), ("by", "by"),
    ("generate", "generat"), ("skies", "sky"), ("ties", "tie"), ("agreed", "agre"), ("", ""), ("controlling", "control"),
    ("yyy", "yyi"), ("'early", "earli"), ("dogs'", "dog"), ("ayyyying", "ayyyi"), ("communism", "communism"), ("outing", "outing"),
])


def test_stems(spark):
    words = spark.createDataFrame([(w,) for w in [*STEMS, *STEMS]], "word string")
    assert {r.word: r.stem for r in T.word_stems(words, "word").collect()} == STEMS


def test_stems_stay_in_their_place(spark):
    texts = spark.createDataFrame([(1, "happy ties happy"), (2, ""), (3, "by")], "doc int, t string")
    assert sorted(map(tuple, T.stem_texts(texts, "doc", "t").collect())) == [(1, "happi tie happi"), (2, ""), (3, "by")]


# ---- aggregates

@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.85, 0.99, 1.0])
@pytest.mark.parametrize("size", [1, 2, 7, 20, 101, 30_011])
def test_quantile_is_exact(spark, q, size):
    rng = random.Random(size)
    values = [rng.randrange(1 + size // 3) for _ in range(size)]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    assert A.quantile(df, "v", q).first().quantile == pytest.approx(np.quantile(values, q), abs=1e-9)


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 9, 10)], "v double")
    got = {r.bin: r.n for r in A.histogram(df, "v", 5).collect()}
    want, _ = np.histogram([0, 1, 2, 9, 10], 5)
    assert [got[i] for i in range(5)] == list(want)


def test_tokens_of_a_key_keep_document_order(spark):
    df = spark.createDataFrame([("k", i, [f"w{i}"]) for i in range(25)], "k string, d int, tokens array<string>")
    rows = A.tokens_per_key(df, "k", "d", docs_per_row=10).orderBy("chunk").collect()
    assert [len(r.tokens) for r in rows] == [10, 10, 5]
    assert sum((r.tokens for r in rows), []) == [f"w{i}" for i in range(25)]


def test_profile_has_every_slot_and_equal_sums(spark):
    df = spark.createDataFrame([("a", {"23-0": 2, "0-6": 1}), ("b", {"5-3": 4})], "business_id string, checkin_info map<string,bigint>")
    rows = checkin_profile(df).collect()
    assert len(rows) == 2 * (7 + 24)
    for key, total in (("a", 3), ("b", 4)):
        for part in ("day", "hour"):
            assert sum(r.checkins for r in rows if (r.business_id, r.part) == (key, part)) == total
    assert [r.label for r in rows if r.business_id == "a" and r.part == "day" and r.checkins] in (["Sun", "Sat"], ["Sat", "Sun"])


def test_drop_largest_of_ties(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("c", 5)], "k string, n int")
    assert {r.k for r in K.drop_largest(df, "n", "k").collect()} == {"a", "c"}


# ---- overlap

def test_overlap_equals_plain_self_join(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        user = 0 if i % 3 == 0 else rng.randrange(1, 40)  # one user wrote a third of the reviews
        rows.append((user, rng.randrange(25), rng.randrange(1, 6)))
    review = spark.createDataFrame(rows, "user_id int, business_id int, stars int").cache()
    business = spark.createDataFrame([(i, f"name{i % 10}") for i in range(25)], "business_id int, name string")
    a, b = review.alias("a"), review.alias("b")
    naive = (
        a.join(b, (F.col("a.user_id") == F.col("b.user_id")) & (F.col("a.business_id") != F.col("b.business_id")))
        .join(business.alias("n"), F.col("n.business_id") == F.col("b.business_id"))
        .groupBy("a.business_id", "n.name")
        .agg(F.count("*").alias("review"), F.count_if(F.col("a.stars") >= 4).alias("good_reviews"),
             F.count_if(F.col("a.stars") <= 2).alias("bad_reviews"))
    )
    got = overlap_counts(review, business)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, naive.collect()))


@pytest.mark.parametrize("users, names, n", [(40, 1000, 15), (40, 3, 4), (4, 2, 1)])
def test_slices_of_hot_users_do_not_change_the_overlap(spark, monkeypatch, users, names, n):
    rng = random.Random(users + n)
    rows = [(0 if i % 3 == 0 else rng.randrange(1, users), rng.randrange(60), rng.randrange(1, 6)) for i in range(900)]
    review = spark.createDataFrame(rows, "user_id int, business_id int, stars int")
    business = spark.createDataFrame([(i, f"name{i % 23:02d}") for i in range(60)], "business_id int, name string")
    monkeypatch.setattr("reviewloom.operators.overlap.SLICE", 10**6)
    plain = top_overlap(overlap_counts(review, business), n).cache()
    plain.count()
    monkeypatch.setattr("reviewloom.operators.overlap.SLICE", names)
    got = customer_overlap(review, business, n)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    some = spark.createDataFrame([(3,), (7,)], "business_id int")
    got = customer_overlap(review, business, n, ids=some)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.filter("business_id in (3, 7)").collect()))


# ---- categories

def cells(spark, rows):
    return spark.createDataFrame(rows, "business_id int, categories_value string")


def brute_clusters(overlap, cut):
    names = sorted({i for i, _, _ in overlap})
    vector = {n: {j: s for i, j, s in overlap if i == n} for n in names}
    label = {n: n for n in names}
    for a in names:
        for b in names:
            keys = set(vector[a]) | set(vector[b])
            if math.sqrt(sum((vector[a].get(k, 0) - vector[b].get(k, 0)) ** 2 for k in keys)) <= cut + 1e-12:
                la, lb = sorted((label[a], label[b]))
                label = {n: la if v == lb else v for n, v in label.items()}
    return label


@pytest.mark.parametrize("cut", [0.3, 0.8, 1.2, 1.45, 1.6, 2.5])
def test_clusters_equal_all_pairs(spark, cut):
    rng = random.Random(11)
    rows = [(b, c) for b in range(60) for c in rng.sample("abcdefghijkl", 1 + b % 2)]
    overlap = C.category_overlap(cells(spark, rows), min_count=0)
    flat = [tuple(r) for r in overlap.collect()]
    assert all(0 <= s <= 1 for _, _, s in flat) and all(s == 1 for i, j, s in flat if i == j)
    got = {r.i: r.component for r in C.category_clusters(overlap, cut).collect()}
    assert got == brute_clusters(flat, cut)


# ---- words

def test_telling_words_equal_naive_bayes(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer

    rng = random.Random(5)
    vocab = [f"word{i}" for i in range(80)]
    rows = [("x", i, rng.randrange(1, 6), " ".join(rng.choices(vocab, k=12))) for i in range(60)]
    rows += [("only good", 1000 + i, 5, "fine food") for i in range(5)]
    review = spark.createDataFrame(rows, "business_id string, review_id int, stars int, text string")
    mine = {r.word: r for r in R.word_ratios(review).collect()}
    docs = review.filter("business_id = 'x'").select(X.binarize_stars("stars").alias("label"), tokenize("text").alias("t"))
    counter = CountVectorizer(inputCol="t", outputCol="features").fit(docs)
    theta = np.exp(NaiveBayes(smoothing=1.0).fit(counter.transform(docs)).theta.toArray())
    assert set(mine) == set(counter.vocabulary)
    for i, word in enumerate(counter.vocabulary):
        assert mine[word].p_bad == pytest.approx(theta[0][i], abs=1e-12)
        assert mine[word].p_good == pytest.approx(theta[1][i], abs=1e-12)
    telling = R.telling_words(review).collect()
    assert {r.business_id for r in telling} == {"x"}
    best = max(mine.values(), key=lambda r: (r.ratio, )).ratio
    top = [r for r in telling if r.part == "good" and r.frequency == 60.0]
    assert top and all(mine[r.word].ratio == pytest.approx(best) for r in top)


def test_tfidf_rows_have_length_one(spark):
    dtm = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("b", "y", 3), ("c", "z", 1)], "d string, term string, n long")
    for variant in ("log2", "smooth"):
        got = T.tfidf(dtm, variant, "d").groupBy("d").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
        assert len(got) == 3 and all(r.s == pytest.approx(1.0) for r in got)


def test_a_part_without_terms_counts(spark):
    """A term is in all parts only if no part lacks it, also where a part keeps no term at all."""
    from reviewloom.operators.corpus import drop_sparse

    docs = spark.createDataFrame([(i,) for i in range(4)], "review_id int")
    dtm = spark.createDataFrame([(0, "a", 1), (1, "a", 1)], "review_id int, term string, n int")
    assert drop_sparse(dtm, docs, 0.5, part_rows=2).count() == 2
    assert drop_sparse(dtm, docs, 0.5, part_rows=2, in_all_parts=True).count() == 0


def test_every_rated_user_gets_recommendations(spark):
    from reviewloom.operators.recommend import fit_recommender, recommend

    rng = random.Random(3)
    rows = [(u, b, rng.randint(1, 5)) for u in range(40) for b in rng.sample(range(12), 2)]
    review = spark.createDataFrame(rows, "user_id int, business_id int, stars int")
    got = recommend(review, n=3, rank=2, max_iter=2)
    assert {(r.user_id, r["rank"]) for r in got.collect()} == {(u, k) for u in range(40) for k in (1, 2, 3)}
    lone = spark.createDataFrame([(1, 1, 5)], review.schema)
    assert fit_recommender(lone, rank=2, max_iter=1).rmse is None


def test_handles_and_files_are_told_apart(spark, tmp_path):
    from pyspark.sql import types as T

    from reviewloom.sources.tables import forget, open_table, read_text_dir

    path = f"{tmp_path}/t.parquet"
    for n in (3, 5):
        spark.range(n).write.mode("overwrite").parquet(path)
        forget(spark, path)
        assert open_table(spark, path).count() == n
    assert open_table(spark.newSession(), path).sparkSession is not spark
    assert open_table(spark, path, T.StructType([T.StructField("other", T.LongType())])).columns == ["other"]
    for folder in ("x/a", "x/b"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "same.txt").write_text(folder)
    assert read_text_dir(spark, f"{tmp_path}/x").select("file_name").distinct().count() == 2


def test_scratch_needs_a_shared_folder(spark):
    from unittest.mock import MagicMock

    from reviewloom.session import shared_dir

    far = MagicMock()
    far.conf.get.side_effect = lambda key, default=None: {"spark.master": "yarn"}.get(key, default)
    far.sparkContext.getCheckpointDir.return_value = None
    with pytest.raises(ValueError):
        shared_dir(far)


def test_a_term_of_all_documents_is_spread(spark):
    from reviewloom.operators.joins import spread_join

    rows = spark.range(4000).selectExpr("id AS review_id", "'all' AS term", "1 AS n")
    table = spark.createDataFrame([("all", 2.0), ("other", 1.0)], "term string, w double")
    for name, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
        spark.conf.set(name, value)
    try:
        met = spread_join(rows, table, "term", "review_id").withColumn("p", F.spark_partition_id())
        assert met.count() == 4000 and met.select("p").distinct().count() > 1
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled"):
            spark.conf.unset(name)


def test_vectors_hold_the_counts(spark):
    from reviewloom.operators.topics import doc_vectors, term_table

    rows = [(1, "a", 2), (1, "b", 1), (1, "a", 3), (2, "c", 4), (3, "new", 1), (4, None, 5), (2, "b", 0)]
    dtm = spark.createDataFrame(rows, "review_id int, term string, n long")
    terms, size = term_table(dtm.filter("term <> 'new'"))
    names = {r["index"]: r.term for r in terms.collect()}
    got = {r.review_id: {names[i]: x for i, x in zip(r.features.indices.tolist(), r.features.values)} for r in doc_vectors(dtm, terms, size).collect()}
    assert size == 3 and got == {1: {"a": 5.0, "b": 1.0}, 2: {"c": 4.0}}


def test_topics_of_very_many_terms(spark):
    """Terms are a table; one document says all of them."""
    from reviewloom.operators.topics import fit_topics, topic_terms

    one = spark.range(300_000).select(F.lit("all").alias("review_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("term"), F.lit(1).alias("n"))
    few = spark.range(2000).select((F.col("id") % 50).cast("string").alias("review_id"), F.concat(F.lit("t"), (F.col("id") % 70).cast("string")).alias("term"), F.lit(30).alias("n"))
    fitted = fit_topics(one.unionByName(few), 2, seeds=[5], iterations=2)
    assert fitted.size == 300_000 and topic_terms(fitted, 3).count() == 6
