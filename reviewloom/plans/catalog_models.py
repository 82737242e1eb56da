"""Registered queries: topic models, recommendations, and the composite jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window as W, functions as F

from reviewloom.operators import corpus as T, gibbs as G, recommend as M, reviewwords as R, topics as L
from reviewloom.operators.checkins import total_checkins
from reviewloom.plans import fixtures as V, report as O
from reviewloom.plans.catalog_text import _BIGRAMS, _TOKENS
from reviewloom.plans.etl import restaurant_etl, restaurant_tables
from reviewloom.plans.registry import query
from reviewloom.plans.stored_report import StoredReport, touched_businesses
from reviewloom.session import cut_lineage, scratch_path
from reviewloom.sources.tables import load_table


def r6(col):
    return F.round(col, 6)


# ---- models: random by nature, so without SQL

def _bigrams(spark, sf):
    dtm = T.bigram_dtm(V.text_review(spark, sf), sparsity=None)
    return cut_lineage(T.prune_bigrams(dtm, 10), "bigrams")


def _unigrams(spark, sf):
    review = V.text_review(spark, sf)
    dtm = T.doc_terms(T.corpus_tokens(T.clean_corpus(review), "review_id"))
    return cut_lineage(T.drop_sparse(dtm, review, 0.95), "unigrams")


@query("t18_t19_unigram_topics")
def _(spark, sf):
    fitted = L.fit_topics(_unigrams(spark, sf), 5)
    return L.topic_terms(fitted, 6)


@query("t18_t19_bigram_topics")
def _(spark, sf):
    fitted = L.fit_topics(_bigrams(spark, sf), 8)
    return L.topic_terms(fitted, 10, wide=True)


@query("t20_topic_probs")
def _(spark, sf):
    dtm = _bigrams(spark, sf)
    fitted = L.fit_topics(dtm, 8)
    return L.topic_probs(fitted, dtm, V.text_review(spark, sf))


_PLAIN_BIGRAMS = f"WITH {_BIGRAMS}, tt AS (SELECT term FROM dtm GROUP BY 1 HAVING sum(n) >= 10) "


@query("t20_topic_probs_add_up", _PLAIN_BIGRAMS + """
SELECT review_id, business_id, true AS adds_up, true AS topic_is_largest FROM v_text_review
WHERE review_id IN (SELECT review_id FROM dtm WHERE term IN (SELECT term FROM tt))""")
def _(spark, sf):
    dtm = cut_lineage(T.prune_bigrams(T.bigram_dtm(V.text_review(spark, sf), sparsity=None, stem=False), 10, stop=[]), "bigrams")
    probs = L.topic_probs(L.fit_topics(dtm, 8), dtm, V.text_review(spark, sf))
    cols = [F.col(f"topic_{i + 1}_prob") for i in range(8)]
    return probs.select(
        "review_id", "business_id", (F.abs(sum(cols[1:], cols[0]) - 1) < 1e-6).alias("adds_up"),
        (F.element_at(F.array(*cols), F.col("topic")) == F.greatest(*cols)).alias("topic_is_largest"),
    )


@query("t18_business_topics")
def _(spark, sf):
    dtm = cut_lineage(V.text_review(spark, sf).select("review_id", "business_id").join(_unigrams(spark, sf), "review_id"), "words")
    bow = cut_lineage(T.bow_by_business(dtm), "business-words")
    return L.topic_terms(L.fit_topics(bow, 100, doc="business_id"), 6)


@query("t18_vectors_hold_all_counts", _PLAIN_BIGRAMS + """
SELECT review_id, term, CAST(sum(n) AS BIGINT) AS n, (SELECT count(*) FROM tt) AS terms FROM dtm WHERE term IN (SELECT term FROM tt) GROUP BY 1, 2""")
def _(spark, sf):
    dtm = cut_lineage(T.prune_bigrams(T.bigram_dtm(V.text_review(spark, sf), sparsity=None, stem=False), 10, stop=[]), "bigrams")
    terms, size = L.term_table(dtm)
    cells = L.vector_cells(L.doc_vectors(dtm, terms, size))
    return cells.join(terms, "index").select("review_id", "term", F.col("n").cast("long").alias("n"), F.lit(size).cast("long").alias("terms"))


# what must hold for the ten topics of all documents, best of five starts
@query("t19_ranks_of_ten_topics", _PLAIN_BIGRAMS + """
SELECT topic, rank, true AS in_order, true AS is_term FROM (SELECT CAST(unnest(range(1, 11)) AS INTEGER) AS topic)
CROSS JOIN (SELECT CAST(unnest(range(1, 1 + least(10, (SELECT count(*) FROM tt)))) AS INTEGER) AS rank)""")
def _(spark, sf):
    dtm = cut_lineage(T.prune_bigrams(T.bigram_dtm(V.text_review(spark, sf), sparsity=None, stem=False), 10, stop=[]), "bigrams")
    terms = L.topic_terms(L.fit_topics(dtm, 10), 10)
    before = F.lag("weight").over(W.partitionBy("topic").orderBy("rank"))
    known = dtm.select("term").distinct().withColumn("known", F.lit(True))
    ranked = terms.join(known, "term", "left").withColumn("before", before)
    return ranked.select(
        "topic", "rank", F.coalesce(F.col("before") >= F.col("weight"), F.lit(True)).alias("in_order"), F.coalesce("known", F.lit(False)).alias("is_term")
    )


@query("t18_t19_ten_topics")
def _(spark, sf):
    return L.topic_terms(L.fit_topics(_unigrams(spark, sf), 10), 10, wide=True)


# Gibbs sampling, all five starts; the second query holds whatever the number of sweeps
@query("t18_t19_gibbs_topics")
def _(spark, sf):
    return G.gibbs_terms(G.gibbs_topics(_unigrams(spark, sf), 5, burn_in=20, sweeps=10), 6)


@query("t18_gibbs_counts_add_up", _PLAIN_BIGRAMS + """, pr AS (SELECT review_id, term, n FROM dtm WHERE term IN (SELECT term FROM tt))
SELECT 'term' AS kind, term AS id, CAST(sum(n) AS BIGINT) AS n, true AS shares_fit FROM pr GROUP BY term
UNION ALL SELECT 'review', CAST(review_id AS VARCHAR), CAST(sum(n) AS BIGINT), true FROM pr GROUP BY review_id""")
def _(spark, sf):
    dtm = cut_lineage(T.prune_bigrams(T.bigram_dtm(V.text_review(spark, sf), sparsity=None, stem=False), 10, stop=[]), "bigrams")
    fitted = G.gibbs_topics(dtm, 8, burn_in=2, sweeps=2, thin=1)
    words, docs = fitted.word_topics, fitted.doc_topics
    whole = words.groupBy("topic").agg((F.abs(F.sum("weight") - 1) < 1e-6).alias("fits"))
    return (
        words.join(F.broadcast(whole), "topic").groupBy(  # 8 rows
            F.lit("term").alias("kind"), F.col("term").alias("id")
        ).agg(F.sum("n").alias("n"), F.bool_and("fits").alias("shares_fit"))
        .unionByName(
            docs.groupBy(F.lit("review").alias("kind"), F.col("review_id").cast("string").alias("id"))
            .agg(F.sum("n").alias("n"), (F.abs(F.sum("prob") - 1) < 1e-6).alias("shares_fit"))
        )
    )


@query("t22_ranks_of_all_users", """
SELECT user_id, CAST(k.k AS INTEGER) AS rank FROM (SELECT DISTINCT user_id FROM v_review) u,
 (SELECT unnest(range(1, 1 + least(10, (SELECT count(DISTINCT business_id) FROM v_review)))) AS k) k""")
def _(spark, sf):
    return M.recommend(V.review(spark, sf), 10).select("user_id", "rank")


@query("t22_pruned_scores_agree", """
SELECT user_id, least(10, (SELECT count(DISTINCT business_id) FROM v_review)) AS ranks, true AS agrees FROM v_review GROUP BY 1""")
def _(spark, sf):
    return M.retrieval_agreement(M.fit_recommender(V.review(spark, sf)), 10)


@query("t5_holdout_accuracy_model")
def _(spark, sf):
    text = R.holdout_accuracy_model(V.text_review(spark, sf), "src3")
    return spark.createDataFrame([("src3", text)], "business_id string, accuracy string")


@query("t22_recommend")
def _(spark, sf):
    return M.recommend(V.review(spark, sf), 10)


@query("t22_rating_matrix", """
SELECT user_id, business_id, round(avg(stars), 6) AS stars FROM v_review GROUP BY 1, 2""")
def _(spark, sf):
    ratings, _, _ = M.rating_matrix(V.review(spark, sf))
    return ratings.select("user_id", "business_id", r6(F.col("stars").cast("double")).alias("stars"))


# ---- composites

@query("o8_restaurant_tables", """
WITH r AS (SELECT business_id FROM v_business WHERE len(list_filter(categories, lambda c: contains(c, 'Restaurants'))) > 0)
SELECT 'business' AS name, count(*) AS n FROM r
UNION ALL SELECT 'business_category', count(*) FROM v_business_category
UNION ALL SELECT 'business_cleaned', count(*) FROM v_business
UNION ALL SELECT 'checkin', count(*) FROM v_total WHERE business_id IN (SELECT business_id FROM r)
UNION ALL SELECT 'review', count(*) FROM v_review_part WHERE business_id IN (SELECT business_id FROM r)
UNION ALL SELECT 'total_checkins', count(*) FROM v_total""")
def _(spark, sf):
    brand = F.create_map(F.lit("Brand Name"), F.col("state"), F.lit("Brand,Name"), F.col("city"))
    out = restaurant_tables({
        "business": V.business(spark, sf).withColumn("attributes", brand),
        "checkin": V.checkin(spark, sf),
        "review": V.review_part(spark, sf, users=False),
    })
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in out.items()]
    whole = counts[0]
    for part in counts[1:]:
        whole = whole.unionByName(part)
    return whole


@query("o8_business_category", """
SELECT business_id, categories_value FROM v_business_category""")
def _(spark, sf):
    business = V.business(spark, sf).withColumn("attributes", F.create_map(F.lit("a b"), F.col("city")))
    return restaurant_tables({"business": business})["business_category"]


@query("o8_etl_from_json", """
WITH r AS (SELECT business_id FROM v_business WHERE len(list_filter(categories, lambda c: contains(c, 'Restaurants'))) > 0),
a AS (SELECT 'business_cleaned' AS name, business_id,
  concat_ws('|', name, city, state, list_aggregate(categories, 'string_agg', ','), 'Brand_Name', state) AS value FROM v_business
UNION ALL SELECT 'business_category', business_id, categories_value FROM v_business_category
UNION ALL SELECT 'total_checkins', business_id, CAST(total_checkins AS VARCHAR) FROM v_total
UNION ALL SELECT 'checkin', business_id, concat_ws('-', hour, day, n) FROM v_slot WHERE business_id IN (FROM r)
UNION ALL SELECT 'tip', review_id + 1, md5(text) FROM v_text_review WHERE review_id + 1 IN (FROM r)
UNION ALL SELECT 'photo', c_custkey, 'photo' || c_custkey FROM customer WHERE c_custkey IN (FROM r)
UNION ALL SELECT 'review', business_id, concat_ws('|', review_id, stars, CAST(date AS VARCHAR), funny, useful, cool) FROM v_review_part WHERE business_id IN (FROM r))
SELECT name, CAST(business_id AS VARCHAR) AS business_id, value FROM a
UNION ALL SELECT 'business', CAST(business_id AS VARCHAR), value FROM a WHERE name = 'business_cleaned' AND business_id IN (FROM r)""")
def _(spark, sf):
    """Raw JSON files of all five tables, the ETL over them, and the contents of every table it wrote."""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "restaurants")
    key = F.col("business_id").cast("string").alias("business_id")
    text, customer = V.text_review(spark, sf), V.raw(spark, sf, "customer")
    brand = F.create_map(F.lit("Brand Name"), F.col("state"))
    lines = {
        "business": V.business(spark, sf).select(key, "name", "city", "state", "stars", "review_count", "categories", brand.alias("attributes")),
        "checkin": V.checkin(spark, sf).select(key, "checkin_info"),
        "tip": text.select((F.col("review_id") + 1).cast("string").alias("business_id"), "text"),
        "review": V.review_part(spark, sf, users=False).select(
            "review_id", key, "stars", F.col("date").cast("string").alias("date"), "votes"),
    }
    for name, df in lines.items():
        df.write.option("compression", "gzip").json(f"{raw}/{name}.json")
    photo = F.struct(F.col("c_custkey").cast("string").alias("business_id"), F.concat(F.lit("photo"), F.col("c_custkey").cast("string")).alias("photo_id"))
    arrays = customer.groupBy(F.floor(F.col("c_custkey") / 1000)).agg(F.to_json(F.collect_list(photo)).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(f"{raw}/photo.json")
    restaurant_etl(spark, raw, out)
    value = {
        "business": F.concat_ws("|", "name", "city", "state", F.array_join("categories", ","), F.map_keys("attributes")[0], F.map_values("attributes")[0]),
        "business_category": F.col("categories_value"), "total_checkins": F.col("total_checkins").cast("string"),
        "checkin": F.explode(F.transform(F.map_entries("checkin_info"), lambda e: F.concat_ws("-", e["key"], e["value"].cast("string")))),
        "tip": F.md5(F.col("text").cast("binary")), "photo": F.col("photo_id"),
        "review": F.concat_ws("|", "review_id", F.col("stars").cast("string"), "date", *[F.col(f"votes.{v}").cast("string") for v in ("funny", "useful", "cool")]),
    }
    value["business_cleaned"] = value["business"]
    parts = [load_table(spark, f"{out}/{n}.parquet").select(F.lit(n).alias("name"), key, v.alias("value")) for n, v in value.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _tables(spark, sf):
    suppliers = V.supplier_business(spark, sf)
    stats = V.review(spark, sf, users=False).groupBy("business_id").agg(
        F.avg("stars").alias("stars"), F.count(F.lit(1)).alias("review_count")
    )
    # documents belong to numbered sources; the number stands for the business
    text = V.text_review(spark, sf).withColumn("business_id", F.replace("business_id", F.lit("src"), F.lit("")).cast("long"))
    return {
        "business": suppliers.join(stats, "business_id", "left"), "review": V.review(spark, sf),
        "checkin": V.checkin(spark, sf), "text_review": text,
    }


@query("o9_report")
def _(spark, sf):
    return O.report(_tables(spark, sf), V.CUT_DATE)


@query("o9_report_of_some")
def _(spark, sf):
    tables = _tables(spark, sf)
    return O.report(tables, V.CUT_DATE, ids=tables["business"].filter(F.col("state") == "EUROPE").select("business_id"))


@query("o9_refreshed_report", f"""
WITH d AS (SELECT business_id, date, count(*) AS n FROM v_review GROUP BY 1, 2),
g AS (SELECT business_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM d GROUP BY 1),
s AS (SELECT g.business_id, g.date, CAST(sum(coalesce(n, 0)) OVER (PARTITION BY g.business_id ORDER BY g.date) AS BIGINT) AS c
 FROM g LEFT JOIN d ON d.business_id = g.business_id AND d.date = g.date),
e AS (SELECT business_id, CAST(to_json({{'date': list(CAST(date AS VARCHAR) ORDER BY date), 'review_count': list(c ORDER BY date)}}) AS VARCHAR) AS review_count_series
 FROM s WHERE date >= DATE '{V.CUT_DATE}' GROUP BY 1),
p AS (SELECT a.business_id, b.name, count(*) AS review, count(*) FILTER (a.stars >= 4) AS good, count(*) FILTER (a.stars <= 2) AS bad
 FROM v_review a JOIN v_review r ON r.user_id = a.user_id AND r.business_id <> a.business_id JOIN v_supplier_business b ON b.business_id = r.business_id GROUP BY 1, 2),
t AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY business_id ORDER BY review DESC, name) <= 15),
o AS (SELECT business_id, CAST(to_json({{'name': list(name ORDER BY review DESC, name), 'good_reviews': list(good ORDER BY review DESC, name),
 'bad_reviews': list(bad ORDER BY review DESC, name)}}) AS VARCHAR) AS overlap FROM t GROUP BY 1)
SELECT v.business_id, v.name, coalesce(total_checkins, 0) AS checkins, review_count_series, overlap FROM v_supplier_business v
 LEFT JOIN v_total USING (business_id) LEFT JOIN e USING (business_id) LEFT JOIN o USING (business_id)""")
def _(spark, sf):
    """A stored report of the reviews up to the last week, refreshed for the businesses that the last week touches."""
    now = {"business": V.supplier_business(spark, sf), "review": V.review(spark, sf), "checkin": V.checkin(spark, sf)}
    late = F.col("date") > F.date_sub(now["review"].agg(F.max("date")).scalar(), 7)
    stored = StoredReport(spark, scratch_path(spark, "report"), "first", V.CUT_DATE, buckets=64)
    stored.write(now | {"review": now["review"].filter(~late)}, ["summary", "count", "overlap"])
    stored.refresh(now, touched_businesses(now["review"], now["review"].filter(late)), "last week")
    return stored.read().select("business_id", "name", "checkins", "review_count_series", "overlap")


@query("t3_words_of_all_kinds", "WITH " + _TOKENS + """, c AS (SELECT business_id, word, unnest([{'kind': 'all', 'n': count(*)},
 {'kind': 'good', 'n': count(*) FILTER (stars >= 4)}, {'kind': 'bad', 'n': count(*) FILTER (stars < 3)}], recursive := true) FROM w GROUP BY 1, 2)
SELECT business_id, kind, word, round(n / max(n) OVER (PARTITION BY business_id, kind) * 60.0::DOUBLE, 6) AS frequency FROM c WHERE n > 0
QUALIFY row_number() OVER (PARTITION BY business_id, kind ORDER BY n DESC, word) <= 35""")
def _(spark, sf):
    return R.top_words_of_all_kinds(R.word_summary(V.text_review(spark, sf))).withColumn("frequency", r6("frequency"))


@query("o9_summary_of_report", """
SELECT business_id, name, city, state, coalesce(total_checkins, 0) AS checkins FROM v_supplier_business LEFT JOIN v_total USING (business_id)""")
def _(spark, sf):
    return O.business_summary(V.supplier_business(spark, sf), total_checkins(V.checkin(spark, sf)))


@query("o9_count_series", f"""
WITH d AS (SELECT business_id, date, count(*) AS n FROM v_review GROUP BY 1, 2),
g AS (SELECT business_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM d GROUP BY 1),
s AS (SELECT g.business_id, g.date, CAST(sum(coalesce(n, 0)) OVER (PARTITION BY g.business_id ORDER BY g.date) AS BIGINT) AS c
 FROM g LEFT JOIN d ON d.business_id = g.business_id AND d.date = g.date)
SELECT business_id, CAST(to_json({{'date': list(CAST(date AS VARCHAR) ORDER BY date), 'review_count': list(c ORDER BY date)}}) AS VARCHAR) AS review_count_series
FROM s WHERE date >= DATE '{V.CUT_DATE}' GROUP BY 1""")
def _(spark, sf):
    return O.count_json(V.review(spark, sf, users=False), V.CUT_DATE)


@query("o9_checkins_profile", """
WITH b AS (SELECT DISTINCT business_id FROM v_slot),
d AS (SELECT b.business_id, r.x, ['Sun', 'Mon', 'Tues', 'Wed', 'Thur', 'Fri', 'Sat'][r.x + 1] AS l, CAST(coalesce(sum(n), 0) AS BIGINT) AS c
 FROM b CROSS JOIN range(7) r(x) LEFT JOIN v_slot v ON v.business_id = b.business_id AND v.day = r.x GROUP BY ALL),
h AS (SELECT b.business_id, r.x, CAST(coalesce(sum(n), 0) AS BIGINT) AS c
 FROM b CROSS JOIN range(24) r(x) LEFT JOIN v_slot v ON v.business_id = b.business_id AND v.hour = r.x GROUP BY ALL),
dj AS (SELECT business_id, list(l ORDER BY x) AS dl, list(c ORDER BY x) AS dc FROM d GROUP BY 1),
hj AS (SELECT business_id, list(CAST(x AS INTEGER) ORDER BY x) AS hl, list(c ORDER BY x) AS hc FROM h GROUP BY 1)
SELECT business_id, CAST(to_json({'day': {'day': dl, 'checkins': dc}, 'hour': {'hour': hl, 'checkins': hc}}) AS VARCHAR) AS checkins_profile
FROM dj JOIN hj USING (business_id)""")
def _(spark, sf):
    return O.checkins_json(V.checkin(spark, sf))


@query("o9_overlap_lists", """
WITH p AS (SELECT a.business_id, b.name, count(*) AS review, count(*) FILTER (a.stars >= 4) AS good, count(*) FILTER (a.stars <= 2) AS bad
 FROM v_review a JOIN v_review r ON r.user_id = a.user_id AND r.business_id <> a.business_id JOIN v_supplier_business b ON b.business_id = r.business_id GROUP BY 1, 2),
t AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY business_id ORDER BY review DESC, name) <= 15)
SELECT business_id, CAST(to_json({'name': list(name ORDER BY review DESC, name), 'good_reviews': list(good ORDER BY review DESC, name),
 'bad_reviews': list(bad ORDER BY review DESC, name)}) AS VARCHAR) AS overlap FROM t GROUP BY 1""")
def _(spark, sf):
    return O.overlap_json(V.review(spark, sf), V.supplier_business(spark, sf))
