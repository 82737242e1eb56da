"""Registered queries: scans and sinks, filters, joins, aggregates, ranks, sets, expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reviewloom.functions import columns as X
from reviewloom.operators import aggregates as A, cohorts, filters as P, joins as J, names as N, ranking as K
from reviewloom.operators.checkins import total_checkins
from reviewloom.plans import fixtures as V
from reviewloom.plans.registry import query
from reviewloom.session import scratch_path
from reviewloom.sources import sinks, tables


def r6(col) -> F.Column:
    return F.round(col, 6)


# ---- scans and sinks: the given tables, written in each format below the shared folder and read back

_REVIEW_FIELDS = T.StructType([
    T.StructField("review_id", T.StringType()), T.StructField("business_id", T.LongType()),
    T.StructField("stars", T.IntegerType()), T.StructField("date", T.StringType()),
])


def _flat_review(spark: SparkSession, sf: str) -> DataFrame:
    return V.review(spark, sf, users=False).select(
        "review_id", "business_id", "stars", X.format_day("date").alias("date")
    )


_FLAT_SQL = "SELECT review_id, business_id, stars, CAST(date AS VARCHAR) AS date FROM v_review"


_BY_NATION = """SELECT n_name, count(*) AS suppliers, round(avg(s_acctbal), 6) AS balance
FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY n_name"""


@query("s1_table_by_name", _BY_NATION)
def _(spark, sf):
    tables.table(spark, sf, "supplier")
    tables.table(spark, sf, "nation")
    return spark.sql(_BY_NATION)


@query("s2_s7_json_lines", _FLAT_SQL)
def _(spark, sf):
    path = scratch_path(spark, "jsonl")
    sinks.write_json(_flat_review(spark, sf), path)
    return tables.read_jsonl(spark, path, _REVIEW_FIELDS)


@query("s3_json_array", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf):
    # files of one array with up to 1,000 records each
    path = scratch_path(spark, "array")
    fields = "event_id long, user_id long, event_type string, value double"
    record = F.struct("event_id", "user_id", "event_type", "value")
    arrays = V.raw(spark, sf, "events").groupBy(F.floor(F.col("event_id") / 1000).alias("part")).agg(
        F.to_json(F.collect_list(record)).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return tables.read_json_array(spark, path, T._parse_datatype_string(fields))


@query("s4_s6_csv", _FLAT_SQL)
def _(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_csv(_flat_review(spark, sf), path)
    return tables.read_csv(spark, path, _REVIEW_FIELDS)


@query("s5_tsv", _FLAT_SQL)
def _(spark, sf):
    path = scratch_path(spark, "tsv")
    sinks.write_csv(_flat_review(spark, sf), path, sep="\t")
    return tables.read_csv(spark, path, _REVIEW_FIELDS, sep="\t")


@query("s8_saved_table", _FLAT_SQL)
def _(spark, sf):
    path = scratch_path(spark, "saved")
    sinks.save_table(_flat_review(spark, sf), path, cluster_by="business_id")
    return tables.load_table(spark, path)


@query("s9_text_dir", "SELECT count(DISTINCT p_partkey // 1000) AS files, CAST(sum(length(p_name)) AS BIGINT) AS chars FROM part")
def _(spark, sf):
    # files of up to 1,000 names each, read whole
    path = scratch_path(spark, "texts")
    names = V.raw(spark, sf, "part").groupBy(F.floor(F.col("p_partkey") / 1000).alias("part")).agg(
        F.array_join(F.collect_list("p_name"), "|").alias("value")
    )
    names.select("value").write.option("maxRecordsPerFile", 1).option("lineSep", "|").text(path)
    docs = tables.read_text_dir(spark, path)
    return docs.agg(
        F.count(F.lit(1)).alias("files"), F.sum(F.length(F.replace("text", F.lit("|"), F.lit("")))).alias("chars")
    )


@query("s10_columns_json", """
SELECT business_id, CAST(to_json({'date': list(CAST(date AS VARCHAR) ORDER BY date), 'n': list(n ORDER BY date)}) AS VARCHAR) AS json
FROM (SELECT business_id, date, count(*) AS n FROM v_review GROUP BY 1, 2) GROUP BY 1""")
def _(spark, sf):
    daily = A.count_by_date(V.review(spark, sf, users=False)).withColumn("date", X.format_day("date"))
    return sinks.as_columns_json(daily, "business_id", ["date"], ["date", "n"])


@query("s11_records_json", """
SELECT business_id, CAST(to_json(list({'review_id': review_id, 'usefulness': useful} ORDER BY useful DESC, review_id)) AS VARCHAR) AS json
FROM (SELECT *, row_number() OVER (PARTITION BY business_id ORDER BY useful DESC, review_id) AS rn FROM v_review)
WHERE rn <= 5 GROUP BY 1""")
def _(spark, sf):
    top = K.top_useful(V.review(spark, sf, users=False)).withColumn("_o", -F.col("usefulness"))
    return sinks.as_records_json(top, "business_id", ["_o", "review_id"], ["review_id", "usefulness"])


_SEARCH_SQL = "SELECT name, business_id, city, state, round(stars, 6) AS stars, review_count, categories FROM v_business"


@query("s12_format_search", """
SELECT business_id, concat_ws(';', name, business_id, city, state, round(stars, 2), review_count,
  array_to_string(list_transform(categories, lambda c: '"' || c || '" '), '')) AS line
FROM v_business WHERE contains(lower(name), 'blue')""")
def _(spark, sf):
    found = P.search_names(V.business(spark, sf), "Blue").withColumn("stars", F.round("stars", 2))
    return sinks.format_search(found)


# ---- filters

@query("f1_for_business", "SELECT review_id, stars, date FROM v_review WHERE business_id = 7")
def _(spark, sf):
    return P.for_business(V.review(spark, sf, users=False), 7).select("review_id", "stars", "date")


@query("f2_search_names", """
SELECT name, business_id, city, state, round(stars, 6) AS stars, review_count FROM v_business
WHERE contains(lower(name), 'red r')""")
def _(spark, sf):
    return P.search_names(V.business(spark, sf), "RED r").drop("categories").withColumn("stars", r6("stars"))


@query("f2_search_wildcards", "SELECT business_id, name FROM v_business WHERE lower(name) LIKE '%r_d%g%'")
def _(spark, sf):
    return P.search_names(V.business(spark, sf), "R_d%g", wildcards=True).select("business_id", "name")


@query("f2_search_by_index", """
SELECT t.text AS asked, name, business_id, city, state, round(stars, 6) AS stars, review_count FROM v_business JOIN
 (VALUES ('red r', false), ('r_d%ing', true), ('gr', false), ('nowhere', false)) t(text, wild)
 ON CASE WHEN wild THEN lower(name) LIKE '%' || t.text || '%' ELSE contains(lower(name), t.text) END""")
def _(spark, sf):
    index = N.build_name_index(V.business(spark, sf), scratch_path(spark, "names"))
    asked = [("red r", False), ("r_d%ing", True), ("gr", False), ("nowhere", False)]
    found = [N.search_index(index, text.upper(), wild).drop("categories").withColumn("asked", F.lit(text)) for text, wild in asked]
    return P.union_parts(found).withColumn("stars", r6("stars"))


@query("f3_star_bands", """
SELECT business_id, count(*) AS all_reviews, count(*) FILTER (stars >= 4) AS good, count(*) FILTER (stars < 3) AS bad
FROM v_review GROUP BY 1""")
def _(spark, sf):
    review = V.review(spark, sf, users=False)
    parts = [P.with_const(P.star_band(review, k), "kind", k) for k in ("all", "good", "bad")]
    kinds = P.union_parts([p.select("business_id", "kind") for p in parts])
    return kinds.groupBy("business_id").agg(*[
        F.count_if(F.col("kind") == k).alias(n) for k, n in (("all", "all_reviews"), ("good", "good"), ("bad", "bad"))
    ])


@query("f4_with_category", "SELECT business_id, name FROM v_business WHERE list_contains(categories, 'Restaurants')")
def _(spark, sf):
    return P.with_category(V.business(spark, sf), "Restaurants").select("business_id", "name")


@query("f5_with_category_like", "SELECT business_id, name FROM v_business WHERE len(list_filter(categories, lambda c: contains(c, 'in'))) > 0")
def _(spark, sf):
    return P.with_category_like(V.business(spark, sf), "in").select("business_id", "name")


@query("f6_keep_ids", """
SELECT business_id, name FROM v_business WHERE business_id IN
(SELECT business_id FROM v_business_category WHERE categories_value = 'Restaurants')""")
def _(spark, sf):
    ids = V.business_category(spark, sf).filter(F.col("categories_value") == "Restaurants")
    return P.keep_ids(V.business(spark, sf), ids).select("business_id", "name")


@query("f7_peers_filter", """
SELECT business_id, categories_value FROM v_business_category
WHERE business_id IN (SELECT business_id FROM v_business WHERE city = 'city_5')
AND categories_value IN (SELECT categories_value FROM v_business_category WHERE business_id = 3)""")
def _(spark, sf):
    cats = V.business_category(spark, sf)
    ids = V.business(spark, sf).filter(F.col("city") == "city_5")
    return P.peers_filter(cats, ids, P.for_business(cats, 3))


@query("f8_having", "SELECT business_id, count(*) AS n FROM v_review GROUP BY 1 HAVING count(*) > 600")
def _(spark, sf):
    return P.having(V.review(spark, sf, users=False), "business_id", F.count(F.lit(1)), 600)


@query("f9_nonzero", "SELECT review_id, CAST(funny AS BIGINT) AS funny FROM v_review WHERE funny <> 0")
def _(spark, sf):
    flat = V.review(spark, sf, users=False).select("review_id", X.vote("votes", "funny").alias("funny"))
    return P.nonzero(flat, "funny")


@query("f12_project", "SELECT business_id AS id, name AS title FROM v_supplier_business")
def _(spark, sf):
    return P.project(V.supplier_business(spark, sf), ["business_id", "name"], {"business_id": "id", "name": "title"})


@query("f13_with_const", "SELECT business_id, categories_value, 1 AS ones FROM v_business_category")
def _(spark, sf):
    return P.with_const(V.business_category(spark, sf), "ones", 1)


@query("f15_since", f"""
SELECT business_id, date, CAST(sum(count(*)) OVER (PARTITION BY business_id ORDER BY date) AS BIGINT) AS upto FROM v_review
GROUP BY business_id, date QUALIFY date >= DATE '{V.CUT_DATE}'""")
def _(spark, sf):
    from pyspark.sql import Window as W

    daily = A.count_by_date(V.review(spark, sf, users=False))
    upto = F.sum("n").over(W.partitionBy("business_id").orderBy("date").rowsBetween(W.unboundedPreceding, 0))
    return P.since(daily.select("business_id", "date", upto.alias("upto")), "date", V.CUT_DATE)


@query("f16_flag", "SELECT review_id, stars, stars > 3 AS liked FROM v_review")
def _(spark, sf):
    return P.flag(V.review(spark, sf, users=False).select("review_id", "stars"), "liked", F.col("stars") > 3)


# ---- joins

@query("j1_restrict", """
SELECT review_id, business_id FROM v_review_part WHERE business_id IN
(SELECT business_id FROM v_business WHERE list_contains(categories, 'Restaurants'))""")
def _(spark, sf):
    ids = V.business_category(spark, sf).filter(F.col("categories_value") == "Restaurants")
    return J.restrict(V.review_part(spark, sf, users=False).select("review_id", "business_id"), ids)


@query("j2_with_categories", "SELECT business_id, name, categories_value FROM v_business JOIN v_business_category USING (business_id)")
def _(spark, sf):
    return J.with_categories(V.business(spark, sf).select("business_id", "name"), V.business_category(spark, sf))


@query("j3_restaurant_category_counts", """
SELECT categories_value, count(*) AS n FROM v_business_category WHERE business_id IN
(SELECT business_id FROM v_business_category WHERE categories_value = 'Restaurants') GROUP BY 1""")
def _(spark, sf):
    cats = V.business_category(spark, sf)
    return J.restaurant_category_counts(cats, cats.filter(F.col("categories_value") == "Restaurants"))


@query("j4_left_totals", "SELECT business_id, name, total_checkins FROM v_business LEFT JOIN v_total USING (business_id)")
def _(spark, sf):
    totals = total_checkins(V.checkin(spark, sf))
    return J.left_totals(V.business(spark, sf).select("business_id", "name"), totals)


@query("j5_o6_business_summary", """
SELECT business_id, name, city, state, categories, round(stars, 6) AS stars, review_count,
coalesce(total_checkins, 0) AS checkins FROM v_business LEFT JOIN v_total USING (business_id)""")
def _(spark, sf):
    from reviewloom.plans.report import business_summary

    return business_summary(V.business(spark, sf), total_checkins(V.checkin(spark, sf))).withColumn("stars", r6("stars"))


@query("j6_co_reviews", """
SELECT a.business_id, b.business_id AS other_business_id, count(*) AS pairs FROM v_review a
JOIN v_review b ON a.user_id = b.user_id AND a.business_id <> b.business_id GROUP BY 1, 2""")
def _(spark, sf):
    pairs = J.co_reviews(V.review(spark, sf))
    return pairs.groupBy("business_id", "other_business_id").agg(F.sum(F.col("n") * F.col("other_n")).alias("pairs"))


@query("j6_co_reviews_of_some", """
SELECT a.business_id, b.business_id AS other_business_id, count(*) AS pairs FROM v_review a
JOIN v_review b ON a.user_id = b.user_id AND a.business_id <> b.business_id
WHERE a.business_id IN (SELECT business_id FROM v_supplier_business WHERE state = 'ASIA') GROUP BY 1, 2""")
def _(spark, sf):
    some = V.supplier_business(spark, sf).filter("state = 'ASIA'").select("business_id")
    pairs = J.co_reviews(V.review(spark, sf), ids=some)
    return pairs.groupBy("business_id", "other_business_id").agg(F.sum(F.col("n") * F.col("other_n")).alias("pairs"))


@query("j7_with_name", "SELECT review_id, business_id, name FROM v_review JOIN v_supplier_business USING (business_id)")
def _(spark, sf):
    return J.with_name(V.review(spark, sf, users=False).select("review_id", "business_id"), V.supplier_business(spark, sf))


@query("j8_left_stats", """
SELECT business_id, categories_value, round(avg_stars, 6) AS avg_stars, num_reviews FROM v_business_category
LEFT JOIN (SELECT business_id, avg(stars) AS avg_stars, count(*) AS num_reviews FROM v_review_part GROUP BY 1) USING (business_id)""")
def _(spark, sf):
    stats = A.business_stats(V.review_part(spark, sf, users=False))
    return J.left_stats(V.business_category(spark, sf), stats).withColumn("avg_stars", r6("avg_stars"))


@query("j9_combine", """
SELECT coalesce(a.business_id, b.business_id) AS business_id, num_reviews, total_checkins
FROM (SELECT business_id, count(*) AS num_reviews FROM v_review GROUP BY 1) a
FULL JOIN v_total b ON a.business_id = b.business_id""")
def _(spark, sf):
    counts = A.business_stats(V.review(spark, sf, users=False)).select("business_id", "num_reviews")
    return J.combine(counts, total_checkins(V.checkin(spark, sf)), "business_id")


@query("j11_k10_top_with_names", """
SELECT review_id, r.business_id, funny, name, city FROM
(SELECT review_id, business_id, funny FROM v_review ORDER BY funny DESC, review_id LIMIT 30) r
JOIN v_supplier_business s ON s.business_id = r.business_id""")
def _(spark, sf):
    review = V.review(spark, sf, users=False).select("review_id", "business_id", "votes")
    return K.top_with_names(review, V.supplier_business(spark, sf)).select("review_id", "business_id", "funny", "name", "city")


@query("j12_densify", """
SELECT s.business_id, CAST(d.day AS INTEGER) AS day, CAST(coalesce(sum(n), 0) AS BIGINT) AS checkins
FROM (SELECT DISTINCT business_id FROM v_slot) s CROSS JOIN range(7) d(day)
LEFT JOIN v_slot v ON v.business_id = s.business_id AND v.day = d.day GROUP BY 1, 2""")
def _(spark, sf):
    return A.dense_checkins(A.checkin_slots(V.checkin(spark, sf)), "day")


# ---- aggregates

@query("a1_count_by_date", "SELECT business_id, date, count(*) AS n FROM v_review GROUP BY 1, 2")
def _(spark, sf):
    return A.count_by_date(V.review(spark, sf, users=False))


@query("a2_category_sizes", "SELECT categories_value, count(DISTINCT business_id) AS businesses FROM v_business_category GROUP BY 1")
def _(spark, sf):
    return A.category_sizes(V.business_category(spark, sf))


@query("a3_categories_per_business", """
SELECT categories, count(*) AS businesses FROM
(SELECT business_id, count(DISTINCT categories_value) AS categories FROM v_business_category GROUP BY 1) GROUP BY 1""")
def _(spark, sf):
    return A.categories_per_business_hist(V.business_category(spark, sf))


@query("a4_value_counts", "SELECT city, count(*) AS n FROM v_business GROUP BY 1")
def _(spark, sf):
    return A.value_counts(V.business(spark, sf), "city")


@query("a5_mean_stars_by_category", """
SELECT categories_value, round(avg(stars), 6) AS mean_stars FROM v_business JOIN v_business_category USING (business_id) GROUP BY 1""")
def _(spark, sf):
    joined = J.with_categories(V.business(spark, sf).select("business_id", "stars"), V.business_category(spark, sf))
    return A.mean_stars(joined, "categories_value").withColumn("mean_stars", r6("mean_stars"))


@query("a6_review_total", """
SELECT categories_value, CAST(sum(review_count) AS BIGINT) AS reviews FROM v_business JOIN v_business_category USING (business_id) GROUP BY 1""")
def _(spark, sf):
    joined = J.with_categories(V.business(spark, sf).select("business_id", "review_count"), V.business_category(spark, sf))
    return A.review_total(joined, "categories_value")


@query("a7_reviews_per_business", """
SELECT categories_value, CAST(sum(review_count) AS BIGINT) AS reviews, count(DISTINCT business_id) AS businesses,
round(sum(review_count) / count(DISTINCT business_id), 6) AS reviews_per_business
FROM v_business JOIN v_business_category USING (business_id) GROUP BY 1""")
def _(spark, sf):
    joined = J.with_categories(V.business(spark, sf).select("business_id", "review_count"), V.business_category(spark, sf))
    return A.reviews_per_business(joined, "categories_value").withColumn("reviews_per_business", r6("reviews_per_business"))


@query("a8_checkin_total", """
SELECT business_id, CAST(sum(total_checkins) AS BIGINT) AS checkins FROM v_business_category LEFT JOIN v_total USING (business_id) GROUP BY 1""")
def _(spark, sf):
    return A.checkin_total(V.business_category(spark, sf), total_checkins(V.checkin(spark, sf)))


@query("a8_checkin_total_deduped", """
SELECT business_id, total_checkins AS checkins FROM (SELECT DISTINCT business_id FROM v_business_category) LEFT JOIN v_total USING (business_id)""")
def _(spark, sf):
    return A.checkin_total(V.business_category(spark, sf), total_checkins(V.checkin(spark, sf)), dedupe=True)


@query("a10_city_mean", """
SELECT city, round(avg(stars), 6) AS mean_stars FROM v_business JOIN v_business_category USING (business_id) GROUP BY 1""")
def _(spark, sf):
    return A.city_mean(V.business(spark, sf), V.business_category(spark, sf)).withColumn("mean_stars", r6("mean_stars"))


@query("a10_city_mean_deduped", "SELECT city, round(avg(stars), 6) AS mean_stars FROM v_business GROUP BY 1")
def _(spark, sf):
    means = A.city_mean(V.business(spark, sf), V.business_category(spark, sf), dedupe=True)
    return means.withColumn("mean_stars", r6("mean_stars"))


@query("a10_top_cities_mean", """
WITH t AS (SELECT city, count(*) AS n FROM v_business WHERE list_contains(categories, 'Restaurants') GROUP BY 1 ORDER BY n DESC, city LIMIT 30)
SELECT city, round(avg(stars), 6) AS mean_stars FROM v_business JOIN v_business_category USING (business_id)
WHERE list_contains(categories, 'Restaurants') AND city IN (SELECT city FROM t) GROUP BY 1""")
def _(spark, sf):
    restaurants = P.with_category(V.business(spark, sf), "Restaurants")
    kept = P.keep_ids(restaurants, K.top_cities(restaurants), "city")
    return A.city_mean(kept, V.business_category(spark, sf)).withColumn("mean_stars", r6("mean_stars"))


@query("a11_good_bad_counts", """
SELECT business_id, count(*) AS review, count(*) FILTER (stars >= 4) AS good_reviews, count(*) FILTER (stars <= 2) AS bad_reviews
FROM v_review GROUP BY 1""")
def _(spark, sf):
    return A.good_bad_counts(V.review(spark, sf, users=False), "business_id")


@query("a12_checkins_by_day", "SELECT business_id, day, CAST(sum(n) AS BIGINT) AS checkins FROM v_slot GROUP BY 1, 2")
def _(spark, sf):
    return A.checkins_by(A.checkin_slots(V.checkin(spark, sf)), "day")


@query("a12_checkins_by_hour", "SELECT business_id, hour, CAST(sum(n) AS BIGINT) AS checkins FROM v_slot GROUP BY 1, 2")
def _(spark, sf):
    return A.checkins_by(A.checkin_slots(V.checkin(spark, sf)), "hour")


@query("a13_business_stats", "SELECT business_id, round(avg(stars), 6) AS avg_stars, count(*) AS num_reviews FROM v_review GROUP BY 1")
def _(spark, sf):
    return A.business_stats(V.review(spark, sf, users=False)).withColumn("avg_stars", r6("avg_stars"))


@query("a18_quantile", """
SELECT round(quantile_cont(n, 0.85), 6) AS quantile FROM (SELECT business_id, count(*) AS n FROM v_review_part GROUP BY 1)""")
def _(spark, sf):
    counts = cohorts.review_count_quantile(V.review_part(spark, sf, users=False))
    return counts.select(r6("quantile").alias("quantile"))


@query("a18_quantile_of_values", "SELECT round(quantile_cont(value, 0.85), 6) AS quantile FROM events")
def _(spark, sf):
    return A.quantile(V.raw(spark, sf, "events"), "value", 0.85).select(r6("quantile").alias("quantile"))


@query("a20_histogram", """
WITH v AS (SELECT CAST(count(*) AS DOUBLE) AS x FROM v_review_part GROUP BY business_id),
e AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
b AS (SELECT least(floor((x - lo) / (hi - lo) * 20), 19) AS bin, count(*) AS n FROM v, e GROUP BY 1)
SELECT CAST(r.bin AS INTEGER) AS bin, round(lo + (hi - lo) * r.bin / 20, 6) AS left_edge, coalesce(n, 0) AS n
FROM e CROSS JOIN range(20) r(bin) LEFT JOIN b ON b.bin = r.bin""")
def _(spark, sf):
    counts = cohorts.review_counts(V.review_part(spark, sf, users=False))
    return A.histogram(counts, "n", 20).withColumn("left_edge", r6("left_edge"))


@query("a21_to_wide", """
SELECT business_id, CAST(coalesce(max(n) FILTER (stars = 1), 0) AS BIGINT) AS "1", CAST(coalesce(max(n) FILTER (stars = 2), 0) AS BIGINT) AS "2",
CAST(coalesce(max(n) FILTER (stars = 3), 0) AS BIGINT) AS "3", CAST(coalesce(max(n) FILTER (stars = 4), 0) AS BIGINT) AS "4",
CAST(coalesce(max(n) FILTER (stars = 5), 0) AS BIGINT) AS "5"
FROM (SELECT business_id, stars, count(*) AS n FROM v_review GROUP BY 1, 2) GROUP BY 1""")
def _(spark, sf):
    long = V.review(spark, sf, users=False).groupBy("business_id", "stars").agg(F.count(F.lit(1)).alias("n"))
    return A.to_wide(long, "business_id", "stars", "n", [1, 2, 3, 4, 5])


@query("a22_to_long", """
SELECT business_id, 'good_reviews' AS term, count(*) FILTER (stars >= 4) AS n FROM v_review GROUP BY 1 UNION ALL
SELECT business_id, 'bad_reviews', count(*) FILTER (stars <= 2) FROM v_review GROUP BY 1""")
def _(spark, sf):
    wide = A.good_bad_counts(V.review(spark, sf, users=False), "business_id").drop("review")
    return A.to_long(wide, "business_id")


# ---- sorts, limits, top-k

@query("k1_top_useful", """
SELECT business_id, review_id, usefulness FROM (SELECT business_id, review_id, useful AS usefulness,
row_number() OVER (PARTITION BY business_id ORDER BY useful DESC, review_id) AS rn FROM v_review) WHERE rn <= 5""")
def _(spark, sf):
    return K.top_useful(V.review(spark, sf, users=False)).select("business_id", "review_id", "usefulness")


_MEANS = "WITH m AS (SELECT categories_value, avg(stars) AS mean_stars FROM v_business JOIN v_business_category USING (business_id) GROUP BY 1)"


@query("k6_extremes", _MEANS + """
SELECT categories_value, round(mean_stars, 6) AS mean_stars, 'top' AS part FROM (SELECT * FROM m ORDER BY round(mean_stars, 9) DESC, categories_value LIMIT 11)
UNION ALL SELECT categories_value, round(mean_stars, 6), 'bottom' FROM (SELECT * FROM m ORDER BY round(mean_stars, 9), categories_value LIMIT 10)""")
def _(spark, sf):
    joined = J.with_categories(V.business(spark, sf).select("business_id", "stars"), V.business_category(spark, sf))
    means = A.mean_stars(joined, "categories_value").withColumn("mean_stars", F.round("mean_stars", 9))
    return K.extremes(means, "mean_stars", "categories_value").withColumn("mean_stars", r6("mean_stars"))


@query("k3_head_tail", """
WITH c AS (SELECT categories_value AS word, count(*) AS n FROM v_business_category GROUP BY 1)
SELECT word, n, 'head' AS part FROM (SELECT * FROM c ORDER BY n DESC, word LIMIT 5)
UNION ALL SELECT word, n, 'tail' FROM (SELECT * FROM c ORDER BY n, word DESC LIMIT 5)""")
def _(spark, sf):
    counts = V.business_category(spark, sf).groupBy(F.col("categories_value").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return K.head_tail(counts, "n", 5)


@query("k5_drop_largest", """
WITH c AS (SELECT categories_value, count(DISTINCT business_id) AS businesses FROM v_business_category GROUP BY 1)
SELECT * FROM c WHERE categories_value <> (SELECT categories_value FROM c ORDER BY businesses DESC, categories_value LIMIT 1)""")
def _(spark, sf):
    return K.drop_largest(A.category_sizes(V.business_category(spark, sf)), "businesses", "categories_value")


@query("k7_top_cities", "SELECT city, count(*) AS n FROM v_business GROUP BY 1 ORDER BY n DESC, city LIMIT 30")
def _(spark, sf):
    return K.top_cities(V.business(spark, sf))


@query("k8_most_reviewed", "SELECT business_id, name, review_count FROM v_business ORDER BY review_count DESC, business_id LIMIT 5")
def _(spark, sf):
    return K.most_reviewed(V.business(spark, sf)).select("business_id", "name", "review_count")


@query("k9_rows_between", "SELECT business_id, review_count FROM v_business ORDER BY review_count DESC, business_id LIMIT 20 OFFSET 10")
def _(spark, sf):
    df = V.business(spark, sf).select("business_id", "review_count")
    return K.rows_between(df, [F.desc("review_count"), "business_id"], 10, 20)


@query("k11_sort_search", _SEARCH_SQL + " WHERE contains(lower(name), 'ring')")
def _(spark, sf):
    return K.sort_search(P.search_names(V.business(spark, sf), "ring")).withColumn("stars", r6("stars"))


# ---- sets

@query("u1_union_parts", """
SELECT business_id, name, NULL AS categories_value FROM v_supplier_business
UNION ALL SELECT business_id, NULL, categories_value FROM v_business_category""")
def _(spark, sf):
    return P.union_parts([V.supplier_business(spark, sf).select("business_id", "name"), V.business_category(spark, sf)])


@query("u2_terms_in_all_parts", """
SELECT categories_value AS term FROM (SELECT DISTINCT categories_value, p_size FROM v_business_category JOIN part ON p_partkey = business_id)
GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT p_size) FROM part)""")
def _(spark, sf):
    sizes = V.raw(spark, sf, "part").select(F.col("p_partkey").alias("business_id"), "p_size")
    terms = V.business_category(spark, sf).withColumnRenamed("categories_value", "term").join(sizes, "business_id")
    return P.terms_in_all_parts(terms, "p_size")


@query("u3_distinct_values", "SELECT DISTINCT city, state FROM v_business")
def _(spark, sf):
    return P.distinct_values(V.business(spark, sf), "city", "state")


@query("u4_append_docs", "SELECT doc_id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark")
def _(spark, sf):
    other = V.raw(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return P.append_docs(V.raw(spark, sf, "documents").select("doc_id", "text"), other)


# ---- expressions

@query("x1_sanitize_keys", """
SELECT p_partkey AS business_id, 'Brand_Name' AS key, p_type AS value FROM part
UNION ALL SELECT p_partkey, 'Good_For_lunch__a_b_', p_name FROM part""")
def _(spark, sf):
    attributes = F.create_map(
        F.lit("Brand Name"), F.col("p_brand"), F.lit("Good For{lunch},a=b;"), F.col("p_name"),
        F.lit("Brand,Name"), F.col("p_type"),
    )
    parts = V.raw(spark, sf, "part").select(F.col("p_partkey").alias("business_id"), attributes.alias("attributes"))
    return X.explode_map(parts.select("business_id", X.sanitize_keys("attributes").alias("a")), "a")


@query("x2_explode_list", "SELECT business_id, city, categories_value FROM v_business JOIN v_business_category USING (business_id)")
def _(spark, sf):
    return X.explode_list(V.business(spark, sf).select("business_id", "city", "categories"), "categories").drop("categories")


@query("x3_x4_slots", "SELECT business_id, hour, day, n AS checkins FROM v_slot")
def _(spark, sf):
    return A.checkin_slots(V.checkin(spark, sf))


@query("x5_map_total", "SELECT business_id, total_checkins FROM v_total")
def _(spark, sf):
    return total_checkins(V.checkin(spark, sf))


@query("x6_day_label", """
SELECT event_id, ['Sun', 'Mon', 'Tues', 'Wed', 'Thur', 'Fri', 'Sat'][dayofweek(ts) + 1] AS label FROM events""")
def _(spark, sf):
    return V.raw(spark, sf, "events").select("event_id", X.day_label(F.dayofweek("ts") - 1).alias("label"))


@query("x7_votes", "SELECT review_id, funny, useful, cool FROM v_review")
def _(spark, sf):
    return V.review(spark, sf, users=False).select("review_id", *[X.vote("votes", v).alias(v) for v in ("funny", "useful", "cool")])


@query("x8_binarize_stars", "SELECT review_id, CASE WHEN stars >= 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM v_review")
def _(spark, sf):
    return V.review(spark, sf, users=False).select("review_id", X.binarize_stars("stars").alias("label"))


@query("x9_scale_to_max", """
WITH c AS (SELECT business_id, date, count(*) AS n FROM v_review GROUP BY 1, 2)
SELECT business_id, date, round(n / max(n) OVER (PARTITION BY business_id) * 60.0::DOUBLE, 6) AS n FROM c""")
def _(spark, sf):
    daily = A.count_by_date(V.review(spark, sf, users=False))
    return X.scale_to_max(daily, "business_id", "n").withColumn("n", r6("n"))


@query("x10_safe_ratio", "SELECT review_id, round(funny::DOUBLE / nullif(cool, 0), 6) AS ratio FROM v_review")
def _(spark, sf):
    votes = V.review(spark, sf, users=False).select("review_id", "votes.*")
    return votes.select("review_id", r6(X.safe_ratio("funny", "cool")).alias("ratio"))


@query("x11_days", "SELECT review_id, date AS day, strftime(date, '%Y-%m-%d') AS label FROM v_review")
def _(spark, sf):
    texts = V.review(spark, sf, users=False).select("review_id", F.col("date").cast("string").alias("d"))
    return texts.select("review_id", X.parse_day("d").alias("day"), X.format_day(X.parse_day("d")).alias("label"))


@query("x12_clean_text", """
SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(text), '[0-9]+', '', 'g'), '[[:punct:]]+', '', 'g'), '\\s+', ' ', 'g'), ' ') AS clean
FROM documents""")
def _(spark, sf):
    return V.raw(spark, sf, "documents").select("doc_id", X.clean_text("text").alias("clean"))


@query("x13_fill_zero", "SELECT business_id, coalesce(total_checkins, 0) AS total_checkins FROM v_business LEFT JOIN v_total USING (business_id)")
def _(spark, sf):
    joined = J.left_totals(V.business(spark, sf).select("business_id"), total_checkins(V.checkin(spark, sf)))
    return X.fill_zero(joined, ["total_checkins"])


