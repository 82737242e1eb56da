"""Registered queries: series, cohorts, check-in profiles, overlap, categories."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.operators import aggregates as A, categories as C, cohorts as H, filters as P, linkage as L, series as W, sketches as S
from reviewloom.operators.checkins import checkin_profile, total_checkins
from reviewloom.operators.overlap import customer_overlap, overlap_counts
from reviewloom.operators.ranking import top_overlap
from reviewloom.plans import fixtures as V
from reviewloom.plans.registry import query

CUT = V.CUT_DATE


def r6(col):
    return F.round(col, 6)


# ---- series

@query("w1_cumulative_reviews", f"""
WITH d AS (SELECT business_id, date, count(*) AS n FROM v_review GROUP BY 1, 2),
g AS (SELECT business_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM d GROUP BY 1)
SELECT business_id, date, review_count FROM (SELECT g.business_id, g.date, CAST(sum(coalesce(n, 0)) OVER
 (PARTITION BY g.business_id ORDER BY g.date) AS BIGINT) AS review_count
 FROM g LEFT JOIN d ON d.business_id = g.business_id AND d.date = g.date) WHERE date >= DATE '{CUT}'""")
def _(spark, sf):
    return W.cumulative_reviews(V.review(spark, sf, users=False), CUT)


_EWM = """
n AS (SELECT business_id, date, review_id, stars, row_number() OVER (PARTITION BY business_id ORDER BY date, review_id) AS n FROM {view}),
e AS (SELECT t.business_id, t.date, t.review_id, t.n, sum(i.stars * power(27.0::DOUBLE / 29, t.n - i.n)) / sum(power(27.0::DOUBLE / 29, t.n - i.n)) AS moving_avg
 FROM n t JOIN n i ON i.business_id = t.business_id AND i.n <= t.n GROUP BY ALL)"""
_FILL = f"""
l AS (SELECT business_id, date, arg_max(moving_avg, n) AS v FROM e GROUP BY 1, 2),
s AS (SELECT business_id, date, v, lead(date) OVER (PARTITION BY business_id ORDER BY date) AS next FROM l),
f AS (SELECT business_id, CAST(unnest(generate_series(date, coalesce(next - 1, date), INTERVAL 1 DAY)) AS DATE) AS date, v FROM s)
SELECT business_id, date, round(v, 6) AS avg_rating FROM f WHERE date >= DATE '{CUT}'"""


@query("w2_ewm_mean", "WITH " + _EWM.format(view="v_review") + " SELECT business_id, review_id, n, round(moving_avg, 6) AS moving_avg FROM e")
def _(spark, sf):
    narrow = V.review(spark, sf, users=False).select("business_id", "date", "review_id", "stars")
    smooth = W.ewm_mean(narrow, "business_id", ["date", "review_id"], "stars")
    return smooth.select("business_id", "review_id", "n", r6("moving_avg").alias("moving_avg"))


@query("w3_last_per_date", """
SELECT business_id, date, arg_max(stars, review_id) AS stars FROM v_review GROUP BY 1, 2""")
def _(spark, sf):
    return W.last_per_date(V.review(spark, sf, users=False), "business_id", value="stars", by="review_id")


@query("w4_daily_ffill", """
WITH d AS (SELECT business_id, date, count(*) AS n FROM v_review GROUP BY 1, 2),
g AS (SELECT business_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM d GROUP BY 1)
SELECT g.business_id, g.date, last_value(n IGNORE NULLS) OVER (PARTITION BY g.business_id ORDER BY g.date ROWS UNBOUNDED PRECEDING) AS n
FROM g LEFT JOIN d ON d.business_id = g.business_id AND d.date = g.date""")
def _(spark, sf):
    return W.daily_ffill(A.count_by_date(V.review(spark, sf, users=False)), "business_id")


@query("w5_rating_trend", "WITH " + _EWM.format(view="v_review") + "," + _FILL)
def _(spark, sf):
    return W.rating_trend(V.review(spark, sf, users=False), CUT).withColumn("avg_rating", r6("avg_rating"))


# every business of the suppliers' city with a category in common; the categories are market segments of
# the nation's region and the supplier's balance band
_SUPPLIER_CATS = """
v_scat AS (SELECT s_suppkey AS business_id, n_name AS city, unnest(['all', CASE WHEN s_acctbal < 3000 THEN 'low'
 WHEN s_acctbal < 7000 THEN 'mid' ELSE 'high' END]) AS cat FROM supplier JOIN nation ON s_nationkey = n_nationkey),
v_band AS (SELECT * FROM v_scat WHERE cat <> 'all'),
peers AS (SELECT DISTINCT a.business_id AS focal, b.business_id AS peer FROM v_band a JOIN v_band b USING (city, cat)),
v_merged AS (SELECT focal AS business_id, date, review_id, stars FROM v_review JOIN peers ON peer = v_review.business_id)"""


def _supplier_categories(spark, sf):
    balance = F.col("s_acctbal")
    band = F.when(balance < 3000, "low").when(balance < 7000, "mid").otherwise("high")
    return V.raw(spark, sf, "supplier").select(F.col("s_suppkey").alias("business_id"), band.alias("categories_value"))


@query("w6_competitor_trend", "WITH " + _SUPPLIER_CATS + "," + _EWM.format(view="v_merged") + "," + _FILL)
def _(spark, sf):
    trend = W.competitor_trend(
        V.review(spark, sf, users=False), V.supplier_business(spark, sf), _supplier_categories(spark, sf), CUT
    )
    return trend.withColumn("avg_rating", r6("avg_rating"))


@query("w7_rolling_mean", """
SELECT business_id, review_id, n, CASE WHEN n >= 7 THEN round(m, 6) END AS rolling_mean FROM (SELECT business_id, review_id,
 row_number() OVER w AS n, avg(stars) OVER (w ROWS 6 PRECEDING) AS m FROM v_review
 WINDOW w AS (PARTITION BY business_id ORDER BY date, review_id))""")
def _(spark, sf):
    rolled = W.rolling_mean(V.review(spark, sf, users=False).select("business_id", "date", "review_id", "stars"))
    return rolled.select("business_id", "review_id", "n", r6("rolling_mean").alias("rolling_mean"))


@query("w7_rolling_mean_of_dense", """
WITH b AS (SELECT business_id FROM v_review GROUP BY 1 HAVING count(*) > 500 ORDER BY 1 LIMIT 5)
SELECT business_id, review_id, n, CASE WHEN n >= 7 THEN round(m, 6) END AS rolling_mean FROM (SELECT business_id, review_id,
 row_number() OVER w AS n, avg(stars) OVER (w ROWS 6 PRECEDING) AS m FROM v_review WHERE business_id IN (SELECT business_id FROM b)
 WINDOW w AS (PARTITION BY business_id ORDER BY date, review_id))""")
def _(spark, sf):
    review = V.review(spark, sf, users=False).select("business_id", "date", "review_id", "stars")
    rolled = W.rolling_mean(P.keep_ids(review, H.dense_businesses(review)))
    return rolled.select("business_id", "review_id", "n", r6("rolling_mean").alias("rolling_mean"))


_COHORT = """
n AS (SELECT business_id, stars, row_number() OVER (PARTITION BY business_id ORDER BY date, review_id) AS n,
 count(*) OVER (PARTITION BY business_id) AS c FROM v_review),
h AS (SELECT business_id, avg(stars) FILTER (n BETWEEN 1 AND 100) AS m1, avg(stars) FILTER (n BETWEEN 101 AND 200) AS m2,
 avg(stars) FILTER (n BETWEEN 501 AND 600) AS m5 FROM n WHERE c > 500 GROUP BY 1)"""


@query("w8_age_cohorts", "WITH " + _COHORT + """
SELECT business_id, round(m1, 6) AS "100", round(m2, 6) AS "200", round(m5, 6) AS "500" FROM h""")
def _(spark, sf):
    cohorts = H.age_cohorts(V.review(spark, sf, users=False))
    return cohorts.select("business_id", *[r6(c).alias(c) for c in ("100", "200", "500")])


@query("w9_cohort_change", "WITH " + _COHORT + """, s AS (SELECT 2 * stddev_samp(m1) / 10 AS margin FROM h)
SELECT business_id, m2 > m1 + margin AS better, m2 < m1 - margin AS worse, round(m2 - m1, 6) AS diff, round(m5 - m1, 6) AS diff_500 FROM h, s""")
def _(spark, sf):
    change = H.cohort_change(H.age_cohorts(V.review(spark, sf, users=False)))
    return change.select("business_id", "better", "worse", r6("diff").alias("diff"), r6("diff_500").alias("diff_500"))


@query("a19_std_mean", "WITH " + _COHORT + """
SELECT '100' AS "column", round(stddev_samp(m1), 6) AS std, round(avg(m1), 6) AS mean FROM h UNION ALL
SELECT '200', round(stddev_samp(m2), 6), round(avg(m2), 6) FROM h UNION ALL
SELECT '500', round(stddev_samp(m5), 6), round(avg(m5), 6) FROM h""")
def _(spark, sf):
    stats = A.std_mean(H.age_cohorts(V.review(spark, sf, users=False)), ["100", "200", "500"])
    return stats.select("column", r6("std").alias("std"), r6("mean").alias("mean"))


@query("a20_cohort_histogram", "WITH " + _COHORT + """,
v AS (SELECT round(m1, 9) AS x FROM h), e AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
b AS (SELECT least(floor((x - lo) / (hi - lo) * 20), 19) AS bin, count(*) AS n FROM v, e GROUP BY 1)
SELECT CAST(r.bin AS INTEGER) AS bin, round(lo + (hi - lo) * r.bin / 20, 6) AS left_edge, coalesce(n, 0) AS n
FROM e CROSS JOIN range(20) r(bin) LEFT JOIN b ON b.bin = r.bin""")
def _(spark, sf):
    cohorts = H.age_cohorts(V.review(spark, sf, users=False)).select(F.round("100", 9).alias("100"))
    return A.histogram(cohorts, "100", 20).withColumn("left_edge", r6("left_edge"))


@query("w10_top_n_ties", """
SELECT business_id, date, n FROM (SELECT *, rank() OVER (PARTITION BY business_id ORDER BY n DESC) AS r FROM
(SELECT business_id, date, count(*) AS n FROM v_review GROUP BY 1, 2)) WHERE r <= 5""")
def _(spark, sf):
    return H.top_n_ties(A.count_by_date(V.review(spark, sf, users=False)), "business_id", "n", 5)


# ---- check-ins and composites over them

@query("o5_checkin_profile", """
WITH b AS (SELECT DISTINCT business_id FROM v_slot),
d AS (SELECT b.business_id, 'day' AS part, CAST(r.x AS INTEGER) AS slot, ['Sun', 'Mon', 'Tues', 'Wed', 'Thur', 'Fri', 'Sat'][r.x + 1] AS label,
 CAST(coalesce(sum(n), 0) AS BIGINT) AS checkins FROM b CROSS JOIN range(7) r(x) LEFT JOIN v_slot v ON v.business_id = b.business_id AND v.day = r.x GROUP BY ALL),
h AS (SELECT b.business_id, 'hour' AS part, CAST(r.x AS INTEGER) AS slot, CAST(r.x AS VARCHAR) AS label,
 CAST(coalesce(sum(n), 0) AS BIGINT) AS checkins FROM b CROSS JOIN range(24) r(x) LEFT JOIN v_slot v ON v.business_id = b.business_id AND v.hour = r.x GROUP BY ALL)
SELECT * FROM d UNION ALL SELECT * FROM h""")
def _(spark, sf):
    return checkin_profile(V.checkin(spark, sf))


_RATING_CHECKINS = """
c AS (SELECT business_id, coalesce(CAST(sum(total_checkins) AS BIGINT), 0) AS avg_checkins FROM v_business_category LEFT JOIN v_total USING (business_id) GROUP BY 1),
r AS (SELECT business_id, avg(stars) AS avg_rating FROM v_business JOIN v_business_category USING (business_id) GROUP BY 1)"""


@query("o7_rating_vs_checkins", "WITH " + _RATING_CHECKINS + " SELECT business_id, avg_checkins, round(avg_rating, 6) AS avg_rating FROM c FULL JOIN r USING (business_id)")
def _(spark, sf):
    both = C.rating_vs_checkins(V.business(spark, sf), V.business_category(spark, sf), total_checkins(V.checkin(spark, sf)))
    return both.withColumn("avg_rating", r6("avg_rating"))


@query("a9_checkins_by_rating", "WITH " + _RATING_CHECKINS + """
SELECT round(avg_rating * 2) / 2 AS avg_rating, round(avg(avg_checkins), 6) AS mean_checkins FROM c FULL JOIN r USING (business_id) GROUP BY 1""")
def _(spark, sf):
    # ratings in half stars, as the business table holds them
    both = C.rating_vs_checkins(V.business(spark, sf), V.business_category(spark, sf), total_checkins(V.checkin(spark, sf)))
    halves = both.withColumn("avg_rating", F.round(F.col("avg_rating") * 2) / 2)
    return A.checkins_by_rating(halves).withColumn("mean_checkins", r6("mean_checkins"))


# ---- customer overlap

_PAIRS = """
SELECT a.business_id, b.name, count(*) AS review, count(*) FILTER (a.stars >= 4) AS good_reviews, count(*) FILTER (a.stars <= 2) AS bad_reviews
FROM {review} a JOIN {review} r ON r.user_id = a.user_id AND r.business_id <> a.business_id
JOIN {business} b ON b.business_id = r.business_id GROUP BY 1, 2"""
_TOP = "WITH p AS ({pairs}) SELECT business_id, name, review, good_reviews, bad_reviews FROM p QUALIFY row_number() OVER (PARTITION BY business_id ORDER BY review DESC, name) <= 15"


@query("o1_customer_overlap", _TOP.format(pairs=_PAIRS.format(review="v_review", business="v_supplier_business")))
def _(spark, sf):
    return customer_overlap(V.review(spark, sf), V.supplier_business(spark, sf))


@query("o1_overlap_of_branches", _TOP.format(pairs=_PAIRS.format(review="v_review_part", business="v_business")))
def _(spark, sf):
    # many businesses share a name here, so their reviews merge
    return customer_overlap(V.review_part(spark, sf), V.raw(spark, sf, "part").select(
        F.col("p_partkey").alias("business_id"), F.col("p_name").alias("name")))


@query("k4_top_overlap", "WITH p AS (" + _PAIRS.format(review="v_review", business="v_supplier_business") + """)
SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY business_id ORDER BY good_reviews DESC, name) <= 3""")
def _(spark, sf):
    counts = overlap_counts(V.review(spark, sf), V.supplier_business(spark, sf))
    return top_overlap(counts, 3, by="good_reviews")


# ---- category overlap

_KEPT = """
k AS (SELECT categories_value, count(*) AS n FROM v_business_category GROUP BY 1 HAVING count(*) > (SELECT count(*) / 20 FROM part)),
c AS (SELECT business_id, categories_value, n FROM v_business_category JOIN k USING (categories_value)),
b AS (SELECT x.categories_value AS i, y.categories_value AS j, count(*)::DOUBLE / any_value(x.n) AS share
 FROM c x JOIN c y ON x.business_id = y.business_id GROUP BY 1, 2),
o AS (SELECT p.categories_value AS i, q.categories_value AS j, coalesce(share, 0.0) AS share FROM k p CROSS JOIN k q
 LEFT JOIN b ON b.i = p.categories_value AND b.j = q.categories_value)"""


def _overlap(spark, sf, dense=True):
    # more than a twentieth of the businesses: the 100 of 2,000 that the rule asks for, at any scale
    parts = V.raw(spark, sf, "part").count()
    return C.category_overlap(V.business_category(spark, sf), int(parts / 20), dense)


@query("o2_category_overlap", "WITH " + _KEPT + " SELECT i, j, round(share, 6) AS share FROM o")
def _(spark, sf):
    return _overlap(spark, sf).withColumn("share", r6("share"))


@query("o2_sketched_overlap", "WITH " + _KEPT + " SELECT i, j, round(share, 6) AS share, true AS exact FROM o")
def _(spark, sf):
    """Overlap from sketches of two halves of the businesses that were merged; exact up to 65,536 businesses of a category."""
    least = int(V.raw(spark, sf, "part").count() / 20)  # as in _overlap
    overlap = S.sketched_overlap(_merged_sketches(spark, sf), least)
    return overlap.select("i", "j", r6("share").alias("share"), (F.col("error") == 0).alias("exact"))


@query("a2_sketched_sizes", "SELECT categories_value, count(DISTINCT business_id) AS businesses FROM v_business_category GROUP BY 1")
def _(spark, sf):
    return S.sketched_sizes(_merged_sketches(spark, sf)).select("categories_value", "businesses")


def _merged_sketches(spark, sf):
    rows = V.business_category(spark, sf)
    odd = F.col("business_id") % 2 == 1
    return S.merge_sketches(S.set_sketches(rows.filter(odd)), S.set_sketches(rows.filter(~odd)))


@query("f14_submatrix", "WITH " + _KEPT + " SELECT i, j, round(share, 6) AS share FROM o WHERE i IN ('red', 'blue', 'ECONOMY') AND j = 'Restaurants'")
def _(spark, sf):
    return P.submatrix(_overlap(spark, sf), ["red", "blue", "ECONOMY"], ["Restaurants"]).withColumn("share", r6("share"))


@query("a24_row_sums", "WITH " + _KEPT + " SELECT i, round(sum(share), 6) AS total FROM o GROUP BY 1")
def _(spark, sf):
    return A.row_sums(_overlap(spark, sf)).withColumn("total", r6("total"))


_DIST = _KEPT + """,
d AS (SELECT x.i AS a, y.i AS b, sqrt(sum((x.share - y.share) * (x.share - y.share))) AS distance FROM o x JOIN o y ON x.j = y.j AND x.i < y.i GROUP BY 1, 2)"""
_COMPONENTS = "WITH RECURSIVE " + _DIST + """,
e AS (SELECT a, b FROM d WHERE distance <= 1.0 UNION ALL SELECT b, a FROM d WHERE distance <= 1.0),
w AS (SELECT categories_value AS i, categories_value AS r FROM k UNION SELECT w.i, e.b FROM w JOIN e ON e.a = w.r),
z AS (SELECT i, min(r) AS component FROM w GROUP BY 1)"""


@query("o3_row_distances", "WITH " + _DIST + " SELECT a, b, round(distance, 6) AS distance FROM d")
def _(spark, sf):
    return C.row_distances(_overlap(spark, sf, dense=False)).withColumn("distance", r6("distance"))


@query("o3_category_clusters", _COMPONENTS + " SELECT i, component FROM z")
def _(spark, sf):
    return C.category_clusters(_overlap(spark, sf, dense=False), 1.0)


@query("o4_ordered_overlap", _COMPONENTS + """
SELECT a.component AS cluster_i, o.i, b.component AS cluster_j, o.j, round(share, 6) AS share FROM o JOIN z a ON a.i = o.i JOIN z b ON b.i = o.j""")
def _(spark, sf):
    overlap = _overlap(spark, sf)
    return C.ordered_overlap(overlap, C.category_clusters(overlap, 1.0)).withColumn("share", r6("share"))


_LEVELS = "WITH RECURSIVE " + _KEPT + """,
d AS MATERIALIZED (SELECT x.i AS a, y.i AS b, round(sqrt(sum((x.share - y.share) * (x.share - y.share))), 9) AS distance
 FROM o x JOIN o y ON x.j = y.j AND x.i < y.i GROUP BY 1, 2),
h AS MATERIALIZED (SELECT distance AS height, row_number() OVER (ORDER BY distance) AS level FROM (SELECT DISTINCT distance FROM d)),
e AS MATERIALIZED (SELECT level, a, b FROM d JOIN h ON distance <= height UNION ALL SELECT level, b, a FROM d JOIN h ON distance <= height),
w AS (SELECT level, categories_value AS i, categories_value AS r FROM k, h UNION SELECT w.level, w.i, e.b FROM w JOIN e ON e.level = w.level AND e.a = w.r),
l AS MATERIALIZED (SELECT level, i, min(r) AS leader FROM w GROUP BY 1, 2 UNION ALL SELECT 0, categories_value, categories_value FROM k),
s AS (SELECT level + 1 AS level, leader AS i, count(*) AS own FROM l GROUP BY 1, 2),
g AS (SELECT i AS j, min(level) AS level FROM l WHERE leader <> i GROUP BY 1),
m AS MATERIALIZED (SELECT row_number() OVER (ORDER BY height, l.leader, g.j) AS step, l.leader AS i, g.j, height, v.own AS own,
  u.own + sum(v.own) OVER (PARTITION BY g.level, l.leader ORDER BY g.j) AS size
 FROM g JOIN l ON l.level = g.level AND l.i = g.j JOIN h ON h.level = g.level JOIN s v ON v.level = g.level AND v.i = g.j
 JOIN s u ON u.level = g.level AND u.i = l.leader)"""


def _linkage(spark, sf):
    return L.linkage(_overlap(spark, sf, dense=False))


@query("o3_merge_tree", _LEVELS + " SELECT step, i, j, round(height, 6) AS height, CAST(size AS BIGINT) AS size FROM m")
def _(spark, sf):
    merges, _leaves = _linkage(spark, sf)
    return merges.select("step", "i", "j", r6("height").alias("height"), "size")


_LEAVES = _LEVELS + """,
q AS MATERIALIZED (SELECT m.*, coalesce(max(step) OVER (PARTITION BY i ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS i_step,
  coalesce((SELECT max(x.step) FROM m x WHERE x.i = m.j), 0) AS j_step FROM m),
t AS (SELECT step, i AS name, 0 AS position FROM (SELECT * FROM q ORDER BY step DESC LIMIT 1)
 UNION ALL SELECT CASE WHEN side = 0 THEN i_step ELSE j_step END, CASE WHEN side = 0 THEN q.i ELSE q.j END,
  CAST(position + CASE WHEN (side = 0) = (i_step <= j_step) THEN 0 WHEN side = 0 THEN own ELSE size - own END AS INTEGER)
 FROM t JOIN q ON q.step = t.step CROSS JOIN (VALUES (0), (1)) z(side)),
f AS (SELECT name AS i, CAST(position AS BIGINT) AS position FROM t WHERE step = 0)"""


@query("o4_leaf_order", _LEAVES + " SELECT i, position FROM f")
def _(spark, sf):
    return _linkage(spark, sf)[1]


@query("o4_overlap_by_leaf", _LEAVES + """
SELECT x.position AS i_position, y.position AS j_position, o.i, o.j, round(share, 6) AS share FROM o JOIN f x ON x.i = o.i JOIN f y ON y.i = o.j""")
def _(spark, sf):
    overlap = _overlap(spark, sf)
    return L.reordered(overlap, L.linkage(overlap)[1]).withColumn("share", r6("share"))
