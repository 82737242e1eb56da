"""The test tables presented as reviews, businesses and check-ins (see FIXTURES.md).

Each view exists twice: as a DataFrame and as a SQL common table expression with the same rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewloom.sources.tables import open_table

CUT_DATE = "1998-01-01"
#: characters in a part of the texts, and in one of a small table
PART_CHARS, SMALL_CHARS = 6_000_000, 500_000


def raw(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return open_table(spark, f"{sf}/{name}.parquet")


def review(spark: SparkSession, sf: str, business: str = "l_suppkey", users: bool = True) -> DataFrame:
    """Line items as reviews. Without users the join with orders is not needed (each item has one order)."""
    items = raw(spark, sf, "lineitem")
    day = F.col("l_shipdate").cast("date")
    fields = [
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day.cast("string")).alias("review_id"),
        F.col(business).alias("business_id"),
        (F.col("l_quantity").cast("int") % 5 + 1).alias("stars"),
        day.alias("date"),
        F.struct(
            (F.col("l_partkey") % 7).alias("funny"),
            F.col("l_linenumber").cast("long").alias("useful"),
            (F.col("l_partkey") % 11).alias("cool"),
        ).alias("votes"),
    ]
    if users:
        items = items.join(raw(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        fields.insert(2, F.col("o_custkey").alias("user_id"))
    return items.select(*fields)


def review_part(spark: SparkSession, sf: str, users: bool = True) -> DataFrame:
    return review(spark, sf, "l_partkey", users)


def supplier_business(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = raw(spark, sf, "nation"), raw(spark, sf, "region")
    return (
        raw(spark, sf, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("business_id"), F.col("s_name").alias("name"),
            F.col("n_name").alias("city"), F.col("r_name").alias("state"),
        )
    )


def business(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as businesses, with stars and review counts from their reviews."""
    stats = review_part(spark, sf, users=False).groupBy("business_id").agg(
        F.avg("stars").alias("stars"), F.count(F.lit(1)).alias("review_count")
    )
    restaurants = F.when(F.col("p_size") <= 40, F.lit("Restaurants"))
    categories = F.array_distinct(
        F.concat(F.array_compact(F.array(restaurants, F.col("p_type"))), F.split("p_name", " "))
    )
    parts = raw(spark, sf, "part").select(
        F.col("p_partkey").alias("business_id"), F.col("p_name").alias("name"),
        F.concat(F.lit("city_"), F.col("p_size").cast("string")).alias("city"),
        F.col("p_brand").alias("state"), categories.alias("categories"),
    )
    return parts.join(stats, "business_id", "left").select(
        "business_id", "name", "city", "state", "categories",
        F.coalesce("stars", F.lit(0.0)).alias("stars"), F.coalesce("review_count", F.lit(0)).alias("review_count"),
    )


def business_category(spark: SparkSession, sf: str) -> DataFrame:
    """(business_id, categories_value), without the review statistics business() needs."""
    parts = raw(spark, sf, "part").select(
        F.col("p_partkey").alias("business_id"),
        F.array_distinct(F.concat(
            F.array_compact(F.array(F.when(F.col("p_size") <= 40, F.lit("Restaurants")), F.col("p_type"))),
            F.split("p_name", " "),
        )).alias("categories"),
    )
    return parts.select("business_id", F.explode("categories").alias("categories_value"))


def checkin(spark: SparkSession, sf: str) -> DataFrame:
    """Events as check-in maps; a map has at most 24 * 7 keys."""
    slot = F.concat_ws("-", F.hour("ts").cast("string"), (F.dayofweek("ts") - 1).cast("string"))
    slots = raw(spark, sf, "events").groupBy(F.col("user_id").alias("business_id"), slot.alias("slot")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return slots.groupBy("business_id").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("checkin_info")
    )


def text_review(spark: SparkSession, sf: str) -> DataFrame:
    # the test tables have one row group; dealing texts out by id also places what is counted per document later
    documents = raw(spark, sf, "documents")
    return documents.select("doc_id", "source", "text").repartition(_text_parts(documents), "doc_id").select(
        F.col("doc_id").alias("review_id"), F.col("source").alias("business_id"),
        ((F.floor(F.col("doc_id") / 20) % 5) + 1).cast("int").alias("stars"), "text",
    )


def _text_parts(documents: DataFrame) -> int:
    """A part for every PART_CHARS characters, so that the terms of a part fit into memory; smaller parts, up to the usual
    number, of a small table. Runs a job over the lengths when called."""
    chars = documents.agg(F.sum(F.coalesce(F.col("n_chars"), F.lit(1_000)).cast("double"))).first()[0] or 0.0
    usual = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(math.ceil(chars / PART_CHARS), min(usual, math.ceil(chars / SMALL_CHARS)), 1)


_CATEGORIES = (
    "list_concat(CASE WHEN p_size <= 40 THEN ['Restaurants', p_type] ELSE [p_type] END, string_split(p_name, ' '))"
)
_REVIEW = (
    "SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR))"
    " AS review_id, {key} AS business_id, o_custkey AS user_id,"
    " CAST(CAST(l_quantity AS INTEGER) % 5 + 1 AS INTEGER) AS stars, CAST(l_shipdate AS DATE) AS date,"
    " CAST(l_partkey % 7 AS BIGINT) AS funny, CAST(l_linenumber AS BIGINT) AS useful,"
    " CAST(l_partkey % 11 AS BIGINT) AS cool FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
)

VIEWS = {
    "v_review": _REVIEW.format(key="l_suppkey"),
    "v_review_part": _REVIEW.format(key="l_partkey"),
    "v_supplier_business": (
        "SELECT s_suppkey AS business_id, s_name AS name, n_name AS city, r_name AS state FROM supplier"
        " JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
    ),
    "v_business": (
        "SELECT p_partkey AS business_id, p_name AS name, 'city_' || p_size AS city, p_brand AS state,"
        f" list_filter({_CATEGORIES}, lambda x, i: list_position({_CATEGORIES}, x) = i) AS categories,"
        " coalesce(s.stars, 0.0) AS stars, coalesce(s.review_count, 0) AS review_count FROM part"
        " LEFT JOIN (SELECT business_id, avg(stars) AS stars, count(*) AS review_count FROM v_review_part"
        " GROUP BY 1) s ON s.business_id = p_partkey"
    ),
    "v_business_category": (
        "SELECT DISTINCT business_id, categories_value FROM (SELECT p_partkey AS business_id,"
        f" unnest({_CATEGORIES}) AS categories_value FROM part)"
    ),
    "v_slot": (
        "SELECT user_id AS business_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) AS INTEGER) AS day,"
        " count(*) AS n FROM events GROUP BY 1, 2, 3"
    ),
    "v_total": "SELECT business_id, CAST(sum(n) AS BIGINT) AS total_checkins FROM v_slot GROUP BY 1",
    "v_text_review": (
        "SELECT doc_id AS review_id, source AS business_id, CAST((doc_id // 20) % 5 + 1 AS INTEGER) AS stars, text"
        " FROM documents"
    ),
}
NEEDS = {"v_business": ["v_review_part"], "v_total": ["v_slot"]}


def with_views(body: str) -> str:
    """Puts the views that a SQL text mentions in front of it."""
    wanted: list[str] = []

    def want(name: str) -> None:
        for other in NEEDS.get(name, []):
            want(other)
        if name not in wanted:
            wanted.append(name)

    for name in VIEWS:
        if re.search(rf"\b{name}\b", body):
            want(name)
    parts = [f"{name} AS ({VIEWS[name]})" for name in wanted]
    body = body.strip()
    head = re.match(r"WITH (RECURSIVE )?", body)
    if head:
        return head.group(0) + ",\n".join([*parts, body[head.end():]])
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
