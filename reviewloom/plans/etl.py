"""Raw JSON tables to the restaurant subset."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from reviewloom.functions.columns import explode_list, sanitize_keys
from reviewloom.operators.checkins import total_checkins
from reviewloom.operators.filters import with_category_like
from reviewloom.operators.joins import restrict
from reviewloom.sources.sinks import save_table
from reviewloom.sources.tables import SCHEMAS, read_json_array, read_jsonl

# one file or folder of files per raw table; photos come as JSON arrays, the others as JSON lines
RAW_FILES = {name: f"{name}.json" for name in ("business", "checkin", "tip", "review", "photo")}


def restaurant_tables(raw: Mapping[str, DataFrame], category: str = "Restaurants") -> dict[str, DataFrame]:
    """Cleaned businesses, the category map of all of them, and every table cut to the restaurants."""
    business = raw["business"].withColumn("attributes", sanitize_keys("attributes"))
    restaurants = with_category_like(business, category)
    out = {
        "business_cleaned": business,
        "business": restaurants,
        "business_category": explode_list(
            business.select("business_id", "categories"), "categories"
        ).select("business_id", "categories_value"),
    }
    for name in ("checkin", "tip", "review", "photo"):
        if name in raw:
            out[name] = restrict(raw[name], restaurants)
    if "checkin" in raw:
        out["total_checkins"] = total_checkins(raw["checkin"])
    return out


def restaurant_etl(spark: SparkSession, raw_dir: str, out_dir: str, files: Mapping[str, str] = RAW_FILES) -> list[str]:
    """Reads the raw JSON files and writes each table as Parquet, reviews clustered by business."""
    folder = raw_dir.rstrip("/")
    raw = {
        name: (read_json_array if name == "photo" else read_jsonl)(spark, f"{folder}/{file}", SCHEMAS[name])
        for name, file in files.items()
    }
    tables = restaurant_tables(raw)
    for name, df in tables.items():
        cluster = "business_id" if name in ("review", "checkin") else None
        save_table(df, f"{out_dir.rstrip('/')}/{name}.parquet", cluster, then="review_id" if name == "review" else ())
    return sorted(tables)
