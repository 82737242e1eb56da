"""Check-in profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reviewloom.functions.columns import day_label, map_total
from reviewloom.operators.aggregates import checkin_slots, dense_checkins


def total_checkins(checkin: DataFrame, key: str = "business_id", col: str = "checkin_info") -> DataFrame:
    return checkin.select(key, map_total(col).alias("total_checkins"))


def checkin_profile(checkin: DataFrame, key: str = "business_id") -> DataFrame:
    """(business, part, slot, label, checkins): 7 days and 24 hours of each business that has a check-in row."""
    slots = checkin_slots(checkin, key)
    days = dense_checkins(slots, "day", key).select(
        key, F.lit("day").alias("part"), F.col("day").alias("slot"), day_label("day").alias("label"), "checkins"
    )
    hours = dense_checkins(slots, "hour", key).select(
        key, F.lit("hour").alias("part"), F.col("hour").alias("slot"), F.col("hour").cast("string").alias("label"),
        "checkins",
    )
    return days.unionByName(hours)
