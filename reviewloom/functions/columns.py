"""Scalar, array and map expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Day labels, 0 = Sunday
DAY_LABELS = ["Sun", "Mon", "Tues", "Wed", "Thur", "Fri", "Sat"]


def sanitize_keys(col: str | Column) -> Column:
    """Map with each of space , ; { } ( ) = in its keys replaced by `_`; of keys that collide the last stays."""
    entries = F.transform(
        F.map_entries(col),
        lambda e: F.struct(F.regexp_replace(e["key"], "[ ,;{}()=]", "_").alias("key"), e["value"].alias("value")),
    )

    def keep_last(es: Column) -> Column:
        later = lambda e, i: F.exists(F.slice(es, i + 2, F.size(es)), lambda x: x["key"] == e["key"])
        return F.map_from_entries(F.filter(es, lambda e, i: ~later(e, i)))

    # the one-element array computes the entries once
    return F.get(F.transform(F.array(entries), keep_last), F.lit(0))


def explode_list(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """One row per list element beside the other columns; an empty list gives no row."""
    return df.select("*", F.explode(col).alias(name or f"{col}_value"))


def explode_map(df: DataFrame, col: str, key: str = "key", value: str = "value") -> DataFrame:
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.explode(col).alias(key, value))


def split_slot(col: str | Column) -> tuple[Column, Column]:
    """(hour, day) of an `hour-day` slot."""
    parts = F.split(col, "-")
    return F.get(parts, F.lit(0)).cast("int"), F.get(parts, F.lit(1)).cast("int")


def map_total(col: str | Column) -> Column:
    return F.aggregate(F.map_values(col), F.lit(0).cast("long"), lambda a, x: a + x)


def day_label(col: str | Column) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.element_at(F.array(*[F.lit(d) for d in DAY_LABELS]), (col + 1).cast("int"))


def vote(col: str, name: str) -> Column:
    """A vote count by name, never by position."""
    return F.col(col)[name]


def binarize_stars(col: str | Column) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col >= 4, 1.0).otherwise(0.0)


def safe_ratio(a: str | Column, b: str | Column) -> Column:
    """a / b as double, null where b is zero."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.try_divide(a.cast("double"), b.cast("double"))


def parse_day(col: str | Column) -> Column:
    return F.to_date(col)


def format_day(col: str | Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def clean_text(col: str | Column) -> Column:
    """Lower case without digits and punctuation, blanks squeezed."""
    text = F.regexp_replace(F.lower(col), "[0-9]+", "")
    text = F.regexp_replace(text, r"\p{Punct}+", "")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.na.fill(0, subset=cols)


def scale_to_max(df: DataFrame, key: str | list[str], col: str, top: float = 60.0) -> DataFrame:
    """col / max(col of the key) * top. The maxima are aggregated before the join, one row per key."""
    peak = df.groupBy(*([key] if isinstance(key, str) else key)).agg(F.max(col).cast("double").alias("_max"))
    scaled = (F.col(col).cast("double") / F.nullif("_max", F.lit(0.0)) * top).alias(col)
    return df.join(peak, key).select(*[scaled if c == col else F.col(c) for c in df.columns])
