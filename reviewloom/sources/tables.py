"""Table schemas and scans."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_string = T.StringType()

SCHEMAS: dict[str, T.StructType] = {
    "business": T.StructType([
        T.StructField("business_id", _string), T.StructField("name", _string),
        T.StructField("city", _string), T.StructField("state", _string),
        T.StructField("stars", T.DoubleType()), T.StructField("review_count", T.LongType()),
        T.StructField("categories", T.ArrayType(_string)),
        T.StructField("attributes", T.MapType(_string, _string)),
    ]),
    "review": T.StructType([
        T.StructField("review_id", _string), T.StructField("business_id", _string),
        T.StructField("user_id", _string), T.StructField("stars", T.IntegerType()),
        T.StructField("date", _string), T.StructField("text", _string), T.StructField("type", _string),
        T.StructField("votes", T.StructType([
            T.StructField("funny", T.LongType()), T.StructField("useful", T.LongType()),
            T.StructField("cool", T.LongType()),
        ])),
    ]),
    # a map, not the struct of up to 168 optional fields that inference would make
    "checkin": T.StructType([
        T.StructField("business_id", _string),
        T.StructField("checkin_info", T.MapType(_string, T.LongType())),
    ]),
    "total_checkins": T.StructType([
        T.StructField("business_id", _string), T.StructField("total_checkins", T.LongType()),
    ]),
    "business_category": T.StructType([
        T.StructField("business_id", _string), T.StructField("categories_value", _string),
    ]),
    "tip": T.StructType([T.StructField("business_id", _string), T.StructField("text", _string)]),
    "photo": T.StructType([T.StructField("business_id", _string), T.StructField("photo_id", _string)]),
}

_opened: WeakKeyDictionary[SparkSession, dict[tuple, DataFrame]] = WeakKeyDictionary()


def open_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet table; the handle (the plan, not the data) is kept per session, path and schema until `forget`."""
    known = _opened.setdefault(spark, {})
    key = (path, schema and schema.json())
    if key not in known:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        known[key] = reader.parquet(path)
    return known[key]


def forget(spark: SparkSession, path: str) -> None:
    """Drops the handles of a folder that was written anew."""
    known = _opened.get(spark, {})
    for key in [k for k in known if k[0] == path]:
        del known[key]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A named table of a data folder, with its fixed schema, also visible to SQL text by its name."""
    df = open_table(spark, f"{folder.rstrip('/')}/{name}.parquet", SCHEMAS.get(name))
    df.createOrReplaceTempView(name)
    return df


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines; splittable, no inference pass."""
    return spark.read.schema(schema).json(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that hold one JSON array each. A file is one task, so large data belongs in many files."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, sep=sep, escape='"')


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """An intermediate table saved by save_table."""
    return spark.read.parquet(path)


def read_text_dir(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, text), one row per file below `path`; the name is the path, so that equal names in two folders
    stay two files."""
    return (
        spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file_name"), F.col("value").alias("text"))
    )
