"""Name search by a trigram index: posting lists of three-letter parts, read only where needed, and a check of each name.

The index is three tables in one folder. `postings` has a row for each business and distinct trigram of its lower-cased name,
`lists` the length of each posting list, `rows` the columns that a search shows. The first two lie in partition
folders by the hash of the trigram, the last by the hash of the business, so that a search lists and reads some of them.
Rows of a long list are dealt over several files of its folder.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from reviewloom.operators.filters import SEARCH_COLUMNS, search_names

#: a list is dealt over so many files; a search reads the shortest lists, so many at most
FILES, LISTS = 4, 6


def _bucket(col: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


@dataclass
class NameIndex:
    spark: SparkSession
    path: str
    buckets: int
    schemas: dict[str, StructType]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{name}")

    def of_bucket(self, name: str, buckets: list[int]) -> DataFrame:
        return self.table(name).filter(F.col("bucket").isin(buckets))


def trigrams(text: str) -> list[str]:
    """The distinct parts of three letters of a text, in order of appearance."""
    return list(dict.fromkeys(text[i:i + 3] for i in range(len(text) - 2)))


def build_name_index(business: DataFrame, path: str, buckets: int = 64) -> NameIndex:
    """Writes the index of all names below `path`. Names that are null are in no search and in no index."""
    named = business.select(*SEARCH_COLUMNS).filter("name is not null")
    name = F.lower("name")
    starts = F.when(F.length(name) >= 3, F.sequence(F.lit(1), F.length(name) - 2))
    grams = F.array_distinct(F.transform(starts, lambda at: F.substring(name, at, 3)))
    postings = named.select("business_id", F.explode(grams).alias("gram")).withColumn("bucket", _bucket("gram", buckets))
    spread = postings.repartition("bucket", F.pmod(F.xxhash64("business_id"), F.lit(FILES)))
    spread.sortWithinPartitions("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    lists = postings.groupBy("bucket", "gram").agg(F.count(F.lit(1)).alias("n"))
    lists.repartition("bucket").sortWithinPartitions("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/lists")
    rows = named.withColumn("bucket", _bucket("business_id", buckets))
    rows.repartition("bucket").sortWithinPartitions("bucket", "business_id").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows")
    return NameIndex(business.sparkSession, path, buckets, {"postings": postings.schema, "lists": lists.schema, "rows": rows.schema})


def candidates(index: NameIndex, grams: list[str]) -> DataFrame:
    """(business_id) of the names that hold the rarest of these trigrams; a job reads the lengths of their lists."""
    asked = index.spark.createDataFrame([(g,) for g in grams], "gram string").withColumn("bucket", _bucket("gram", index.buckets))
    bucket = {r["gram"]: r["bucket"] for r in asked.collect()}
    known = index.of_bucket("lists", sorted(set(bucket.values()))).filter(F.col("gram").isin(grams))
    length = {r["gram"]: r["n"] for r in known.collect()}  # one row per trigram of the text
    rare = sorted(grams, key=lambda g: (length.get(g, 0), g))[:LISTS]
    lists = index.of_bucket("postings", sorted({bucket[g] for g in rare})).filter(F.col("gram").isin(rare))
    return lists.groupBy("business_id").agg(F.count(F.lit(1)).alias("_hits")).filter(F.col("_hits") == len(rare)).select("business_id")


def search_index(index: NameIndex, text: str, wildcards: bool = False) -> DataFrame:
    """The same rows as search_names, from the posting lists of the text's trigrams.

    A text without three letters in a row (between wildcards) has no list: the names are scanned, as they are for an
    escape sign in a wildcard text.
    """
    lowered = (text or "").lower()
    pieces = re.split("[%_]", lowered) if wildcards else [lowered]
    grams = list(dict.fromkeys(g for piece in pieces for g in trigrams(piece)))
    if not grams or (wildcards and "\\" in lowered):
        return search_names(index.table("rows"), text, wildcards)
    found = candidates(index, grams).withColumn("bucket", _bucket("business_id", index.buckets))
    buckets = [r["bucket"] for r in found.select("bucket").distinct().collect()]  # at most index.buckets
    rows = index.of_bucket("rows", buckets).join(found.select("business_id"), "business_id", "left_semi")
    return search_names(rows, text, wildcards)
