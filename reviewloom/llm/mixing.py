"""Mixing sources to target weights, exactly to the word, with DataFrame functions only.

Method: every document gets a hash-random key, so equal ranges of keys are equal shares of a source: that is
the range sort. Sizes are summed per source and range, the sums run up over the ranges of a source, and only
the range in which a source's budget ends is sorted, to find the document at the cut. All documents before
the cut are in the mix once more than those behind it; a budget above the source's size repeats whole epochs
first. The texts themselves are never shuffled: documents meet a table with one row per source.

Targets: sources by code point, null last, have the weights in turn; together they get `share` of all sizes;
no target exceeds `epochs` times the source's size, what is left over goes to the others by weight.

Defined results: null texts have size 0 and are taken 0 times; null is a source like any other; rows that
agree in id and text share one key and one fate (at the cut each takes an equal part, rounded down); an empty
table gives an empty mix. Reruns agree, keys depend on the id, the text and the seed only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from reviewloom.session import cut_lineage

#: about so many documents lie in one range of keys
RANGE_ROWS = 20_000
#: one row per source is broadcast up to so many sources; beyond, Spark chooses the join
BROADCAST_SOURCES = 50_000


def size_of(text: str) -> Column:
    """Words of a text, in long."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def random_key(id: str, text: str, seed: str) -> Column:
    """32 hex digits that order the documents of a source at random."""
    digest = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id).cast("string"), F.lit("")), digest).cast("binary"))


def targets(sizes: DataFrame, weights: Sequence[float], share: float, epochs: int) -> DataFrame:
    """source, source_size, target of a table with one row (source, source_size) per source.

    The level at which the budget is used up is found from running sums in the order of epochs * size / weight:
    sources before it are at their cap, the others get level * weight. The table of sources lies in one task,
    one short row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    given = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("weight", F.element_at(given, (F.row_number().over(by_name) - 1) % len(weights) + 1))
    rows = rows.withColumn("cap", (F.col("source_size") * epochs).cast("double"))
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "capped": F.coalesce(F.sum("cap").over(before), F.lit(0.0)), "gone": F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    every, ratio = Window.partitionBy(), F.col("cap") / F.col("weight")
    budget = F.lit(float(share)) * F.sum("source_size").over(every)
    rows = rows.withColumn("level", (budget - F.col("capped")) / (F.sum("weight").over(every) - F.col("gone")))
    first = F.min(F.when(F.col("level") <= ratio, F.struct(ratio.alias("ratio"), "gone", "level"))).over(every)
    rows = rows.withColumn("at", first["level"])
    return rows.select("source", "source_size", F.least("cap", F.coalesce(F.col("at") * F.col("weight"), "cap")).alias("target"))


def cuts(
    docs: DataFrame, weights: Sequence[float], share: float, epochs: int, seed: str,
    text: str, id: str, source: str,
) -> DataFrame:
    """One row per source: source_size, target, epochs that all documents are in, key at the cut and what each
    row at the cut takes."""
    slim = docs.select(F.col(f"`{source}`").alias("source"), random_key(f"`{id}`", f"`{text}`", seed).alias("key"), size_of(f"`{text}`").alias("size"))
    slim = cut_lineage(slim.groupBy("source", "key", "size").agg(F.count(F.lit(1)).alias("rows")), "mix")
    digits = 1
    count = slim.count()
    while count > RANGE_ROWS * 16**digits:
        digits += 1
    words = F.col("size") * F.col("rows")
    ranges = slim.groupBy("source", F.substring("key", 1, digits).alias("range")).agg(F.sum(words).alias("words"))
    ranges = cut_lineage(ranges, "ranges")
    plan = targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, epochs)
    budget = F.floor("target").cast("long")
    plan = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(F.lit(0)))
    plan = cut_lineage(plan.withColumn("rest", budget - F.col("whole") * F.col("source_size")), "plan")
    up = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    running = ranges.withColumn("before", F.coalesce(F.sum("words").over(up), F.lit(0)))
    on_source = lambda left, right: left["source"].eqNullSafe(right["source"])
    holds = running.join(plan, on_source(running, plan)).where("before <= rest and rest < before + words")
    holds = holds.select(plan["source"].alias("s"), F.col("range").alias("r"), "before", "rest")
    inside = slim.join(holds, slim["source"].eqNullSafe(holds["s"]) & (F.substring("key", 1, digits) == F.col("r")))
    up = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("first", F.col("before") + F.coalesce(F.sum(words).over(up), F.lit(0)))
    cut = inside.where((F.col("first") <= F.col("rest")) & (F.col("rest") < F.col("first") + words))
    cut = cut.select(F.col("source").alias("s"), F.col("key").alias("cut"), F.expr("(rest - first) div rows").alias("part"))
    return plan.join(cut, plan["source"].eqNullSafe(cut["s"]), "left").drop("s")


def take(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, epochs: int = 2, seed: str = "mix",
    text: str = "text", id: str = "doc_id", source: str = "source",
) -> DataFrame:
    """Every document as row (a struct of its columns) with size, source_size, target and taken, the words of it
    in the mix, repeats counted. Runs jobs when called."""
    plan = cut_lineage(cuts(docs, weights, share, epochs, seed, text, id, source), "cuts")
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{source}`").alias("own"),
        random_key(f"`{id}`", f"`{text}`", seed).alias("key"), size_of(f"`{text}`").alias("size"),
    )
    more = F.when(F.col("cut").isNull() | (F.col("key") > F.col("cut")), F.lit(0)).when(F.col("key") < F.col("cut"), F.col("size")).otherwise(F.col("part"))
    met = rows.join(plan, F.col("own").eqNullSafe(F.col("source")))
    return met.select("row", "size", "source_size", "target", (F.col("whole") * F.col("size") + more).cast("long").alias("taken"))


def mix_sizes(docs: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    return take(docs, id=id, **options).select(F.col("row")[id].alias(id), "size", "source_size", "target", "taken")


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row for each epoch a document is in, its columns, mix_epoch (from 1) and mix_words, the
    leading words of the text that this epoch takes (all but at the cut). Columns of docs with these two names, in upper or
    lower case, give way to them."""
    rows = take(docs, **options).where("taken > 0")
    left = lambda e: F.least("size", F.col("taken") - (e - 1) * F.col("size"))
    rows = rows.withColumn("mix_epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size")))))
    own = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in ("mix_epoch", "mix_words")]
    return rows.select(*own, "mix_epoch", left(F.col("mix_epoch")).alias("mix_words"))
