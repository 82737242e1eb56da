"""Category overlap and clusters, ratings against check-ins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reviewloom.operators.aggregates import CATEGORY, category_sizes, checkin_total
from reviewloom.operators.joins import combine, densify
from reviewloom.session import cut_lineage


def kept_categories(biz_cat: DataFrame, min_count: int = 100, category: str = CATEGORY,
                    key: str = "business_id") -> DataFrame:
    """Categories of more than `min_count` businesses, with their sizes."""
    return category_sizes(biz_cat, category, key).filter(F.col("businesses") > min_count)


def category_pairs(biz_cat: DataFrame, min_count: int = 100, category: str = CATEGORY,
                   key: str = "business_id") -> DataFrame:
    """(i, j, both, size_i) for kept categories that share a business, i = j included.

    Businesses are first counted per distinct set of kept categories; pairs are then made once per set
    and weighted, not once per business.
    """
    kept = kept_categories(biz_cat, min_count, category, key)
    rows = biz_cat.select(key, category).distinct().join(kept.select(category), category, "left_semi")
    sets = rows.groupBy(key).agg(F.sort_array(F.collect_list(category)).alias("cats"))
    weighted = sets.groupBy("cats").agg(F.count(F.lit(1)).alias("_w"))
    pairs = (
        weighted.select("cats", "_w", F.explode("cats").alias("i"))
        .select("i", "_w", F.explode("cats").alias("j"))
        .groupBy("i", "j").agg(F.sum("_w").alias("both"))
    )
    return pairs.join(kept.select(F.col(category).alias("i"), F.col("businesses").alias("size_i")), "i")


def category_overlap(biz_cat: DataFrame, min_count: int = 100, dense: bool = True, category: str = CATEGORY,
                     key: str = "business_id") -> DataFrame:
    """(i, j, share): share of the businesses in category i that are also in j; 1 on the diagonal.

    `dense` adds the pairs with share 0. Not symmetric.
    """
    pairs = category_pairs(biz_cat, min_count, category, key)
    shares = pairs.select("i", "j", (F.col("both").cast("double") / F.col("size_i")).alias("share"))
    if not dense:
        return shares
    axis = shares.agg(F.sort_array(F.collect_set("i"))).scalar()
    return densify(shares, "i", axis, "j", ["share"], fill=0.0)


def row_distances(overlap: DataFrame) -> DataFrame:
    """(a, b, distance), a < b: Euclidean distance between rows that share a non-zero column.

    |a - b|^2 = |a|^2 + |b|^2 - 2ab, where ab needs only the columns both rows have.
    """
    cells = overlap.filter(F.col("share") != 0)
    norms = cells.groupBy("i").agg(F.sum(F.col("share") * F.col("share")).alias("sq"))
    left = cells.select(F.col("i").alias("a"), "j", F.col("share").alias("x"))
    right = cells.select(F.col("i").alias("b"), "j", F.col("share").alias("y"))
    dots = (
        left.join(right, "j").filter(F.col("a") < F.col("b")).groupBy("a", "b")
        .agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    )
    square = F.col("sq_a") + F.col("sq_b") - 2 * F.col("dot")
    return (
        dots.join(norms.select(F.col("i").alias("a"), F.col("sq").alias("sq_a")), "a")
        .join(norms.select(F.col("i").alias("b"), F.col("sq").alias("sq_b")), "b")
        .select("a", "b", F.sqrt(F.greatest(square, F.lit(0.0))).alias("distance"))
    )


def cluster_edges(overlap: DataFrame, cut: float) -> DataFrame:
    """(a, b) links that connect the same rows as all pairs within distance `cut`.

    Rows without a common column have |a - b|^2 = |a|^2 + |b|^2. If such a pair is within the cut, so is
    each of the two with the row of smallest norm; linking to that row replaces all these pairs.
    """
    cells = overlap.filter(F.col("share") != 0)
    norms = cells.groupBy("i").agg(F.sum(F.col("share") * F.col("share")).alias("sq"))
    least = norms.agg(F.min(F.struct("sq", "i")).alias("m")).select("m.sq", "m.i")
    hub, hub_sq = least.select("i").scalar(), least.select("sq").scalar()
    star = norms.filter((F.col("sq") + hub_sq <= cut * cut) & (F.col("i") != hub)).select(
        F.col("i").alias("a"), hub.alias("b")
    )
    near = row_distances(overlap).filter(F.col("distance") <= cut).select("a", "b")
    return near.unionByName(star)


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "i", max_rounds: int = 50) -> DataFrame:
    """(node, component): the least node each node is connected with.

    Each round takes the least label among the neighbours and then the label of that label, so a chain
    shortens by half per round. Labels are written once per round, edges once in all.
    """
    both = cut_lineage(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(nodes.select(F.col(node), F.col(node).alias("component")))
    for _ in range(max_rounds):
        seen = both.join(labels.select(F.col(node).alias("b"), "component"), "b").groupBy("a").agg(
            F.min("component").alias("_near")
        )
        step = labels.join(seen.withColumnRenamed("a", node), node, "left").select(
            node, F.col("component").alias("_old"),
            F.least("component", F.coalesce("_near", "component")).alias("_mid"),
        )
        jump = step.select(F.col(node).alias("_mid"), F.col("_mid").alias("_far"))
        moved = cut_lineage(step.join(jump, "_mid", "left").select(
            node, "_old", F.least("_mid", F.coalesce("_far", "_mid")).alias("component")
        ))
        labels = moved.select(node, "component")
        if moved.filter(F.col("_old") != F.col("component")).isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def category_clusters(overlap: DataFrame, cut: float) -> DataFrame:
    """(i, component): single-linkage clusters of the overlap rows at distance `cut`."""
    cells = cut_lineage(overlap.filter(F.col("share") != 0))
    return connected_components(cells.select("i").distinct(), cluster_edges(cells, cut))


def ordered_overlap(overlap: DataFrame, clusters: DataFrame) -> DataFrame:
    """Overlap cells ordered by cluster and category, in both directions."""
    rows = clusters.select("i", F.col("component").alias("cluster_i"))
    cols = clusters.select(F.col("i").alias("j"), F.col("component").alias("cluster_j"))
    return overlap.join(rows, "i").join(cols, "j").select("cluster_i", "i", "cluster_j", "j", "share").orderBy(
        "cluster_i", "i", "cluster_j", "j"
    )


def rating_vs_checkins(business: DataFrame, biz_cat: DataFrame, totals: DataFrame, key: str = "business_id",
                       dedupe: bool = False) -> DataFrame:
    """(business, avg_checkins, avg_rating); check-ins count once per category row unless dedupe is set."""
    checkins = checkin_total(biz_cat, totals, key, dedupe).select(
        key, F.coalesce("checkins", F.lit(0)).alias("avg_checkins")
    )
    ratings = business.join(biz_cat.select(key).distinct(), key, "left_semi").groupBy(key).agg(
        F.avg("stars").alias("avg_rating")
    )
    return combine(checkins, ratings, key)
