"""Single-linkage trees: minimum spanning tree, merges with heights and sizes, leaf order.

The items are the rows of a square matrix (categories). All pairs of them, and all their clusters at every height, are
tables of n * n rows at most, as the matrix itself; nothing is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from reviewloom.operators.categories import connected_components, row_distances
from reviewloom.session import cut_lineage

#: digits of distances that count: beyond, the order of a sum decides
DIGITS = 9


def complete_edges(overlap: DataFrame) -> DataFrame:
    """(a, b, distance): edges that hold a minimum spanning tree of all pairs of rows, a < b.

    A pair without a common column has the distance sqrt(|a|^2 + |b|^2), which neither of the two pairs with the row of
    smallest norm exceeds. So of such pairs only those with that row are needed.
    """
    cells = overlap.filter(F.col("share") != 0)
    norms = cells.groupBy("i").agg(F.sum(F.col("share") * F.col("share")).alias("sq"))
    hub = norms.agg(F.min(F.struct("sq", "i")).alias("m")).select(F.col("m.sq").alias("hub_sq"), F.col("m.i").alias("hub"))
    star = norms.crossJoin(F.broadcast(hub)).filter("i <> hub").select(  # one row beside the norms
        F.least("i", "hub").alias("a"), F.greatest("i", "hub").alias("b"), F.sqrt(F.col("sq") + F.col("hub_sq")).alias("distance")
    )
    # a pair with the hub that has a common column is nearer than its row of the star says
    both = row_distances(overlap).unionByName(star).groupBy("a", "b").agg(F.min("distance").alias("distance"))
    return both.withColumn("distance", F.round("distance", DIGITS))


def spanning_tree(nodes: DataFrame, edges: DataFrame, node: str = "i") -> DataFrame:
    """(a, b, distance): the minimum spanning tree (or forest) of the edges, ties by a and b. Runs jobs when called.

    Boruvka: each component takes its first outgoing edge, the components that these join are one in the next round.
    There is one least edge in every cut, so no circles; rounds grow with the logarithm of the number of nodes, and
    edges inside a component leave after each.
    """
    labels = nodes.select(F.col(node).alias("i"), F.col(node).alias("component"))
    rest = cut_lineage(edges.select("a", "b", "distance", F.col("a").alias("from"), F.col("b").alias("to")), "edges")
    tree = None
    while True:
        edge = F.struct("distance", "a", "b", "from", "to")
        least = (
            rest.select(F.explode(F.array("from", "to")).alias("at"), edge.alias("edge"))
            .groupBy("at").agg(F.min("edge").alias("edge")).select("edge.*").distinct()
        )
        least = cut_lineage(least, "tree")
        if least.isEmpty():
            empty = edges.select("a", "b", "distance").limit(0)
            return tree if tree is not None else empty
        taken = least.select("a", "b", "distance")
        tree = taken if tree is None else tree.unionByName(taken)
        parts = labels.select(F.col("component").alias("i")).distinct()
        joined = connected_components(parts, least.select(F.col("from").alias("a"), F.col("to").alias("b")))
        labels = cut_lineage(labels.join(joined.select(F.col("i").alias("component"), F.col("component").alias("_next")), "component")
                             .select("i", F.col("_next").alias("component")), "labels")
        start = joined.select(F.col("i").alias("from"), F.col("component").alias("_from"))
        end = joined.select(F.col("i").alias("to"), F.col("component").alias("_to"))
        rest = cut_lineage(
            rest.join(start, "from").join(end, "to").filter("_from <> _to")
            .select("a", "b", "distance", F.col("_from").alias("from"), F.col("_to").alias("to")), "edges",
        )


def cluster_levels(nodes: DataFrame, tree: DataFrame, node: str = "i") -> DataFrame:
    """(level, height, i, leader): the first name of each node's cluster at every height of the tree, level 0 without merges.

    All heights are settled at once: the tree's edges are repeated for each height they are in, and the components of
    (height, node) are found together.
    """
    heights = tree.select(F.col("distance").alias("height")).distinct()
    heights = heights.withColumn("level", F.dense_rank().over(W.orderBy("height")))  # one row per height of the tree
    heights = cut_lineage(heights, "heights")
    at = nodes.select(F.col(node).alias("node")).crossJoin(heights).select(F.struct("level", "node").alias("i"))
    held = tree.join(heights, F.col("distance") <= F.col("height"))
    edges = held.select(F.struct("level", F.col("a").alias("node")).alias("a"), F.struct("level", F.col("b").alias("node")).alias("b"))
    found = connected_components(at, edges).select(
        F.col("i.level").alias("level"), F.col("i.node").alias("i"), F.col("component.node").alias("leader")
    ).join(heights, "level")
    alone = nodes.select(F.lit(0).alias("level"), F.col(node).alias("i"), F.col(node).alias("leader"), F.lit(0.0).alias("height"))
    return found.select("level", "height", "i", "leader").unionByName(alone)


def merge_tree(levels: DataFrame) -> DataFrame:
    """(step, i, j, height, size, left, right, left_size): the cluster that begins with j joins the one that begins with i.

    Clusters are named by their first name, and every name but the first of all ends once as the joining one. Clusters that
    meet at one height join in the order of their names. Steps count from 1 by height, i and j. left and right are the
    joined clusters as (step, name): step 0 and the name for a single node, else the step that made it and its first
    name; left is the one with the smaller step, of single nodes the first name.
    """
    levels = cut_lineage(levels, "levels")
    below = levels.select((F.col("level") + 1).alias("level"), "i", F.col("leader").alias("before"))
    sizes = below.groupBy("level", F.col("before").alias("j")).agg(F.count(F.lit(1)).alias("own"))
    ends = levels.filter("level > 0").join(below, ["level", "i"]).filter("i = before and leader <> before")
    merges = ends.select("level", "height", F.col("leader").alias("i"), F.col("before").alias("j")).join(sizes, ["level", "j"])
    firsts = sizes.select("level", F.col("j").alias("i"), F.col("own").alias("start"))
    upto = W.partitionBy("level", "i").orderBy("j").rowsBetween(W.unboundedPreceding, 0)
    sized = merges.join(firsts, ["level", "i"]).withColumn("size", F.col("start") + F.sum("own").over(upto))
    # one row per node but one: the names of the matrix
    steps = cut_lineage(sized.withColumn("step", F.row_number().over(W.orderBy("height", "i", "j"))), "steps")
    before = F.coalesce(F.lag("step").over(W.partitionBy("i").orderBy("step")), F.lit(0))
    made = steps.groupBy(F.col("i").alias("j")).agg(F.max("step").alias("j_step"))
    both = steps.withColumn("i_step", before).join(made, "j", "left").withColumn("j_step", F.coalesce("j_step", F.lit(0)))
    one, two = F.struct(F.col("i_step").alias("step"), F.col("i").alias("name")), F.struct(F.col("j_step").alias("step"), F.col("j").alias("name"))
    first = F.col("i_step") <= F.col("j_step")  # of two single nodes i is the first name
    return both.select(
        "step", "level", "i", "j", "height", "size", F.when(first, one).otherwise(two).alias("left"),
        F.when(first, two).otherwise(one).alias("right"), F.when(first, F.col("size") - F.col("own")).otherwise(F.col("own")).alias("left_size"),
    )


def leaf_order(levels: DataFrame, merges: DataFrame) -> DataFrame:
    """(i, position): the nodes from left to right below the tree, from 0.

    A node stands behind the left side of every merge that has it on the right side.
    """
    levels = cut_lineage(levels, "levels")
    below = levels.select((F.col("level") + 1).alias("level"), F.col("i").alias("node"), F.col("leader").alias("before"))
    at = levels.select("level", F.col("i").alias("node"), F.col("leader").alias("i")).join(below, ["level", "node"])
    met = at.join(merges, ["level", "i"]).filter(F.col("before") <= F.col("j"))
    i_left = F.col("left.name") == F.col("i")
    on_right = F.when(F.col("before") == F.col("j"), i_left).otherwise(~i_left)
    shift = met.groupBy("node").agg(F.sum(F.when(on_right, F.col("left_size")).otherwise(0)).alias("position"))
    everyone = levels.filter("level = 0").select(F.col("i").alias("node"))
    return everyone.join(shift, "node", "left").select(F.col("node").alias("i"), F.coalesce("position", F.lit(0)).cast("long").alias("position"))


def linkage(overlap: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merges, leaves) of the rows of an overlap matrix: see merge_tree and leaf_order. Runs jobs when called."""
    cells = cut_lineage(overlap.filter(F.col("share") != 0), "cells")
    nodes = cells.select("i").distinct()
    levels = cut_lineage(cluster_levels(nodes, spanning_tree(nodes, complete_edges(cells))), "levels")
    merges = cut_lineage(merge_tree(levels), "merges")
    return merges, leaf_order(levels, merges)


def reordered(overlap: DataFrame, leaves: DataFrame) -> DataFrame:
    """The cells of the matrix with the leaf positions of their row and column."""
    rows, cols = (leaves.select(F.col("i").alias(c), F.col("position").alias(f"{c}_position")) for c in ("i", "j"))
    return overlap.join(rows, "i").join(cols, "j").select("i_position", "j_position", "i", "j", "share")
