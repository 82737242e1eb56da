"""Merge trees and leaf orders against agglomeration step by step."""

import math
import random

import pytest

from reviewloom.operators.linkage import DIGITS, complete_edges, linkage, reordered, spanning_tree


def matrix(seed, n, values):
    rng = random.Random(seed)
    names = [f"n{i:02d}" for i in range(n)]
    rng.shuffle(names)
    return {(a, b): 1.0 if a == b else rng.choice(values) for a in names for b in names}


def frame(spark, cells):
    return spark.createDataFrame([(i, j, float(x)) for (i, j), x in cells.items()], "i string, j string, share double")


def distances(cells):
    names = sorted({i for i, _ in cells})
    return names, {(a, b): round(math.sqrt(sum((cells[a, c] - cells[b, c]) ** 2 for c in names)), DIGITS)
                   for a in names for b in names if a < b}


def agglomerate(cells):
    """Merges (i, j, height, size) and the leaves, nearest clusters first, ties by the names of the clusters."""
    names, far = distances(cells)
    clusters = {name: (0, [name], {name}) for name in names}  # made in step, leaves, members
    merges = []
    while len(clusters) > 1:
        height = min(far[min(a, b), max(a, b)] for x, (_, _, m) in clusters.items() for y, (_, _, o) in clusters.items() if x < y for a in m for b in o)
        left = dict(clusters)
        met = []  # clusters linked at this height, by their first names
        while left:
            group, todo = [], [min(left)]
            while todo:
                x = todo.pop()
                group.append(x)
                own = left.pop(x)[2]
                todo += [y for y, (_, _, o) in left.items() if y not in todo and any(far[min(a, b), max(a, b)] <= height for a in own for b in o)]
            met.append(sorted(group))
        for i, *rest in sorted(met):
            for j in rest:
                one, two = sorted([(clusters[x][0], x) for x in (i, j)])
                leaves = clusters[one[1]][1] + clusters[two[1]][1]
                members = clusters[i][2] | clusters.pop(j)[2]
                merges.append((i, j, height, len(members)))
                clusters[i] = (len(merges), leaves, members)
    return merges, next(iter(clusters.values()))[1]


CASES = {
    "general": matrix(1, 9, [0, 0, 0.1, 0.25, 0.4, 0.7]),
    "ties": matrix(2, 8, [0, 0, 0, 1]),
    "apart": {(a, b): float(a == b) for a in "abcde" for b in "abcde"},  # no common columns: all distances equal
    "chain": {(a, b): 1.0 if a == b else 0.9 - 0.1 * abs(ord(a) - ord(b)) if abs(ord(a) - ord(b)) == 1 and b > a else 0.0 for a in "abcdef" for b in "abcdef"},
}


@pytest.mark.parametrize("name", CASES)
def test_linkage_matches_agglomeration(spark, name):
    cells = CASES[name]
    merges, leaves = linkage(frame(spark, cells))
    rows = merges.orderBy("step").collect()
    want, order = agglomerate(cells)
    assert [(r.i, r.j, round(r.height, 6), r["size"]) for r in rows] == [(i, j, round(h, 6), n) for i, j, h, n in want]
    assert [r.i for r in leaves.orderBy("position").collect()] == order
    assert [r.position for r in leaves.orderBy("position").collect()] == list(range(len(order)))


def test_spanning_tree_is_least(spark):
    cells = CASES["general"]
    names, far = distances(cells)
    df = frame(spark, cells)
    tree = spanning_tree(df.select("i").distinct(), complete_edges(df)).collect()
    linked, total = {n: {n} for n in names}, 0.0
    for (a, b), d in sorted(far.items(), key=lambda x: (x[1], x[0])):
        if linked[a] is not linked[b]:
            total += d
            linked[a] |= linked[b]
            for n in linked[a]:
                linked[n] = linked[a]
    assert len(tree) == len(names) - 1 and abs(sum(r.distance for r in tree) - total) < 1e-6


def test_forest_and_odd_tables(spark):
    nodes = spark.createDataFrame([(x,) for x in "abcd"], "i string")
    edges = spark.createDataFrame([("a", "b", 1.0), ("c", "d", 2.0)], "a string, b string, distance double")
    assert {tuple(r) for r in spanning_tree(nodes, edges).collect()} == {("a", "b", 1.0), ("c", "d", 2.0)}
    one = spark.createDataFrame([("x", "x", 1.0)], "i string, j string, share double")
    merges, leaves = linkage(one)
    assert merges.count() == 0 and [tuple(r) for r in leaves.collect()] == [("x", 0)]
    merges, leaves = linkage(one.limit(0))
    assert merges.count() == 0 and leaves.count() == 0


def test_reordered(spark):
    cells = {("a", "a"): 1.0, ("a", "b"): 0.5, ("b", "a"): 0.25, ("b", "b"): 1.0}
    leaves = spark.createDataFrame([("a", 1), ("b", 0)], "i string, position long")
    got = {(r.i_position, r.j_position): r.share for r in reordered(frame(spark, cells), leaves).collect()}
    assert got == {(1, 1): 1.0, (1, 0): 0.5, (0, 1): 0.25, (0, 0): 1.0}
