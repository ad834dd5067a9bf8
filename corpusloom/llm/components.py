"""Connected components by alternating large-star and small-star.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014).
Each step is a minimum per node, combined on the map side, and a join back, so
no node's neighbours are gathered in one place.  Every step is written to the
shared folder: lineage is cut and lost executors cost one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.staging import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    pair = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                   F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    return edges.select(F.inline(pair))


def _star(arcs: DataFrame, take) -> DataFrame:
    """Join every node's neighbours that ``take`` selects to its least neighbour."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = arcs.where(take).join(least, "u").select("v", "m")
    return joined


def _normal(edges: DataFrame) -> DataFrame:
    """Distinct ``(a, b)`` with ``a < b``."""
    return edges.where("v <> m").select(F.least("v", "m").alias("a"), F.greatest("v", "m").alias("b")).distinct()


def large_star(edges: DataFrame) -> DataFrame:
    """Greater neighbours of each node move to the least of its neighbourhood."""
    return _normal(_star(_both_ways(edges), F.col("v") > F.col("u")))


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours move to the least of them."""
    arcs = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = arcs.groupBy("u").agg(F.min("v").alias("m"))
    moved = arcs.join(least, "u").select("v", "m").unionByName(least.select(F.col("u").alias("v"), "m"))
    return _normal(moved)


def _mark(edges: DataFrame) -> tuple:
    marks = edges.select(F.xxhash64("a", "b").cast("decimal(38,0)").alias("h"))
    return tuple(marks.agg(F.count("*"), F.sum("h")).first())


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``).

    The component is the least node that can be reached.  Loops and null ends
    are ignored; without edges the result is empty.  Rounds grow with the
    logarithm of the number of nodes; ``max_rounds`` only guards against
    endless work and raises, it never returns an unfinished result.
    """
    edges = edges.where("a is not null and b is not null and a <> b")
    edges = stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(edges)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        edges = stage(small_star(stage(large_star(edges), "large-star")), "small-star")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)
