"""Connected components by star contraction, and places in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged, unstaged


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b, of one type that has an order): rows (node, root), where
    root is the smallest node that can be reached. Nodes without an edge have no row.

    Alternates large-star and small-star contraction: each round is one grouped minimum and one
    join, a node's neighbours are never collected into a list, and the number of rounds grows
    with the logarithm of the longest path. Edges of null ends and loops are ignored; no edges,
    no rows."""
    now = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    now = staged(now, "edges")
    while not _is_star(now):
        last, now = now, staged(_small_star(_large_star(now)), "edges")
        unstaged(last)
    nodes = now.groupBy("hi").agg(F.min("lo").alias("root")).select(F.col("hi").alias("node"), "root")
    return nodes.unionByName(now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _is_star(e: DataFrame) -> bool:
    """Every hi has one lo, and no lo is a hi."""
    twice = e.groupBy("hi").agg(F.count("*").alias("n")).where("n > 1").select("hi")
    chained = e.select(F.col("lo").alias("hi")).join(e.select("hi"), "hi", "left_semi")
    return twice.unionByName(chained).isEmpty()


def _large_star(e: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to its smallest neighbour (or itself)."""
    both = e.select(F.col("hi").alias("v"), F.col("lo").alias("u")).unionByName(e.select(F.col("lo").alias("v"), F.col("hi").alias("u")))
    least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
    return both.where("u > v").join(least, "v").where("u != m").select(F.col("u").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Link each node's smaller neighbours, and itself, to the smallest of them."""
    least = e.groupBy("hi").agg(F.min("lo").alias("m"))
    down = e.join(least, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return down.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def places(rows: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """``rows`` with their places, from 1, in a global order that is total: sorted in ranges, each counted on from those before it.

    No task sees more than a range; the table of the ranges' sizes has a row for each partition."""
    dealt = staged(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + within).drop("_range", "_before")
