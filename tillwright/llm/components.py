"""Connected components by alternating stars, as joins and minima.

Each round hangs all larger neighbours of a node on its smallest neighbour (large star), then all
smaller ones (small star). Minima combine before the shuffle and no neighbour list is ever
gathered, so a node with a third of all links does no harm. Every round is written to the shared
work folder; the rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node, component` for every node that has a link to another; component is the least node.

    Links may repeat, point either way or point at themselves; those with a null end are ignored.
    """
    first, second = F.col(a).cast("long"), F.col(b).cast("long")
    edges = written(
        links.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v"))
        .where((first != second)).distinct(),
        "links",
    )
    state = _signature(edges)
    while state[0]:
        edges = written(_small_star(_large_star(edges)), "stars")
        before, state = state, _signature(edges)
        if state == before:
            break
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v") % 1000003)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
        edges.select(F.col("v").alias("x"), F.col("u").alias("y"))
    )
    least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("m", "x").alias("m"))
    hung = both.where("y > x").join(least, "x")
    return hung.select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
