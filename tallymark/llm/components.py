"""Connected components of a graph whose edges no machine holds alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import materialised
from tallymark.operators.rows import fresh_rows


def _towards_least(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Link neighbours to the least node of a neighbourhood: one half of a star round.

    both_ways: greater neighbours of each node go to its least neighbour ("large star");
    otherwise a node and its smaller neighbours go to the least of them ("small star").
    """
    if both_ways:
        near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    # Shuffled anew, so that the join can split a node with very many neighbours.
    moved = near.join(fresh_rows(least), F.col("a") == F.col("node"))
    if both_ways:
        out = moved.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("node").alias("a"), F.col("m").alias("b"))
        )
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> (node, component): the least node it is connected with.

    Alternates large and small stars until every node hangs on its least node; each round is
    written to the shared folder. Rounds grow with the logarithm of the longest chain. Nodes
    that are their own component's least node are included if they have an edge.
    """
    current = materialised(edges.filter(F.col("a") != F.col("b")).distinct(), "components")
    state = None
    while True:
        now = current.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if (now.n, now.s) == state or now.n == 0:
            break
        state = (now.n, now.s)
        current = materialised(_towards_least(_towards_least(current, True), False), "components")
    hung = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = hung.select("component").distinct()
    return hung.union(roots.select(F.col("component").alias("node"), "component"))
