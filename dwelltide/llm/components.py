"""Connected components of a table of links, without a node's links ever in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwelltide.session import shared_folder


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; a root is one of its nodes.

    Rounds of contraction: every node becomes its smallest neighbour (or itself) in an order
    that a hash draws anew each round, so chains shrink by a constant share whatever their
    ids. Links between the same nodes are then one. A round is an aggregation with partial
    sums on the map side and two joins; its tables are checkpointed, so a lost executor
    costs no earlier round. Rows that hold a null are left out; self links give no node.
    """
    shared_folder(links.sparkSession)
    links = (
        links.filter(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
        .checkpoint()
    )
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    rounds = 0
    while not links.isEmpty():
        rounds += 1
        step = _smallest_neighbours(links, rounds).checkpoint()
        ends = [step.select(F.col("node").alias(e), F.col("to").alias(f"{e}2")) for e in "ab"]
        links = (
            links.join(ends[0], "a")
            .join(ends[1], "b")
            .filter(F.col("a2") != F.col("b2"))
            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
            .distinct()
            .checkpoint()
        )
        if rounds == 1:
            roots = step.withColumnRenamed("to", "root")
        else:
            moved = step.select(F.col("node").alias("root"), "to")
            roots = roots.join(moved, "root", "left").select(
                "node", F.coalesce("to", "root").alias("root")
            )
    return roots


def _smallest_neighbours(links: DataFrame, seed: int) -> DataFrame:
    def placed(name: str):
        return F.struct(F.xxhash64(F.col(name), F.lit(seed)).alias("place"), F.col(name).alias("v"))

    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nearest = both.groupBy("a").agg(F.min(placed("b")).alias("best"))
    return nearest.select(F.col("a").alias("node"), F.least(placed("a"), "best")["v"].alias("to"))
