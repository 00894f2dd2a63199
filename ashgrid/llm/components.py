"""Connected components of a graph given as links between numbers.

Alternating large-star and small-star steps, each one grouping by a node: links
move to ever smaller neighbours until every component is a star around its
smallest member.  Every round is written to the shared folder; nothing but one
flag per round reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the first node that the links (a, b) connect it with."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, a, root[b])
        np.minimum.at(least, b, root[a])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of node and neighbours:
    its larger ones (large star), or its smaller ones and itself (small star)."""
    if large:
        near = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return (near.filter(F.col("v") > F.col("u")).join(least, "u")
                .select(F.col("m").alias("v"), F.col("v").alias("u")).filter("u <> v").select("u", "v").distinct())
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").distinct()


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component) of every node in ``links`` (u, v), both never null;
    component is the smallest node reachable.  The smallest member itself is a
    row too.  Isolated nodes are the caller's."""
    now = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
    for _ in range(rounds):
        now = materialize(_star(_star(now, True), False), "links")
        # a forest of stars: nobody with two parents, no parent that has one
        parents = now.select(F.col("v").alias("p")).distinct()
        if now.join(parents, now["u"] == parents["p"], "left_semi").isEmpty() and \
                now.groupBy("u").count().filter("count > 1").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    raise RuntimeError(f"components did not settle in {rounds} rounds")
