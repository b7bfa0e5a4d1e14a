"""Connected components of a link table by contraction, without collecting links anywhere."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label`` for every node with a link; equal labels mean connected. NULL ends are ignored.

    Each round every node points to the neighbour (or itself) that comes first in a fixed pseudo-random
    order; links are rewritten to the targets, and loops and repeats go. Connected nodes stay connected, a star
    vanishes in two rounds and a chain loses a constant share of its nodes per round. Only minima and
    equi-joins are used, so a node with very many links is combined before the shuffle and split in the join.
    Rounds are written to the shared folder.
    """
    order = lambda c: F.struct(F.xxhash64(F.lit(1), c).alias("_h"), F.col(c).alias("_n"))
    open_links = materialize(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "links")
    steps = []
    while not open_links.isEmpty():
        both = open_links.unionByName(open_links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        best = both.groupBy("u").agg(F.min(order("v")).alias("best"))
        step = materialize(best.select("u", F.least(order("u"), "best")["_n"].alias("to")), "targets")
        steps.append(step)
        moved = open_links.join(step, "u").select(F.col("to").alias("_a"), F.col("v").alias("u")).join(step, "u").select(F.col("_a").alias("u"), F.col("to").alias("v"))
        tidy = moved.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        open_links = materialize(tidy, "links")
    if not steps:
        return open_links.select(F.col("u").alias("node"), F.col("v").alias("label"))

    def follow(known: DataFrame, step: DataFrame) -> DataFrame:
        nxt = step.select(F.col("u").alias("label"), F.col("to").alias("_to"))
        return known.join(nxt, "label", "left").select("node", F.coalesce("_to", "label").alias("label"))

    first = steps[0].select(F.col("u").alias("node"), F.col("to").alias("label"))
    return materialize(reduce(follow, steps[1:], first), "labels")


def labels_of_pairs(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Least node reachable from each of ``size`` nodes through the pairs of one block, inside a task."""
    root = np.arange(size)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low
