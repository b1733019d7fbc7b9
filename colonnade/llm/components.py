"""Connected components of a link table, by hooking to the smallest neighbour and contracting."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.session import checkpoint_root


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (columns ``a``, ``b``): root is the smallest node reachable.

    Each round points every node at its smallest neighbour, shortens the pointer chains by doubling
    and rewrites the links between the roots. A root that still has links merges with another one,
    so rounds grow with the logarithm of the component. Minima are combined before they are
    shuffled, so a hub of any degree arrives as one row per task. Every round is checkpointed, which
    cuts the lineage and survives a lost executor. Nulls and self-links do not link.
    """
    checkpoint_root(links.sparkSession)
    open_ = links.select("a", "b").filter("a <> b").distinct().checkpoint()
    known = None
    while not open_.isEmpty():
        both = open_.union(open_.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("r")).checkpoint()
        while True:
            far = up.select(F.col("a").alias("r"), F.col("r").alias("rr"))
            up = up.join(far, "r", "left").select("a", F.coalesce("rr", "r").alias("r"), F.coalesce(F.col("rr") != F.col("r"), F.lit(False)).alias("moved")).checkpoint()
            done = up.filter("moved").isEmpty()
            up = up.drop("moved")
            if done:
                break
        if known is None:
            known = up.select(F.col("a").alias("node"), F.col("r").alias("root"))
        else:
            to = up.select(F.col("a").alias("root"), F.col("r").alias("top"))
            known = known.join(to, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        ends = up.select(F.col("a"), F.col("r").alias("ra")), up.select(F.col("a").alias("b"), F.col("r").alias("rb"))
        open_ = open_.join(ends[0], "a").join(ends[1], "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")).filter("a <> b").distinct().checkpoint()
    if known is None:
        return open_.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return known.checkpoint()


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` nodes reaches over the links ``i``-``j``."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        root = new[root]
        open_ = root[i] != root[j]
        i, j = i[open_], j[open_]
    return root
