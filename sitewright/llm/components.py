"""Connected components as Spark jobs: alternating large and small stars."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.sources.files import staged


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same nodes as the links (a, b), one per node but the smallest of its component."""
    if not len(a):
        return a, b
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rest = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[rest]], nodes[rest]


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node it is connected with, for every node of the links (columns a, b).

    Every round is a written table, so that a lost executor costs that round at
    most. Minima combine before they are shuffled and are written before they
    are joined, so that a node with many links can be split by adaptive execution.
    """
    low, high = F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")
    now = staged(links.select(low, high).where("u < v").distinct(), "links")
    while not _are_stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "lowest")
        large = both.join(lowest, "u").where("v > u").select(F.col("m").alias("u"), "v").distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(
            F.explode(F.array(F.struct(F.col("m").alias("u"), F.col("u").alias("v")), F.struct(F.col("m").alias("u"), "v"))).alias("s")
        )
        now = staged(small.select("s.u", "s.v").where("u < v").distinct(), "links")
    return now.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )


def _are_stars(links: DataFrame) -> bool:
    """Whether every v has one u, and no u is a v: then each u is its component's smallest node."""
    sides = links.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(0).alias("up")), F.struct(F.col("v").alias("node"), F.lit(1).alias("up")))).alias("s"))
    nodes = sides.groupBy("s.node").agg(F.max("s.up").alias("up"), F.sum("s.up").alias("times"), F.min("s.up").alias("down"))
    return nodes.where("times > 1 OR (up = 1 AND down = 0)").isEmpty()
