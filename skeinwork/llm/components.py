"""Connected components of a table of links, by alternating star contractions, each round a few shuffles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.common import hot_join, materialise


def spanning_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) that connect what the given links connect."""
    if not len(a):
        return a, b
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        if (label == before).all():
            break
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = materialise(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n"), "links-least")
    return hot_join(both.filter("v > u"), least, "u", "n", 2 * n).select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = materialise(down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "links-least")
    moved = hot_join(down, least, "u", "n", n).filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the links (a, b): label is the smallest node of its component.

    Links may be repeated, in either direction, or from a node to itself; null ends are left out. Rounds go on
    until none changes a link; each is written to the shared folder, so lost executors cost a round at most.
    """
    edges = edges.filter("a IS NOT NULL AND b IS NOT NULL")
    loops = edges.filter("a = b").select(F.col("a").alias("node")).distinct()
    now = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        after = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if after == state or not after["n"]:
            break
        state = after
        wide = materialise(_large_star(now, after["n"]), "links-wide")
        now = materialise(_small_star(wide, after["n"]), "links")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    centres = stars.select(F.col("label").alias("node"), "label").distinct()
    alone = loops.join(stars.select("node").union(centres.select("node")), "node", "left_anti").select("node", F.col("node").alias("label"))
    return stars.union(centres).union(alone)
