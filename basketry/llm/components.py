"""Connected components of a table of links, in rounds of large and small stars."""

import numpy as np
from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour instead."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are linked to the least of them. ``u`` is the larger end."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return joined.where("v > m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
        least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, as (u, v) with u > v."""
    return links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): for each node of ``links`` (a, b) with a neighbour, the least node it is linked with,
    directly or over others. Rounds end when the links no longer change, after about the logarithm of the longest
    path; no node's neighbours are ever gathered."""
    edges, before = stage(_ordered(links), "links"), None
    while True:
        # Both results are links whose smaller end is the least neighbour so far.
        edges = stage(_ordered(_small_star(_ordered(_large_star(edges)))), "links")
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(v as decimal(38, 0)))")).first()
        if now == before:
            break
        before = now
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place linked with each of n places, for links (i, j) that fit one task."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def star_links(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows (node, least node) that link the same nodes as the links (a, b), at most one for each node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = forest(len(nodes), at[:len(a)], at[len(a):])
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[moved], nodes[label[moved]]], 1)
