"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyflow.llm.shared import stored


def connected_components(links: DataFrame) -> DataFrame:
    """Label every node of ``links`` (columns ``a``, ``b``, long) with the smallest node it reaches.

    Returns ``node, label`` for nodes with a link to another node, the smallest of each component
    included. Links to oneself, repeated links and rows with a null count for nothing; no links
    give no rows.

    Each round points every larger neighbour of a node at its smallest neighbour, then every
    smaller one; the graph turns into stars after about as many rounds as the logarithm of the
    longest path. Only minima are aggregated, so a hub costs one row for each task, and its
    links stay spread over the join, which adaptive execution splits.
    """
    links = links.where(F.col("a") != F.col("b"))
    now = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        now = stored(_small_star(_large_star(now)), "stars")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select("b", "b").distinct())


def _large_star(links: DataFrame) -> DataFrame:
    ways = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return ways.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    rest = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).union(rest).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the position of a smaller or equal member) after linking ``a[i]`` to ``b[i]``."""
    while True:
        high, low = np.maximum(label[a], label[b]), np.minimum(label[a], label[b])
        apart = high != low
        if not apart.any():
            return label
        np.minimum.at(label, high[apart], low[apart])
        while not np.array_equal(label, label[label]):
            label = label[label]
