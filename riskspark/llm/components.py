"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.session import cut_lineage


def star_edges(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member index of the component of each of ``n`` points (in one task)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            break
    return label


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest
    node of the component.  Each round re-hangs neighbours on the smallest one
    they see (large star, then small star); the stars are complete when a round
    changes nothing.  Minima are pre-aggregated and joined back, so a hub is
    split by the skew join instead of being gathered.  Every round is
    checkpointed.  NULL nodes and self-links are ignored."""
    edges = cut_lineage(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # rows now point down: a > b
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        )
        edges = cut_lineage(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
