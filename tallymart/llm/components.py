"""Connected components of a graph that is never brought together in one place."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tallymart.session import checkpointed


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) for every node that has an edge to another node.

    Alternating star contraction: every node hands its larger neighbours, then its smaller ones, to
    the smallest node it knows, until nothing changes (logarithmically many rounds). Minima are
    combined before the shuffle; a round only joins an edge list with one row per node, so a node
    with very many edges can be split by adaptive execution. Edges with a null end are ignored.
    """
    star = checkpointed(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    before = None
    while True:
        now = star.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before or now[0] == 0:
            return star.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                star.select("v", "v").distinct())
        before = now
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        star = checkpointed(small.union(least).distinct())


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent`` (smallest row known to be connected, by row) after the links a[i]-b[i]; numpy inside one task."""
    while True:
        ra, rb = parent[a], parent[b]
        open_ = ra != rb
        if not open_.any():
            return parent
        a, b = a[open_], b[open_]
        np.minimum.at(parent, np.maximum(ra, rb)[open_], np.minimum(ra, rb)[open_])
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
