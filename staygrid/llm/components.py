"""Connected components of a link table, by alternating large-star and small-star rounds.

Every round is a few joins and minima and ends in a table in the shared folder, so a lost
executor costs at most the round. Joins are on a node against one row for each node, so a hub's
rows can be split; minima combine before the shuffle.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import drop_table, materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node it reaches) for each node of `links` (a, b: long) that isn't a root."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(edges, "links")
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
        lowest = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        large = both.join(lowest, "x").where("y > x and y <> m").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = materialize(small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "links")
        drop_table(edges)
        before, state, edges = state, _state(after), after
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def merge_labels(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Union the sets of u[i] and v[i]; labels[i] is the smallest index of i's set."""
    while True:
        a, b = labels[u], labels[v]
        differ = a != b
        if not differ.any():
            return labels
        u, v, a, b = u[differ], v[differ], a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while (labels[labels] != labels).any():
            labels = labels[labels]
