"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafworks.session import materialise

#: Edges that one task takes on at the end; more are contracted first. Both ways give the same components.
LOCAL_EDGES = 2_000_000


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, least vertex of its component), by pointer jumping over arrays."""
    ids, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a) :]
    root = np.arange(len(ids))
    while len(x):
        lo, hi = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        np.minimum.at(root, hi, lo)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        live = root[x] != root[y]
        x, y = x[live], y[live]
    return ids, ids[root]


def components(edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(id, label) for each vertex of ``edges`` (a, b bigint): label is the least id of its component.

    While the edges are too many for one task, every vertex is contracted into the neighbour (or itself) that comes first in
    a new pseudo-random order, which shrinks the graph by a constant factor a round; then one task solves the rest, and the
    contractions are undone.
    """
    edges = materialise(edges.where("a <> b").distinct(), "edges")
    vertices, rounds, k = None, [], 0
    while edges.count() > local_edges:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = lambda c: F.struct(F.xxhash64(c, F.lit(k)).alias("h"), F.col(c).alias("id"))
        hop = both.groupBy("a").agg(F.least(F.min(first("b")), F.first(first("a")))["id"].alias("to")).withColumnRenamed("a", "id")
        hop = materialise(hop, f"hop-{k}")
        left = edges.join(hop.select(F.col("id").alias("a"), F.col("to").alias("x")), "a")
        edges = materialise(left.join(hop.select(F.col("id").alias("b"), F.col("to").alias("y")), "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), f"edges-{k}")
        rounds.append(hop)
        k += 1

    def solve(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = list(parts)
        if whole:
            pdf = pd.concat(whole)
            ids, labels = union_find(pdf["a"].to_numpy(), pdf["b"].to_numpy())
            yield pd.DataFrame({"id": ids, "label": labels})

    found = edges.coalesce(1).mapInPandas(solve, "id bigint, label bigint")
    if not rounds:
        return materialise(found, "components")
    found = materialise(found, "components")
    for hop in reversed(rounds):
        to = found.select(F.col("id").alias("to"), "label")
        found = materialise(hop.join(to, "to", "left").select("id", F.coalesce("label", "to").alias("label")), "components")
    # labels of contracted graphs need not be the least id
    least = found.groupBy("label").agg(F.min("id").alias("least"))
    vertices = found.join(least, "label").select("id", F.col("least").alias("label"))
    return materialise(vertices, "components")
