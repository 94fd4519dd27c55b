"""Connected components of an edge table: local contraction, then alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.session import materialize, ship_package

#: Edges that one task contracts at most, on average; a larger table takes more tasks and the star rounds.
EDGES_PER_TASK = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as stars: each node hangs on the least node that it reaches within the task."""
    ends = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not ends:
        return
    nodes, at = np.unique(np.concatenate([np.concatenate(e) for e in zip(*ends)]), return_inverse=True)
    u, v = at[:len(at) // 2], at[len(at) // 2:]
    root = np.arange(len(nodes))
    while True:  # nodes are sorted, so the least root is the least node
        least = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], least)
        np.minimum.at(new, root[v], least)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == root).all():
            break
        root = new
    own = np.flatnonzero(root != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], names=["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of ``edges`` (a, b) reaches.

    Edges are dealt evenly, whatever their nodes, and each task first replaces its edges by stars.  If one task held all edges
    (``EDGES_PER_TASK``), the stars are the components.  Otherwise rounds hang
    neighbours to their least neighbour, first those above a node, then those
    below, until the edges stay as they are; minima are taken with partial
    aggregation, and no neighbourhood is gathered.
    """
    ship_package(edges.sparkSession)
    edges = edges.select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
    edges = materialize(edges.where(F.col("u").isNotNull() & F.col("v").isNotNull()), "components")
    tasks = -(-edges.count() // EDGES_PER_TASK)
    loops = edges.where(F.col("u") == F.col("v")).select(F.col("u").alias("node"), F.col("v").alias("component"))
    dealt = edges.coalesce(1) if tasks <= 1 else edges.repartition(tasks)
    edges = materialize(dealt.where(F.col("u") != F.col("v")).mapInArrow(_contract, "u long, v long"), "components")
    mark = None
    while tasks > 1:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(edges.join(least, "u").select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(below.select("u", F.col("m").alias("v")))
        edges = materialize(small.where(F.col("u") != F.col("v")).distinct(), "components")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return labels.unionByName(roots).unionByName(loops).groupBy("node").agg(F.min("component").alias("component"))
