"""Connected components of an edge table.

Up to LOCAL_EDGES edges, a bounded number, one task joins them in memory. Larger tables go through alternating
large-star and small-star steps, which never gather a node's edges in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

LOCAL_EDGES = 500_000


def _join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """node, label for all edges of the partition; the label is the smallest node."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        root = x
        while up[root] != root:
            root = up[root]
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    for pdf in batches:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
            up.setdefault(a, a)
            up.setdefault(b, b)
            x, y = top(a), top(b)
            if x != y:
                up[max(x, y)] = min(x, y)
    if up:
        yield pd.DataFrame({"node": list(up), "label": [top(x) for x in up]})


def _stars(edges: DataFrame) -> DataFrame:
    """The same by steps that pre-aggregate a minimum for each node; every step is stored in the shared folder."""
    now = settle(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state == before or not state["n"]:
            break
        before = state
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = settle(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct())
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """node, label for all nodes of edges (a, b: longs); the label is the smallest node of the component."""
    edges = edges.filter("a <> b").select("a", "b")
    if edges.count() <= LOCAL_EDGES:
        return edges.coalesce(1).mapInPandas(_join, "node long, label long")
    return _stars(edges)
