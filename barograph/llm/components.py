"""Connected components over a table of links, and union-find within a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.llm.tables import written
from barograph.workspace import drop_folder


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns ``node`` and ``root``, its component's smallest node, for all nodes of links.

    Each round hangs a node's larger neighbours on its smallest one, then its
    smaller ones too, until all components are stars. Links stay on the
    executors; the driver sees a count and a checksum per round. A round's table
    goes once the next one is written. A node with most of the links is a skewed
    join side, which adaptive execution splits.
    """

    def directed(rows: DataFrame, x: str, y: str) -> DataFrame:
        return rows.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))

    first = directed(links, a, b).filter("a <> b").distinct()
    edges, folder = written(first, "components")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        larger = both.filter("v > u").join(least, "u").select(
            F.col("v").alias("a"), F.col("m").alias("b")
        )
        smallest = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(smallest, "a").filter("b <> m").select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        hung = smallest.select("a", F.col("m").alias("b"))
        before = folder
        edges, folder = written(smaller.union(hung).distinct(), "components")
        drop_folder(links.sparkSession, before)
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )


class Union:
    """Union-find over positions 0..n-1 that takes many links at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        a, b = self.root[left], self.root[right]
        apart = a != b
        if not apart.any():
            return
        pairs = np.unique(np.stack([a[apart], b[apart]], axis=1), axis=0)
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = x = parent.get(up, up)
            return x

        for x, y in pairs.tolist():
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        moved = np.arange(len(self.root))
        for x in parent:
            moved[x] = find(x)
        self.root = moved[self.root]
