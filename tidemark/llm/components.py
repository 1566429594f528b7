"""Connected components of an edge table, distributed: alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import drop, table


class UnionFind:
    """Union-find over integer ids; the root of a set is its smallest id."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over each batch of edges: at most one edge for each node, to its root in the batch."""
    for batch in batches:
        sets = UnionFind()
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.union(a, b)
        nodes = np.fromiter(sets.parent, np.int64, len(sets.parent))
        roots = np.fromiter((sets.find(x) for x in list(sets.parent)), np.int64, len(nodes))
        keep = nodes != roots
        yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(roots[keep])], names=["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns a, b: integer ids) but the roots themselves; a root is
    the smallest id of its component. Edges stay distributed; each step is a written table."""
    edges = table(edges.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")).filter("u <> v").mapInArrow(_forest, "u long, v long").distinct(), "cc-edges")
    mark = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = low.groupBy("u").agg(F.min("v").alias("m"))
        small = low.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        following = table(small, "cc-edges")
        drop(edges)
        edges = following
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
