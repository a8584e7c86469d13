"""Connected components of a link table, in rounds of joins.

Links are first replaced by a spanning forest within each partition, which bounds them by the nodes there. Then large
and small stars alternate until nothing changes: every round ties the neighbours of a node to the smallest of them. Each
round is written to the shared folder, so lost executors cost one round at most, and nothing is gathered on the driver
but two sums that tell whether the round changed anything.

A node that is the smallest of very many has all their links under its key. What such a key is joined with is one row, written
before, so that adaptive execution can split the key's links over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import cut


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        p = self.parent
        p.setdefault(x, x)
        top = x
        while p[top] != top:
            top = p[top]
        while p[x] != top:
            p[x], x = top, p[x]
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True

    def links(self) -> list[tuple[int, int]]:
        return [(x, self.root(x)) for x in list(self.parent) if self.root(x) != x]


def _span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
    out = forest.links()
    yield pa.record_batch([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``links`` has two columns of ids. Returns ``node`` and ``component``, the smallest id it is connected with, for
    all nodes that are not their own component's smallest."""
    a, b = links.columns[:2]
    edges = links.select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b")).where("a <> b")
    edges = cut(edges.mapInArrow(_span, "a long, b long"))
    mark = None
    while True:
        # larger neighbours go to the smallest one; a node without smaller neighbours is that itself
        lowest = cut(edges.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("_m")))
        large = cut(edges.join(lowest, "b", "left").select("a", F.coalesce("_m", "b").alias("b")).distinct())
        lowest = cut(large.groupBy("a").agg(F.min("b").alias("_m")))
        small = large.join(lowest, "a").where("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        edges = cut(small.unionByName(lowest.select("a", F.col("_m").alias("b"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.expr("sum(cast(xxhash64(a, b) as decimal(38,0)))")).head()
        if mark == tuple(now):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = tuple(now)
