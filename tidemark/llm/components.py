"""Connected components by union-find in partitions and contraction between them.

Each round runs union-find over the links of every partition, so a partition
gives at most one row per node it saw. A node with several roots links those
roots to the smallest; these fewer links are the next round's input. When no
node has two roots the rounds end, and the parents are followed back. Links,
nodes and components stay in tables; the driver only learns whether links are left.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import stored


def _local(batches):
    parent: dict = {}

    def find(x):
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = list(parent)
    for i in range(0, len(nodes), 50_000):
        own = nodes[i:i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array([find(x) for x in own], pa.binary())], names=["node", "root"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: binary); the root is one of the component's nodes."""
    levels = []
    open_links = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    while levels == [] or not open_links.isEmpty():
        forest = stored(open_links.mapInArrow(_local, "node binary, root binary"), "forest")
        best = stored(forest.groupBy("node").agg(F.min("root").alias("root")), "roots")
        levels.append(best)
        several = forest.join(best.withColumnRenamed("root", "least"), "node").filter("root <> least")
        open_links = stored(several.select(F.col("root").alias("a"), F.col("least").alias("b")).distinct(), "links")
    final = levels.pop()
    while levels:
        up = final.select(F.col("node").alias("root"), F.col("root").alias("top"))
        # A parent without an entry of its own in the later round is a root already.
        final = levels.pop().join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return stored(final, "components")
