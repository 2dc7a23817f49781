"""Connected components of an edge table by alternating star operations.

Each round hooks neighbours onto the smallest neighbour, first the larger ones (large star)
and then the smaller ones (small star), until every component is a star around its smallest
node. Rounds are checkpointed, so a lost executor costs one round at most; no component is
ever gathered in a task, and a node with very many neighbours is only ever aggregated over
or stands on one side of a join that Spark may split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import durable

_MAX_ROUNDS = 60
_BATCH_EDGES = 200_000
# A part holds so many edges before there are more than the least number of parts: every part of
# a shuffle costs some files, whatever few edges it has.
_PART_EDGES, _LEAST_PARTS = 50_000, 8


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars with the same components as the edges of each bounded run of them."""
    for batch in batches:
        for start in range(0, batch.num_rows, _BATCH_EDGES):
            part = batch.slice(start, _BATCH_EDGES)
            ends = np.stack([part.column(0).to_numpy(), part.column(1).to_numpy()])
            nodes, edges = np.unique(ends, return_inverse=True)
            edges = edges.reshape(2, -1)
            parent = list(range(len(nodes)))

            def root(x):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for a, b in edges.T.tolist():
                a, b = root(a), root(b)
                parent[max(a, b)] = min(a, b)
            tops = np.array([root(x) for x in range(len(nodes))], np.int64)
            low = tops != np.arange(len(nodes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[low], pa.int64()), pa.array(nodes[tops[low]], pa.int64())], names=["u", "v"]
            )


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.coalesce(parts).distinct().coalesce(parts)


def _small_star(edges: DataFrame, parts: int) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    stars = moved.union(least.select("u", F.col("m").alias("v")))
    return stars.coalesce(parts).distinct().coalesce(parts)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    Ends are integers; edges with a NULL end or between a node and itself are ignored.
    """
    low, high = F.least(a, b).cast("long"), F.greatest(a, b).cast("long")
    own = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    stars = own.select(high.alias("u"), low.alias("v")).mapInArrow(_forest, "u long, v long")
    stars = stars.distinct().transform(durable)
    mark, parts = None, _LEAST_PARTS
    for _ in range(_MAX_ROUNDS):
        state = stars.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if (state.n, state.h) == mark or not state.n:
            break
        mark = (state.n, state.h)
        parts = max(_LEAST_PARTS, -(-state.n // _PART_EDGES))
        stars = _small_star(_large_star(stars.coalesce(parts), parts), parts).transform(durable)
    else:
        raise RuntimeError("components did not settle")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct().coalesce(parts)
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
