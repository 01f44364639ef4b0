"""Connected components: parts of the edges are contracted where they lie, then large-star and small-star rounds join the parts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoscope.functions.durable import durable, release


#: Edges that a task contracts together.
PART_EDGES = 500_000


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v) of every node with the smallest one that the same part of the edges joins it to."""
    part: list[pa.RecordBatch] = []

    def stars() -> pa.RecordBatch:
        columns = [pa.chunked_array([b.column(k) for b in part]) for k in range(2)]
        nodes, at = np.unique(np.concatenate([c.to_numpy(zero_copy_only=False) for c in columns]), return_inverse=True)
        u, v = at[: len(at) // 2], at[len(at) // 2 :]
        root = np.arange(len(nodes))
        while True:
            low, after = np.minimum(root[u], root[v]), root.copy()
            np.minimum.at(after, root[u], low)
            np.minimum.at(after, root[v], low)
            after = after[after]
            if (after == root).all():
                break
            root = after
        own = np.flatnonzero(root != np.arange(len(nodes)))
        kind = columns[0].type
        return pa.RecordBatch.from_arrays([pa.array(nodes[own], kind), pa.array(nodes[root[own]], kind)], ["u", "v"])

    for batch in batches:
        part.append(batch)
        if sum(map(len, part)) >= PART_EDGES:
            yield stars()
            part = []
    if part:
        yield stars()


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star step on pairs (u, v): neighbours of u are re-attached to u's smallest neighbour.

    The minimum is a map-side combined aggregate joined back by key, so a node with a third of
    all links is split by the skew join instead of being gathered.
    """
    if large:
        sides = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        return sides.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    down = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Rows (node, component): every node that has an edge, with the smallest node reachable from it.

    edges: two columns of one integer or string type. Nulls and self loops link nothing. Every part of the edges is
    first reduced to stars, one pair a node; rounds are then written to the shared folder until nothing changes.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
    loops = pairs.where("u = v").select("u", "v")
    pairs = pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    kind = pairs.schema["u"].dataType.simpleString()
    now, mark = durable(pairs.mapInArrow(_contracted, f"u {kind}, v {kind}"), "cc"), None
    while True:
        after = durable(_star(_star(now, True), False), "cc")
        release(now)
        now = after
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == tuple(seen):
            break
        mark = tuple(seen)
    roots = now.select(F.col("v").alias("u"), "v").unionAll(loops)
    return now.unionAll(roots).groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
