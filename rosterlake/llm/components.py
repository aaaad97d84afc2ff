"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterlake.session import settle

#: Links that a task holds and joins at once, 4 MB of them.
LINKS_AT_ONCE = 1 << 18


def least_of(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links ``u``, ``v`` that are not the smallest of their component, and that smallest one."""
    names, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    root, one, two = np.arange(len(names)), flat[:len(u)], flat[len(u):]
    while True:
        low, high = np.minimum(root[one], root[two]), np.maximum(root[one], root[two])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    at = np.flatnonzero(root != np.arange(len(names)))
    return names[at], names[root[at]]


def joined_in_tasks(edges: DataFrame, tasks: int) -> DataFrame:
    """The links as stars of the components that a task sees among ``LINKS_AT_ONCE`` of them; they connect the same nodes."""
    out = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def stars(found: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in found]) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in least_of(*columns)], schema=out)

    def joined(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, count = [], 0
        for batch in found:
            if count + batch.num_rows > LINKS_AT_ONCE:
                yield stars(waiting) if waiting else batch.slice(0, 0)
                waiting, count = [], 0
            waiting.append(batch)
            count += batch.num_rows
        if waiting:
            yield stars(waiting)

    return edges.select("u", "v").coalesce(tasks).mapInArrow(joined, "u bigint, v bigint")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of all nodes in links ``u``, ``v`` (of type bigint).

    Tasks first join the links they read, so what a task can hold at once is done in one step. Else each round links
    every node's larger neighbours, then its smaller ones, to its smallest neighbour; the
    links become stars in a number of rounds that grows with the logarithm of a component's size. Rounds are
    written to the shared folder, so a lost executor costs one round at most, and no component is ever held
    by one task that could not hold all links. Null nodes and links of a node with itself are left out; an empty table gives
    an empty one.
    """
    edges = settle(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links"
    )
    for _ in range(max_rounds):
        n = edges.count()
        if n == 0:
            break
        edges = settle(joined_in_tasks(edges, -(-n // LINKS_AT_ONCE)), "joined")
        if n <= LINKS_AT_ONCE:
            break
        # the least neighbours are written out: a join of two plain shuffles can split the many rows of one node
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(settle(low, "least"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.distinct(), "large_stars")
        low = settle(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        near = large.join(low, "u")
        small = near.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m"))
        edges = settle(small.distinct(), "stars")
        # stars alone are left once no node has two links down, or one down and one up
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
            edges.select("v", F.lit(0), F.lit(1)))
        if ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).filter("down + up > 1").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", F.col("v")))
