"""Connected components of an edge table, without gathering edges anywhere."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import textblocks as tb
from daybook.llm.tables import stored

#: A node with more edges than this, and than a thousandth of all their ends, is a hub.
HUB_EDGES = 1000
#: Edges that a task contracts at once.
CHUNK = 200_000


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of edges (a, b) of longs; root is the smallest node reachable.

    First every task contracts the edges it holds, in chunks of bounded size, as long as that halves them:
    paths within a chunk end there. Unless one chunk holds what is left, large-star and small-star steps alternate until nothing
    changes; each step is one combinable minimum per node and one join, and its result is a stored
    table. Loops and nulls are ignored. The edges of a hub stay where they are and its minimum goes to them.
    """
    now = stored(edges.where("a <> b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")), "given")
    mark = _mark(now)
    while True:
        before, chunks = mark, max(1, math.ceil(mark[0] / CHUNK))
        # a chunk may lie in many small files; these are read together
        now = stored(now.coalesce(chunks).mapInArrow(tb.tidy(_contraction(CHUNK)), "a long, b long"), "edges")
        mark = _mark(now)
        if chunks == 1 or 2 * mark[0] > before[0]:
            break
    while chunks > 1:
        # each step is a table of its own: composed, one round's plan would hold the edges dozens of times
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
                     .withColumn("m", F.least("a", "m")), "low")
        hub = max(HUB_EDGES, 2 * mark[0] // 1000)
        large = stored(_beside(both, low, hub).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .distinct(), "large")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "least")
        small = (_beside(large, least, hub).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        now = stored(small, "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _contraction(most: int) -> Callable:
    """Edges of each chunk from its nodes to the smallest node they reach there; chunks hold at most ``most``."""
    def contraction(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = b = np.zeros(0, np.int64)
        for batch in batches:
            if len(a) and len(a) + len(batch) > most:
                a, b = _stars(a, b)
                if 2 * len(a) > most:  # not worth reading on
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                    a = b = np.zeros(0, np.int64)
            a = np.concatenate([a, batch.column("a").to_numpy()])
            b = np.concatenate([b, batch.column("b").to_numpy()])
        a, b = _stars(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    return contraction


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node with the smallest one it reaches, but these themselves."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    low = np.arange(len(nodes))
    while len(x):
        # roots hang below smaller neighbours, then all nodes go up to their roots
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while not (low[low] == low).all():
            low = low[low]
        x, y = low[x], low[y]
        differ = x != y
        x, y = x[differ], y[differ]
    below = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[below], nodes[low[below]]


def _beside(edges: DataFrame, least: DataFrame, hub: int) -> DataFrame:
    """Edges (a, b) with the minimum m of their a.

    Nodes of more than ``hub`` edges, of which there are at most 1000, are broadcast.
    """
    hubs = F.broadcast(least.where(F.col("n") > hub).select("a", "m"))
    others = least.where(F.col("n") <= hub).select("a", "m")
    return edges.join(hubs, "a").unionByName(edges.join(hubs.select("a"), "a", "left_anti").join(others, "a"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
