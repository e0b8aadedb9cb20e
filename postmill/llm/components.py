"""Connected components of links between longs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import settle

# Links that one task reduces to a forest at a time.
BUFFER = 1 << 20


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node with the least node of its component; connects what the links connect."""
    if not len(a):
        return a, b
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index[: len(a)], index[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new, hop := new[new]):
            new = hop
        if np.array_equal(new, root):
            break
        root = new
    other = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[other]], nodes[other]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b, held = [], [], 0

    def reduce():
        x, y = forest(np.concatenate(a), np.concatenate(b))
        return x, y

    for batch in batches:
        a.append(batch.column("a").to_numpy())
        b.append(batch.column("b").to_numpy())
        held += batch.num_rows
        if held >= BUFFER:
            x, y = reduce()
            if len(x) > BUFFER // 2:  # already a forest: pass it on
                yield pa.RecordBatch.from_pydict({"a": pa.array(x), "b": pa.array(y)})
                x, y = x[:0], y[:0]
            a, b, held = [x], [y], len(x)
    if held:
        x, y = reduce()
        yield pa.RecordBatch.from_pydict({"a": pa.array(x), "b": pa.array(y)})


def components(edges: DataFrame) -> DataFrame:
    """`node` and `component`, its least reachable node, for every node with a link.

    Alternates two steps until nothing changes: each node's larger neighbours link to its least neighbour,
    then its smaller ones do. Each round is written, and what a task holds is reduced to a forest first.
    """
    pairs = settle(edges.mapInArrow(_forests, "a long, b long").distinct(), "links")
    before = None
    while True:
        both = pairs.union(pairs.select("b", "a")).toDF("a", "b")
        least = settle(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "least-neighbours")
        large = both.where("b > a").join(least, "a").select(F.col("low").alias("a"), "b").where("a <> b").distinct()
        large = settle(large, "large-star")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = settle(down.groupBy("a").agg(F.min("b").alias("low")), "least-neighbours")
        small = down.join(least, "a").select(F.col("low").alias("a"), "b").union(least.select(F.col("low"), F.col("a")))
        pairs = settle(small.where("a <> b").distinct(), "small-star")
        now = pairs.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return pairs.select(F.col("b").alias("node"), F.col("a").alias("component"))
        before = now
