"""Connected components of links, without collecting them anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clustertrace.llm.shared import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of some links that isn't the smallest of its component, and that smallest node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        if np.array_equal(before, label):
            break
    inner = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[inner], nodes[label[inner]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition replaced by as few as connect the same nodes."""
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        new = [batch.column(k).to_numpy() for k in (0, 1)]
        a, b = forest(np.concatenate([a, new[0]]), np.concatenate([b, new[1]]))
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def components(links: DataFrame, one_task: int = 500_000) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``links`` (two columns of bigint).

    Every partition first reduces its links to a forest. Then two steps alternate until nothing
    changes: each node links its larger neighbours to its smallest one, and each node links its
    smaller neighbours and itself to the smallest of them. Only minima are grouped, with a map-side
    part, and they are joined back by shuffles that Spark splits where a node is hot. The links of
    every round are written to the shared folder; their number never grows. As soon as at most
    ``one_task`` links are left, one task reduces them. A link of a node with itself gives the node
    a component of its own; links with a NULL end are void.
    """
    pairs = links.toDF("a", "b").select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).dropna()
    start = stored(pairs, "links")
    nodes = start.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    current = start.filter("a <> b")
    if start.count() > one_task:
        current = stored(current.mapInArrow(_local, "a bigint, b bigint"), "links")

    def mark(frame: DataFrame) -> tuple:
        """A fingerprint of a set of links."""
        return tuple(frame.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("bigint"))).first())

    before = None
    while (now := mark(current)) != before and now[0]:
        if now[0] <= one_task:
            current = stored(current.coalesce(1).mapInArrow(_local, "a bigint, b bigint"), "links")
            break
        before = now
        # Larger neighbours go to the smallest neighbour.
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), "links")
        # Smaller neighbours and the node itself go to the smallest of them; here a > b already.
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        current = stored(small, "links")
    root = current.groupBy("a").agg(F.min("b").alias("m"))
    return nodes.join(root, nodes["node"] == root["a"], "left").select(
        "node", F.coalesce("m", "node").alias("component")
    )
