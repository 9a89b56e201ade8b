"""Connected components of a graph given by its links, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.skew import attach
from starmart.scratch import Scratch

#: Links up to this number are joined in one task, 16 bytes each; more are joined by rounds of shuffles.
FOREST_LINKS = 50_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node it reaches) that join the same nodes as the links a-b do."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        # A root takes the least label that any link of its tree offers it.
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    tied = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[tied], nodes[label[tied]]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: every linked node and the smallest node it can reach.

    Nodes may be of any type that can be ordered, structs too.  Each round hangs larger
    neighbours, then smaller ones, on the smallest neighbour seen; the links shrink to one star
    per component in a logarithmic number of rounds.  A node's neighbours are reduced to their
    minimum before they are shuffled, the centre of a large star meets its links by broadcast
    (``attach``), and every round is written once, so lost executors cost no more than a reread.
    Up to ``FOREST_LINKS`` links between numbers need no rounds: one task joins them.
    """
    with Scratch(links.sparkSession) as scratch:
        edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v")
        edges = scratch.table(edges, "links")
        n, mark = _summary(edges)
        if n <= FOREST_LINKS and dict(edges.dtypes) == {"u": "bigint", "v": "bigint"}:
            return scratch.result(edges.coalesce(1).mapInArrow(_joined, "node long, root long"), "components")
        while True:
            both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
            least = scratch.table(least, "least")
            larger = attach(both, least, "u", "n", 2 * n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            larger = scratch.table(larger.where("u > v").distinct(), "large-star")
            scratch.drop(edges, least)
            least = scratch.table(larger.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
            n_larger = larger.count()
            smaller = attach(larger, least, "u", "n", n_larger).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            edges = scratch.table(smaller.where("u > v").distinct(), "small-star")
            scratch.drop(larger, least)
            before, (n, mark) = mark, _summary(edges)
            if mark == before:
                out = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                    edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
                )
                return scratch.result(out, "components")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node of all the links and the least that it reaches; for as many links as a task can hold."""
    held = [tuple(batch.column(i).to_numpy() for i in (0, 1)) for batch in batches]
    if held:
        node, root = forest(*(np.concatenate(x) for x in zip(*held, strict=True)))
        roots = np.unique(root)
        columns = [np.concatenate([node, roots]), np.concatenate([root, roots])]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["node", "root"])


def _summary(edges: DataFrame) -> tuple[int, tuple]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], tuple(row)
