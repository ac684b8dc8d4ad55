"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import written


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it reaches) over these edges, for every node but those smallest ones."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = np.minimum(new[new], new[label])
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


#: A graph of up to this many edges (16 bytes each) is finished by one task; larger ones by rounds of stars.
ONE_TASK = 1_000_000


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One edge for each node of the partition, connecting what its edges connect."""
    node, root = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        u, v = batch.column("u").to_numpy(), batch.column("v").to_numpy()
        node, root = forest(np.concatenate([node, u]), np.concatenate([root, v]))
    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of ``edges`` (u, v) with the smallest node it is connected to.

    Partitions first drop edges they can do without.  Then each round of stars halves what is left
    of long paths; a round's edges are written to the shared folder.  No edges give no rows; null ends are left out.
    """
    edges = (
        edges.where("u is not null and v is not null and u != v")
        .select(F.greatest("u", "v").cast("bigint").alias("u"), F.least("u", "v").cast("bigint").alias("v"))
        .mapInArrow(_contracted, "u long, v long")
    )
    edges = written(edges, "edges")
    if edges.count() <= ONE_TASK:
        edges = written(edges.coalesce(1).mapInArrow(_contracted, "u long, v long"), "edges")
    else:
        edges = _stars(edges)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def _stars(edges: DataFrame) -> DataFrame:
    """Edges from every node to the smallest it reaches."""
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
        # large star: neighbours above u move to the smallest neighbour of u, or u
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(lowest, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # small star: u and its smaller neighbours move to the smallest of them
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u != v")
            .distinct()
        )
        edges = written(small, "edges")
    return edges
