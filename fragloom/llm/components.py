"""Connected components of an undirected graph given as a table of edges."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shelf import Shelf
from .words import giving_back


def roots_of(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vertices of a small graph and the smallest vertex that each one reaches."""
    names, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left):]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all() and (root[a] == root[b]).all():
            return names, names[root]


@giving_back
def _forest(batches):
    """Replace the edges of each batch by a star for each of its components."""
    for batch in batches:
        if batch.num_rows:
            names, root = roots_of(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            moved = names != root
            yield pa.record_batch([pa.array(names[moved]), pa.array(root[moved])], names=["u", "v"])


#: Edges that one task finishes on its own: 16 bytes each, and some 60 for the work.
EDGES_IN_TASK = 2_000_000


@giving_back
def _finished(batches):
    """The star forest of all edges of the task."""
    held = [batch for batch in batches if batch.num_rows]
    if held:
        yield from _forest([pa.Table.from_batches(held).combine_chunks().to_batches()[0]])


def components(edges: DataFrame, shelf: Shelf, name: str = "components") -> DataFrame:
    """(vertex, root) for every vertex of an edge, root being the smallest one it reaches.

    `edges` has two long columns. Each round links every neighbour to the smallest vertex around
    (large star, then small star); rounds grow with the logarithm of the longest path. A vertex
    with very many edges only meets aggregates with partial sums and joins that can be split.
    """
    a, b = edges.columns
    pairs = (
        edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    # Loops keep vertices whose only edge leads to themselves.
    loops = pairs.select(F.col("u").alias("vertex")).union(pairs.select("v"))
    links = shelf.keep(
        pairs.filter("u <> v").mapInArrow(_forest, "u long, v long").distinct(), f"{name}-0")
    before, turn = None, 0
    while True:
        if links.limit(EDGES_IN_TASK + 1).count() <= EDGES_IN_TASK:
            links = shelf.keep(links.coalesce(1).mapInArrow(_finished, "u long, v long"), f"{name}-all")
            break
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        large = (
            both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")) \
            .union(low.select("u", F.col("low").alias("v"))).filter("u <> v").distinct()
        turn += 1
        links = shelf.keep(small, f"{name}-{turn}")
        shelf.drop(f"{name}-{turn - 1}")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    # A fixed point holds one edge from each vertex to the root of its component.
    return loops.distinct().join(links, F.col("vertex") == F.col("u"), "left").select(
        "vertex", F.coalesce("v", "vertex").alias("root"))
