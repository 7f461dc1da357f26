"""Near copies among embeddings by counting collisions of one-dimensional projections.

Unit vectors are projected on many random lines. Two vectors within an angle differ on each line by
a normal number whose spread is their distance, so near vectors fall into each other's windows on
most lines and far ones on few. On two lines near vectors must collide in a wide window: the
windows' width cuts the plane into cells, and a vector meets those of its own cell and the cells
around. There the other lines are sorted, the collisions of each pair in windows around the query
are counted, and pairs whose count passes are verified by their cosine. The least count is the
largest one at which a pair just at the threshold is found with the recall asked for.
"""

from math import acos, comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components, roots_of
from .shelf import Shelf
from .vectors import matrix, takes_part, usable

LINES = 16
#: Half widths of the windows, in spreads of a pair at the threshold.
CELL_SPREADS, WINDOW_SPREADS = 3.0, 1.5
RECALL = 0.995
#: Vectors of a cell, on either side, in one task.
TASK_ROWS = 2_000


def least_collisions(lines: int = LINES, spreads: float = WINDOW_SPREADS, recall: float = RECALL) -> int:
    """The largest count that a pair at the threshold reaches with the recall asked for."""
    p = erf(spreads / sqrt(2))
    reached = 0.0
    for count in range(lines, -1, -1):
        reached += comb(lines, count) * p**count * (1 - p) ** (lines - count)
        if reached >= recall:
            return count
    return 0


def directions(d: int, lines: int, seed: int = 17) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(d, lines))


def _cells(spread):
    """Roles of each vector: `a` in its own cell, `b` there and in four of the eight cells around,
    so that each two cells meet once."""
    def cells(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            lengths = np.diff(batch.column(2).offsets.to_numpy()) if batch.num_rows else np.zeros(0, np.int64)
            for d in np.unique(lengths).tolist():
                own = table.filter(pa.array(lengths == d))
                x = matrix(own["vector"])
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                at = np.floor(unit @ directions(d, LINES + 2)[:, :2] / (CELL_SPREADS * spread)).astype(np.int64)
                for role, dx, dy in (("a", 0, 0), ("b", 0, 0), ("b", 0, 1), ("b", 1, -1), ("b", 1, 0), ("b", 1, 1)):
                    yield pa.record_batch([
                        *(c.combine_chunks() for c in own.columns), pa.array(np.full(len(x), d)),
                        pa.array(at[:, 0] - dx), pa.array(at[:, 1] - dy), pa.array([role] * len(x)),
                        pa.array(np.full(len(x), not dx and not dy))],
                        names=["id", "label", "vector", "copies", "d", "cx", "cy", "role", "home"])
    return cells


def collisions(a: np.ndarray, b: np.ndarray, half: float) -> np.ndarray:
    """On how many lines each row of b falls into the window around each row of a."""
    count = np.zeros((len(a), len(b)), np.uint8)
    for line in range(a.shape[1]):
        order = np.argsort(b[:, line], kind="stable")
        values = b[order, line]
        place = np.empty(len(b), np.int32)
        place[order] = np.arange(len(b), dtype=np.int32)
        low = np.searchsorted(values, a[:, line] - half).astype(np.int32)
        high = np.searchsorted(values, a[:, line] + half, "right").astype(np.int32)
        count += (place[None, :] >= low[:, None]) & (place[None, :] < high[:, None])
    return count


def _links(spread, threshold, least):
    """Links of one tile: for each vector the weight of its links here and its root here."""
    def links(rows: pa.Table) -> pa.Table:
        a = rows["role"].to_numpy(zero_copy_only=False) == "a"
        ids, copies, home = (rows[c].to_numpy(zero_copy_only=False) for c in ("id", "copies", "home"))
        empty = np.zeros(0, np.int64)
        left, right = empty, empty
        if a.any() and not a.all():
            x = matrix(rows["vector"])
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            values = x @ directions(x.shape[1], LINES + 2)[:, 2:]
            fa, fb = np.flatnonzero(a), np.flatnonzero(~a)
            passed = collisions(values[fa], values[fb], WINDOW_SPREADS * spread) >= least
            passed &= ~home[fb][None, :] | (ids[fa][:, None] < ids[fb][None, :])
            i, j = np.nonzero(passed)
            i, j = fa[i], fb[j]
            near = [empty.astype(bool)]
            for first in range(0, len(i), 100_000):
                p, q = i[first: first + 100_000], j[first: first + 100_000]
                near.append((x[p] * x[q]).sum(1) >= threshold)
            near = np.concatenate(near)
            left, right = i[near], j[near]
        names, at = np.unique(np.concatenate([ids[left], ids[right]]), return_inverse=True)
        weight = np.bincount(at, np.concatenate([copies[right], copies[left]]), len(names)).astype(np.int64)
        root = roots_of(ids[left], ids[right])[1] if len(left) else empty
        return pa.table({"id": pa.array(names.astype(np.int64)), "links": pa.array(weight), "root": pa.array(root.astype(np.int64))})
    return links


def near_copies(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of `vectors` (vec_id, embedding, label).

    Rows of one label link when the cosine of their vectors is at least `threshold`. n_links counts
    the other rows linked directly, component_id is the smallest vec_id reachable, kept tells if
    it is the row's own. Null labels and vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, nor do vectors of different lengths. Equal vectors of
    one label are one entry with a number of copies, so that copies are not expanded into pairs.
    Null ids link with nothing and are kept. Rows that repeat an id are counted as rows and share
    one component. Other columns are ignored.
    """
    spark = vectors.sparkSession
    shelf = Shelf(spark, "projections")
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    rows = usable(every.filter("vec_id IS NOT NULL AND label IS NOT NULL"))
    key = ["label", "embedding"]
    classes = shelf.keep(rows.groupBy(*key).agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "classes")
    spread = 2 * np.sin(acos(threshold) / 2)  # distance of unit vectors at the threshold
    label_key = F.xxhash64("label")
    placed = shelf.keep(
        classes.select("id", label_key.alias("label"), F.col("embedding").alias("vector"), "copies").mapInArrow(
            _cells(spread), "id long, label long, vector array<double>, copies long, d long, cx long, cy long, role string, home boolean"),
        "placed")
    cell = ["label", "d", "cx", "cy"]
    part = lambda role: F.ceil(F.count(F.when(F.col("role") == role, 1)) / TASK_ROWS)
    parts = placed.groupBy(*cell).agg(part("a").alias("a_parts"), part("b").alias("b_parts")).filter("a_parts > 0 AND b_parts > 0")
    each = lambda n: F.expr(f"sequence(0L, {n} - 1)")
    own = lambda n: F.array(F.pmod(F.xxhash64("id"), F.col(n)))
    is_a = F.col("role") == "a"
    tiles = (
        placed.join(parts, cell)
        .withColumn("a_part", F.explode(F.when(is_a, own("a_parts")).otherwise(each("a_parts"))))
        .withColumn("b_part", F.explode(F.when(is_a, each("b_parts")).otherwise(own("b_parts")))))
    linked = shelf.keep(
        tiles.select(*cell, "a_part", "b_part", "id", "vector", "copies", "role", "home").groupBy(*cell, "a_part", "b_part")
        .applyInArrow(_links(spread, threshold, least_collisions()), "id long, links long, root long"), "linked")
    shelf.drop("placed")
    roots = components(linked.select("id", "root"), shelf, "roots")
    counts = linked.groupBy("id").agg(F.sum("links").alias("links"))
    # A class is known by its least id; with ids repeated under two labels it stands for both.
    known = classes.join(counts, "id", "left").join(roots.withColumnRenamed("vertex", "id"), "id", "left").select(
        *key, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    joined = rows.join(known, key).select("vec_id", "n_links", "component_id")
    alone = every.filter(F.col("vec_id").isNull() | F.col("label").isNull() | ~takes_part(F.col("embedding")))
    out = joined.union(alone.select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.select("vec_id", "n_links", "component_id", F.expr("vec_id <=> component_id").alias("kept"))

