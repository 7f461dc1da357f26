"""Approximate nearest neighbours with a forest of random-projection trees.

The trees are fitted on a bounded sample: each node splits its part of the sample at the median of
the projection on the line through two of its points. Every vector is put into one leaf of every
tree. A query goes down all trees at once with one shared priority queue: the node, of whatever
tree, whose nearest splitting plane on the way is least behind comes first, until the leaves seen
hold enough vectors. The vectors of these leaves are ranked by exact distance.

How many vectors are enough is found on the sample, where the recall of the same search is held
against brute force.
"""

import functools
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fragloom.operators.joins import top_rows_per_group

from .shelf import Shelf
from .vectors import matrix, usable

#: Vectors the trees are fitted and calibrated on, at most.
SAMPLE_ROWS = 20_000
CALIBRATION_QUERIES = 100
TREES = 8
#: Vectors per leaf that the depth of the trees aims at, and of the sample at least.
LEAF_ROWS, LEAF_SAMPLE = 512, 16
TARGET_RECALL = 0.96
#: Vectors that a search sees at least.
LEAST_SEEN = 2_000
#: Rows and queries of one leaf in one task.
TASK_ROWS, TASK_QUERIES = 20_000, 5_000


class Forest:
    """Complete binary trees of one depth: planes by node, in the order of a heap."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int = TREES, seed: int = 11):
        random = np.random.default_rng(seed)
        self.depth, self.trees = depth, trees
        nodes, d = 2**depth - 1, sample.shape[1]
        self.normal, self.offset = np.zeros((trees, nodes, d)), np.zeros((trees, nodes))
        for t in range(trees):
            node = np.zeros(len(sample), np.int64)
            for level in range(depth):
                order = np.argsort(node, kind="stable")
                first = 2**level - 1
                cuts = np.searchsorted(node[order], np.arange(first, first + 2**level + 1))
                for k in range(2**level):
                    part = sample[order[cuts[k]: cuts[k + 1]]]
                    line = random.normal(size=d)
                    if len(part) > 1:
                        a, b = part[random.choice(len(part), 2, replace=False)]
                        line = a - b if (a != b).any() else line
                    line /= np.linalg.norm(line)
                    self.normal[t, first + k] = line
                    self.offset[t, first + k] = np.median(part @ line) if len(part) else 0.0
                node = self._down(t, node, sample)

    def _down(self, tree, node, x):
        right = (x * self.normal[tree, node]).sum(1) > self.offset[tree, node]
        return 2 * node + 1 + right

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every vector in every tree."""
        out = np.zeros((len(x), self.trees), np.int64)
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = self._down(t, node, x)
            out[:, t] = node - (2**self.depth - 1)
        return out

    def search(self, query: np.ndarray):
        """Yields (tree, leaf), nearest first, from one queue over all trees."""
        inner = 2**self.depth - 1
        margins = self.normal @ query - self.offset
        queue = [(-np.inf, t, 0) for t in range(self.trees)]
        while queue:
            behind, t, node = heapq.heappop(queue)
            if node >= inner:
                yield t, node - inner
                continue
            m = margins[t, node]
            heapq.heappush(queue, (max(behind, m), t, 2 * node + 1))
            heapq.heappush(queue, (max(behind, -m), t, 2 * node + 2))


def calibrated_share(forest: Forest, sample: np.ndarray, k: int, target: float = TARGET_RECALL) -> float:
    """Rows of all leaves seen, as a multiple of the rows, at which the sample reaches the recall."""
    random = np.random.default_rng(5)
    queries = random.permutation(len(sample))[:CALIBRATION_QUERIES]
    leaves = forest.leaves(sample)
    members = [[np.flatnonzero(leaves[:, t] == leaf) for leaf in range(2**forest.depth)] for t in range(forest.trees)]
    shares = np.linspace(0, forest.trees, 40 * forest.trees + 1)[1:]
    recall = np.zeros(len(shares))
    for q in queries:
        distance = ((sample - sample[q]) ** 2).sum(1)
        distance[q] = np.inf
        true = np.argpartition(distance, min(k, len(sample) - 1) - 1)[:k]
        # The number of rows seen when each true neighbour is found for the first time.
        seen, found = 0, dict.fromkeys(true.tolist(), np.inf)
        for t, leaf in forest.search(sample[q]):
            seen += len(members[t][leaf])
            for i in np.intersect1d(members[t][leaf], true, assume_unique=True).tolist():
                found[i] = min(found[i], seen)
        recall += (np.array(list(found.values()))[None, :] <= shares[:, None] * len(sample)).mean(1)
    enough = np.flatnonzero(recall >= target * len(queries))
    return float(shares[enough[0]]) if len(enough) else float(forest.trees)


def _index(forest):
    def index(batches):
        for batch in batches:
            x = matrix(batch.column(1))
            if not len(x):
                continue
            leaf = forest.value.leaves(x)
            for t in range(leaf.shape[1]):
                yield pa.record_batch(
                    [*batch.columns, pa.array(np.full(len(x), t)), pa.array(leaf[:, t])], names=["id", "vector", "tree", "leaf"])
    return index


def _probe(forest, sizes, enough):
    def probe(batches):
        held = sizes.value
        for batch in batches:
            at, trees, leaves = [], [], []
            x = matrix(batch.column(1))
            for i in range(len(x)):
                seen = 0
                for t, leaf in forest.value.search(x[i]):
                    size = held.get((t, leaf), 0)
                    if size:
                        at.append(i), trees.append(t), leaves.append(leaf)
                    seen += size
                    if seen >= enough:
                        break
            rows = batch.take(pa.array(at, pa.int64()))
            yield pa.record_batch(
                [*rows.columns, pa.array(trees, pa.int64()), pa.array(leaves, pa.int64())], names=["query", "vector", "tree", "leaf"])
    return probe


def _rank(k):
    def rank(rows: pa.Table, queries: pa.Table) -> pa.Table:
        x, q = matrix(rows["vector"]), matrix(queries["vector"])
        ids, names = rows["id"].to_numpy(), queries["query"].to_numpy()
        out = [[], [], []]
        for i in range(len(q) if len(x) else 0):
            distance = np.sqrt(((x - q[i]) ** 2).sum(1))
            most = min(k, len(x))
            limit = np.partition(distance, most - 1)[most - 1]
            near = np.flatnonzero(distance <= limit)
            near = near[np.lexsort((ids[near], distance[near]))][:most]
            for held, values in zip(out, (np.full(most, names[i]), ids[near], distance[near])):
                held.append(values)
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({
            n: pa.array(np.concatenate([*v, np.zeros(0)]).astype(kind.to_pandas_dtype()), kind)
            for n, v, kind in zip(("query", "id", "score"), out, kinds)})
    return rank


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows found for each row whose vec_id is
    divisible by `every`, by Euclidean distance in double precision, ties to the smaller vec_id.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
    null ids. Vectors are searched among those of their own length, one length after the other.
    Equal vectors are searched once and share one entry, of which the k + 1 smallest ids are kept:
    more can never be among the k nearest. Rows that repeat an id count once, with the least of
    their vectors. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = usable(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter("vec_id IS NOT NULL"))
    if not rows.groupBy("vec_id").count().filter("count > 1").isEmpty():
        rows = rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    lengths = sorted(r[0] for r in rows.select(F.size("embedding")).distinct().collect())
    found = [_nearest_of_length(rows.filter(F.size("embedding") == d), every, k) for d in lengths]
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return functools.reduce(DataFrame.union, found) if found else empty


def _nearest_of_length(rows: DataFrame, every: int, k: int) -> DataFrame:
    """`nearest` among vectors of one length with distinct ids."""
    spark = rows.sparkSession
    shelf = Shelf(spark, "forest")
    few = top_rows_per_group(rows, ["embedding"], ["vec_id"], k + 1)
    classes = shelf.keep(
        few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.element_at("ids", 1).alias("id"), F.col("embedding").alias("vector"), "ids"), "classes")
    queries = shelf.keep(
        rows.filter(F.col("vec_id") % every == 0).select("vec_id", "embedding").distinct()
        .join(classes.select("id", F.col("vector").alias("embedding")), "embedding").select("vec_id", "id"), "queries")

    n = classes.count()
    sample = matrix(classes.select("vector").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).toArrow()["vector"])
    depth = max(0, int(np.log2(max(1, min(n / LEAF_ROWS, len(sample) / LEAF_SAMPLE)))))
    fitted = Forest(sample, depth)
    enough = max(LEAST_SEEN * TREES, calibrated_share(fitted, sample, k) * n)
    forest = spark.sparkContext.broadcast(fitted)
    index = shelf.keep(
        classes.select("id", "vector").mapInArrow(_index(forest), "id long, vector array<double>, tree long, leaf long"), "index")
    # One count for each leaf of the forest: a number that the sample bounds.
    sizes = {(r["tree"], r["leaf"]): r["count"] for r in index.groupBy("tree", "leaf").count().toLocalIterator()}
    wanted = classes.join(queries.select("id").distinct(), "id", "left_semi").select(F.col("id").alias("query"), "vector")
    probes = shelf.keep(
        wanted.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "query").mapInArrow(
            _probe(forest, spark.sparkContext.broadcast(sizes), enough), "query long, vector array<double>, tree long, leaf long"),
        "probes")
    # Large leaves are cut into parts of rows, and their queries into parts as well.
    parts = index.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / TASK_ROWS).alias("row_parts")).join(
        probes.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / TASK_QUERIES).alias("query_parts")), ["tree", "leaf"])
    parts = shelf.keep(parts, "parts")
    cell = ["tree", "leaf", "row_part", "query_part"]
    each = lambda n: F.explode(F.expr(f"sequence(0L, {n} - 1)"))
    members = index.join(parts, ["tree", "leaf"]).withColumn(
        "row_part", F.pmod(F.xxhash64("id"), F.col("row_parts"))).withColumn("query_part", each("query_parts"))
    asked = probes.join(parts, ["tree", "leaf"]).withColumn(
        "query_part", F.pmod(F.xxhash64("query"), F.col("query_parts"))).withColumn("row_part", each("row_parts"))
    found = members.select(*cell, "id", "vector").groupBy(*cell).cogroup(
        asked.select(*cell, "query", "vector").groupBy(*cell)).applyInArrow(_rank(k + 1), "query long, id long, score double")
    near = shelf.keep(
        top_rows_per_group(found.groupBy("query", "id").agg(F.min("score").alias("score")), ["query"], ["score", "id"], k + 1), "near")
    shelf.drop("index", "probes")
    listed = near.join(classes.select("id", "ids"), "id").select(F.col("query").alias("id"), "score", F.explode("ids").alias("found"))
    best = listed.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("score", "found"))).filter(F.col("n") <= k + 1)
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        queries.withColumnRenamed("vec_id", "query_id").join(best, "id")
        .select("query_id", F.col("found").alias("vec_id"), "score").filter("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score"))
