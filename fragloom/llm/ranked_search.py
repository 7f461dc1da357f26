"""Ranked lexical search with posting lists in geometric blocks.

The documents of a shard are held as sparse vectors of term impacts over the terms of the queries.
Each term has a posting list, which is clustered by the similarity of its documents and cut into
blocks. A block stores a summary: for every coordinate the largest impact among its documents. The
summary times the query's weights bounds the score of each document of the block from above, so a
block is skipped only when that bound is below the score that the k best so far ask for; all
others are scored exactly. The best of all shards are merged.

Scores need the number of documents, their terms and the document frequency of query terms over
the whole corpus; these are counted first, while texts are turned into vectors. Queries come in
blocks with a bounded number of distinct terms, so that what is sent to tasks is bounded too.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .shelf import Shelf
from .words import gathered, mix, pieces, released, small_batches, utf8, word_hashes, word_spans

#: Distinct terms of one block of queries at most, but for a single query with more.
BLOCK_TERMS = 4_096
#: Documents of a shard, and entries of its table of impacts, at most.
SHARD_ROWS = 8_192
SHARD_CELLS = 1 << 23
#: Documents of a posting block at most.
POSTING_BLOCK = 64
#: Summaries have 16 bits: impacts, which are below 1,000,000, are divided by this and rounded up.
UNIT = 16
#: Numbers that stand for a document where posting lists are clustered.
SKETCH = 16
#: Parameters of the length norm: its share and the factor of the norm, in hundredths.
NORM_SHARE, NORM_FACTOR = 25, 12
#: Bytes that part terms: ASCII other than digits and letters.
GAPS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _terms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms and each text's bounds in them."""
    starts, ends, of = word_spans(data, bounds, GAPS)
    return word_hashes(data, starts, ends), of


def _query_terms(batches):
    """item_id and the hashes of its terms, repeats included."""
    for batch in batches:
        data, bounds = utf8(batch.column(1))
        for first, last in pieces(bounds):
            hashes, of = _terms(data[bounds[first]: bounds[last]], bounds[first: last + 1] - bounds[first])
            lists = pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.record_batch([batch.column(0).slice(first, last - first), lists], names=["item_id", "terms"])


class Queries:
    """A block of queries over their distinct terms, which are numbered in the order of hashes."""

    def __init__(self, items: list, terms: list[np.ndarray]):
        self.items = items
        self.hashes = np.unique(np.concatenate([*terms, np.zeros(0, np.uint64)]))
        self.terms, self.repeats = [], []
        for each in terms:
            distinct, n = np.unique(np.searchsorted(self.hashes, each), return_counts=True)
            self.terms.append(distinct)
            self.repeats.append(n.astype(np.int64))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each term, -1 for those of no query."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        return np.where(self.hashes[at] == hashes, at, -1) if len(self.hashes) else np.full(len(hashes), -1)


def query_blocks(items: DataFrame, most: int = BLOCK_TERMS):
    """Blocks of queries in the order of items, read one by one; the whole set is never held."""
    rows = items.mapInArrow(_query_terms, "item_id long, terms array<long>").orderBy("item_id")
    held, names, n = [], [], 0
    for row in rows.toLocalIterator():
        terms = np.array(row["terms"], np.int64).view(np.uint64)
        size = len(np.unique(terms))
        if held and n + size > most:
            yield Queries(names, held)
            held, names, n = [], [], 0
        held.append(terms)
        names.append(row["item_id"])
        n += size
    if held:
        yield Queries(names, held)


def _vectors(shared):
    """doc_id, number of terms, numbers and frequencies of the query terms of each text with terms."""
    def vectors(batches):
        for batch in batches:
            data, bounds = utf8(batch.column(1))
            for first, last in pieces(bounds):
                hashes, of = _terms(data[bounds[first]: bounds[last]], bounds[first: last + 1] - bounds[first])
                n = np.diff(of)
                doc = np.repeat(np.arange(len(n)), n)
                number = shared.value.numbers(hashes)
                key, tf = np.unique((doc << 32 | number)[number >= 0], return_counts=True)
                kept = np.flatnonzero(n)
                ends = np.searchsorted(key >> 32, np.append(kept, len(n)))
                offsets = pa.array(ends, pa.int32())
                yield pa.record_batch([
                    batch.column(0).slice(first, last - first).take(pa.array(kept)), pa.array(n[kept]),
                    pa.ListArray.from_arrays(offsets, pa.array(key & 0xFFFFFFFF, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int64()))], names=["doc_id", "n", "terms", "tfs"])
        released()
    return vectors


def weights(documents: int, frequency: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)


def _norms(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """100 - 25 + (25 n N div L) of each document."""
    if NORM_SHARE * int(n.max(initial=0)) * documents < 2**63:
        return 100 - NORM_SHARE + NORM_SHARE * n * documents // total
    return np.array([100 - NORM_SHARE + NORM_SHARE * x * documents // total for x in n.tolist()], np.int64)


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All whole numbers from each first up to its last, one range after the other."""
    n = last - first
    return np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)


class Shard:
    """Impacts of a few thousand documents and their posting lists in blocks."""

    def __init__(self, ids, n, of, terms, tfs, documents: int, total: int, size: int, projection: np.ndarray):
        row = np.repeat(np.arange(len(n)), np.diff(of))
        impact = 1_000_000_000 * tfs // (1000 * tfs + NORM_FACTOR * _norms(n, documents, total)[row])
        self.ids, self.size = ids, size
        self.table = np.zeros((len(n), size), np.int32)
        self.table[row, terms] = impact
        sketch = np.zeros((len(ids), projection.shape[1]), np.float32)
        full = np.flatnonzero(np.diff(of))
        if len(full):
            sketch[full] = np.add.reduceat(projection[terms] * impact[:, None].astype(np.float32), of[full], axis=0)
            sketch[full] /= np.maximum(np.linalg.norm(sketch[full], axis=1, keepdims=True), 1e-9)
        self._block(row, terms, sketch)

    def _block(self, row, terms, sketch):
        """Cluster every posting list, cut it, and summarise its blocks."""
        order = np.argsort(terms, kind="stable")
        posted, bounds = row[order], np.searchsorted(terms[order], np.arange(self.size + 1))
        starts, self.block_of = [], np.zeros(self.size + 1, np.int64)
        for term in range(self.size):
            a, b = int(bounds[term]), int(bounds[term + 1])
            if b - a > POSTING_BLOCK:
                docs = posted[a:b]
                near = sketch[docs] @ sketch[docs[:: POSTING_BLOCK]].T
                cluster = near.argmax(axis=1)
                posted[a:b] = docs[np.lexsort((-near[np.arange(b - a), cluster], cluster))]
            starts.extend(range(a, b, POSTING_BLOCK))
            self.block_of[term + 1] = len(starts)
        self.posted, self.starts = posted, np.array([*starts, len(posted)])
        coarse = (-(-self.table // UNIT)).astype(np.uint16)
        self.summary = coarse[posted[self.starts[:-1]]]
        for i in np.flatnonzero(np.diff(self.starts) > 1).tolist():
            np.maximum.reduce(coarse[posted[self.starts[i]: self.starts[i + 1]]], axis=0, out=self.summary[i])

    def search(self, terms, weight, k: int, least: int):
        """Rows that can be among the k best, and their scores; `least` is the score asked for so far.

        Blocks of all lists come in the order of their bounds, a growing number at once; the score
        asked for rises with each turn, and the first bound below it ends the search.
        """
        seen = np.zeros(len(self.ids), bool)
        rows, scores, best = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.zeros(0, np.int64)
        blocks = _ranges(self.block_of[terms], self.block_of[terms + 1])
        bound = self.summary[blocks[:, None], terms].astype(np.int64) @ weight * UNIT
        order = np.argsort(-bound, kind="stable")
        blocks, bound, first, step = blocks[order], bound[order], 0, 16
        while first < len(blocks):
            last = min(first + step, int(np.searchsorted(-bound, -max(least, 1), "right")))
            if last <= first:
                break
            found = np.unique(self.posted[_ranges(self.starts[blocks[first:last]], self.starts[blocks[first:last] + 1])])
            found = found[~seen[found]]
            seen[found] = True
            score = self.table[found[:, None], terms].astype(np.int64) @ weight
            rows.append(found)
            scores.append(score)
            best = np.concatenate([best, score])
            if len(best) >= k:
                best = np.partition(best, len(best) - k)[len(best) - k:]
                least = max(least, int(best.min()))
            first, step = last, 2 * step
        rows, scores = np.concatenate(rows), np.concatenate(scores)
        keep = scores >= max(least, 1)
        return rows[keep], scores[keep]


FOUND = ["query", "item_id", "doc_id", "score"]


class _Best:
    """The k best documents of every query among the shards of one task."""

    def __init__(self, queries: Queries, weight: np.ndarray, k: int):
        self.k, n = k, len(queries.items)
        self.terms = queries.terms
        self.weights = [weight[t] * r for t, r in zip(queries.terms, queries.repeats)]
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in range(n)]

    def add(self, shard: Shard, missing: np.ndarray):
        for i, (score, doc, null) in enumerate(self.found):
            least = int(score[-1]) if len(score) >= self.k else 1
            rows, more = shard.search(self.terms[i], self.weights[i], self.k, least)
            if len(rows):
                score, doc = np.append(score, more), np.append(doc, shard.ids[rows])
                null = np.append(null, missing[rows])
                best = np.lexsort((doc, null, -score))[: self.k]
                self.found[i] = score[best], doc[best], null[best]


def _search(shared, k):
    def search(batches):
        queries, weight, documents, total = shared.value
        size = len(queries.hashes)
        rows = max(1, min(SHARD_ROWS, SHARD_CELLS // max(size, 1)))
        spread = np.arange(1, size * SKETCH + 1, dtype=np.uint64).reshape(size, SKETCH)
        projection = np.where(mix(spread) & np.uint64(1), np.float32(1), np.float32(-1)).astype(np.float32)
        best = _Best(queries, weight, k)
        for whole in gathered(batches, rows):
            for first in range(0, whole.num_rows, rows):
                part = whole.slice(first, rows).combine_chunks()
                lists = [part[name].combine_chunks() for name in ("terms", "tfs")]
                terms, tfs = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
                of = np.append(0, np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False)))
                ids, missing = part["doc_id"].fill_null(0).to_numpy(), part["doc_id"].is_null().to_numpy()
                best.add(Shard(ids, part["n"].to_numpy(), of, terms, tfs, documents, total, size, projection), missing)
        n = [len(score) for score, _, _ in best.found]
        score, doc, null = (np.concatenate(x) for x in zip(*best.found))
        yield pa.record_batch([
            pa.array(np.repeat(np.arange(len(n)), n), pa.int32()), pa.array(queries.items, pa.int64()).take(
                pa.array(np.repeat(np.arange(len(n)), n))), pa.array(doc, mask=null), pa.array(score)], names=FOUND)
        released()
    return search


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the `k` best rows of `docs` for every row of `items`.

    Only scores above 0 count; equal scores are ordered by doc_id, null last. Null, empty and
    wordless texts are no documents: they do not count in the statistics. Rows that repeat an id
    are documents of their own. Items without terms, or whose terms occur nowhere, have no rows; rows
    that repeat an item_id (or have none) are queries of their own, each with its ranks from 1. Texts of any
    length are read whole; empty tables give no rows. Terms are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shelf = Shelf(spark, "search")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    found = spark.createDataFrame([], "query int, item_id long, doc_id long, score long, block int")
    for number, queries in enumerate(query_blocks(items)):
        shared = spark.sparkContext.broadcast(queries)
        vectors = shelf.keep(docs.mapInArrow(_vectors(shared), "doc_id long, n long, terms array<int>, tfs array<long>"), f"vectors-{number}")
        documents, total = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        counted = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
        frequency = np.zeros(len(queries.hashes), np.int64)
        frequency[counted["term"].to_numpy()] = counted["count"].to_numpy()
        state = spark.sparkContext.broadcast((queries, weights(documents, frequency), documents, total))
        part = vectors.mapInArrow(_search(state, k), "query int, item_id long, doc_id long, score long")
        found = found.unionByName(part.withColumn("block", F.lit(number)))
    best = shelf.keep(found, "found")
    order = Window.partitionBy("block", "query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
