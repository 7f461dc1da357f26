"""Importance resampling of documents towards the word statistics of a target corpus.

Every feature (a run of words) falls into a bucket by the CRC of its bytes. The gain of a bucket
is the logarithm of its share in the target over its share in the corpus; a document weighs the
mean gain of its features, and the highest weights plus Gumbel noise are drawn, which is a draw
without replacement by importance.

Texts are taken apart by Arrow's own kernels: ascii_lower, split_pattern_regex, list_flatten and
dictionary_encode. Runs of several words are pairs of shifted dictionary indices; a CRC is
computed once for each distinct run of a batch, and gains are taken by bucket and summed by
document. Counts and gains have one entry for each bucket; nothing else leaves the tasks whole.
"""

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from fragloom.operators.ranking import running_totals

from .shelf import Shelf
from .words import released, small_batches

BUCKETS = 10_000
#: Bytes that part words: ASCII other than digits and small letters (texts are lower-cased first).
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of one text that are taken apart at once, where features are single words.
SEGMENT = 1 << 20
SETTING = {"longest": 1, "buckets": BUCKETS}


def _segments(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts over `SEGMENT` bytes, cut at spaces, and the number of the text of each piece."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    if not len(size) or size.max() <= SEGMENT:
        return texts, np.arange(len(texts))
    cut, owner = [], []
    for i, text in enumerate(texts.to_pylist()):
        first = 0
        while text and len(text) - first > SEGMENT:
            last = text.rfind(" ", first, first + SEGMENT)
            last = last + 1 if last > first else first + SEGMENT  # below: a word of such a length
            while last < len(text) and not text[last - 1].isspace():
                last += 1
            cut.append(text[first:last])
            owner.append(i)
            first = last
        cut.append(text[first:] if text else text)
        owner.append(i)
    return pa.array(cut, texts.type), np.array(owner)


def word_indices(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the word number of every word, and the row of `texts` it stands in."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=GAPS)
    words, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(words), 0)  # gaps at the ends of a text leave empty strings
    coded = pc.dictionary_encode(words.filter(full))
    return (coded.dictionary.cast(pa.binary()).to_pylist(),
            coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
            row.filter(full).to_numpy(zero_copy_only=False).astype(np.int64))


def feature_buckets(texts: pa.Array, longest: int, buckets: int):
    """The bucket of every feature and its text, and the words of each text.

    Features of one length after the other; inside a length in the order of the texts.
    """
    parts, owner = _segments(texts) if longest == 1 else (texts, np.arange(len(texts)))
    words, index, row = word_indices(parts)
    row = owner[row]
    crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    grams, of, hashes = index, row, crc  # number of the run that starts at each place, and its CRC
    found, texts_of = [(hashes % buckets).astype(np.int64)[grams]], [of]
    for length in range(2, longest + 1):
        inside = row[length - 1:] == row[: len(row) - length + 1]
        pair = (grams[: len(inside)] * len(words) + index[length - 1:])[inside]
        distinct, numbers = np.unique(pair, return_inverse=True)
        head, tail = np.divmod(distinct, max(len(words), 1))
        hashes = np.fromiter(
            (zlib.crc32(words[t], zlib.crc32(b" ", int(hashes[h]))) for h, t in zip(head.tolist(), tail.tolist())),
            np.uint32, len(distinct))
        found.append((hashes % buckets).astype(np.int64)[numbers])
        texts_of.append(row[: len(inside)][inside])
        # Places where no run of this length starts keep a number that no longer run can use.
        grams = np.zeros(len(inside), np.int64)
        grams[inside] = numbers
    return np.concatenate(found), np.concatenate(texts_of), np.bincount(row, minlength=len(texts))


def _counter(longest, buckets):
    def count(batches):
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            held += np.bincount(feature_buckets(batch.column(0), longest, buckets)[0], minlength=buckets)
        used = np.flatnonzero(held)
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array(held[used])], names=["bucket", "n"])
        released()
    return count


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows of `texts` in each bucket."""
    small_batches(texts.sparkSession)
    rows = texts.select("text").mapInArrow(_counter(longest, buckets), "bucket int, n long")
    table = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) for each of the B buckets."""
    buckets, all_corpus, all_target = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * (all_corpus + buckets) / ((s + 1.0) * (all_target + buckets))))
        for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _weigh(shared, longest, buckets):
    def weigh(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            bucket, of, words = feature_buckets(texts, longest, buckets)
            taken = shared.value[bucket]
            if longest > 1:
                order = np.argsort(of, kind="stable")
                taken, of = taken[order], of[order]
            n = np.bincount(of, minlength=len(texts))
            sums = np.append(0, np.cumsum(taken))
            ends = np.cumsum(n)
            weight = (sums[ends] - sums[ends - n]) // np.maximum(n, 1)
            yield pa.record_batch(
                [*batch.columns, pa.array(words), pa.array(n), pa.array(weight)],
                names=[*batch.schema.names, "n_words", "n_features", "weight"])
        released()
    return weigh


def _noise(seed: int):
    """floor(-1000 ln(-ln(u))), u from the first 32 bits of sha256(seed:doc_id); null without an id."""
    key = F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string"))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def _scored(docs, target, columns, longest, buckets, seed):
    """`columns` of docs (doc_id among them), n_words, n_features, weight, score."""
    spark = docs.sparkSession
    gain = spark.sparkContext.broadcast(
        gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets)))
    rows = docs.select(*columns, "text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(
        _weigh(gain, longest, buckets), f"{kinds}, n_words long, n_features long, weight long",
    ).withColumn("score", F.col("weight") + _noise(seed))


def importance_scores(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20,
                      longest: int = 1, buckets: int = BUCKETS, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score, rank (all long) of every row of `docs`.

    Of the N rows with at least `least_words` words, the floor(percent N / 100) with the highest
    score get a rank, 1 first, ties to the smaller doc_id; the others get null. A null, empty or
    wordless text has no features and weight 0. A row without doc_id has no noise: its score is
    null, it is not drawn and not counted in N. Repeated rows count each; rows that agree in id and
    score take neighbouring ranks. Empty tables give no rows, or gains without a target. Other
    columns are not read. Single words are taken from texts of any length by the megabyte; with
    `longest` over 1 a text is taken apart whole, at some 20 bytes of memory for each of its own.

    Ranks need no ordering of all rows: equal rows are counted first, then scores. Scores are whole
    numbers between the smallest and the largest gain plus noise (some 100,000 values at any size),
    and noise spreads the ids of any one weight, so that no score holds more than 1 / 2,700 of them.
    """
    spark = docs.sparkSession
    shelf = Shelf(spark, "resampling")
    scored = shelf.keep(
        _scored(docs, target, [F.col("doc_id").cast("long").alias("doc_id")], longest, buckets, seed).drop("text"), "scored")
    chosen = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    most = scored.filter(chosen).count() * percent // 100
    equal = scored.filter(chosen).groupBy("doc_id", "n_features", "weight", "score").agg(F.count(F.lit(1)).alias("n"))
    equal = equal.withColumn("level", -F.col("score"))
    levels = scored.filter(chosen).groupBy((-F.col("score")).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    before = running_totals(levels, "level", ["n"], parts=16).select("level", "n_before")
    inside = Window.partitionBy("level").orderBy("doc_id", "n_features", "weight").rowsBetween(Window.unboundedPreceding, -1)
    placed = equal.join(before, "level").withColumn("first", F.col("n_before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    copies = F.explode(F.sequence(F.col("first") + 1, F.col("first") + F.col("n")))
    ranked = placed.select("doc_id", "n_features", "weight", "score", copies.alias("rank"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    rest = scored.filter(~F.coalesce(chosen, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest.select(*ranked.columns))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20,
              longest: int = 1, buckets: int = BUCKETS, seed: int = 2024) -> DataFrame:
    """The drawn rows of `docs` with all their columns.

    Those of `importance_scores`; where rows agree in id and score with the last one drawn, all of
    them are. Texts are weighed again instead of being shuffled with their ranks.
    """
    ranked = importance_scores(docs, target, percent, least_words, longest, buckets, seed)
    last = ranked.agg(F.max_by(F.struct("score", "doc_id"), "rank").alias("last")).first()["last"]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    scored = _scored(docs, target, [F.col("doc_id").cast("long").alias("doc_id"), row], longest, buckets, seed)
    if last is None:
        drawn = scored.filter(F.lit(False))
    else:
        drawn = scored.filter(
            (F.col("n_words") >= least_words)
            & ((F.col("score") > last["score"]) | (F.col("score") == last["score"]) & (F.col("doc_id") <= last["doc_id"])))
    return drawn.select("_row.*")
