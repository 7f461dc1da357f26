"""Token counts by the whole-token shortcut.

Before any text is read, every string of the vocabulary is encoded alone; those that come out as
one token are proved whole. A pre-token that equals such a string counts one without any merge;
only the rest is merged. Strings of up to 16 bytes are compared as two 8-byte numbers and a
length, longer ones as bytes, so that a match is never a matter of hashes.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bpe import Cache, Vocabulary
from .pretokens import pre_tokens
from .words import pieces, released, small_batches, utf8

_MASK = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1] * 9, np.uint64)


def _halves(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """The first 16 bytes of each word as two numbers; bytes behind its end count as 0."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    wide = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    low, high = wide[starts], wide[starts + 8]
    return low & _MASK[np.minimum(lengths, 8)], high & _MASK[np.clip(lengths - 8, 0, 8)]


class WholeTokens:
    """The strings of a vocabulary that are encoded as one token when they stand alone."""

    def __init__(self, vocabulary: Vocabulary):
        strings = [p for i, p in enumerate(vocabulary.pieces) if p and p not in vocabulary.specials]
        _, bounds = vocabulary.encode(strings)
        self.proved = [s for s, n in zip(strings, np.diff(bounds)) if n == 1]
        short = [s for s in self.proved if len(s) <= 16]
        self.long = {s for s in self.proved if len(s) > 16}
        lengths = np.array([len(s) for s in short], np.int64)
        starts = np.cumsum(lengths) - lengths
        low, high = _halves(np.frombuffer(b"".join(short), np.uint8), starts, lengths)
        self.bits = int(len(short) * 8).bit_length()
        self.low = np.zeros((1 << self.bits) + 64, np.uint64)
        self.high, self.size = np.zeros_like(self.low), np.zeros(len(self.low), np.int64)
        for slot, a, b, n in zip(self._slot(low, high, lengths).tolist(), low, high, lengths):
            while self.size[slot]:
                slot += 1
            self.low[slot], self.high[slot], self.size[slot] = a, b, n
        if self.size[-1]:
            raise ValueError("the table of whole tokens is too full")

    def _slot(self, low, high, lengths):
        h = (low ^ (high * np.uint64(0xC2B2AE3D27D4EB4F))) + lengths.astype(np.uint64)
        h ^= h >> np.uint64(29)
        return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def match(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Whether each word of up to 16 bytes is a whole token."""
        low, high = _halves(data, starts, lengths)
        slot = self._slot(low, high, lengths)
        found = np.zeros(len(starts), bool)
        open_ = np.arange(len(starts))
        while len(open_):
            s = slot[open_]
            hit = (self.size[s] > 0) & (self.low[s] == low[open_]) & (self.high[s] == high[open_]) & (self.size[s] == lengths[open_])
            found[open_[hit]] = True
            open_ = open_[~hit & (self.size[s] > 0)]
            slot[open_] += 1
        return found & (lengths <= 16)


class _Counts:
    """Whole tokens and the words met beside them; one for each task."""

    def __init__(self, vocabulary, whole):
        self.vocabulary, self.whole, self.cache = vocabulary, whole, Cache(vocabulary)

    def count(self, data, bounds):
        starts, special, of = pre_tokens(data, bounds, self.vocabulary.specials)
        lengths = np.append(starts[1:], len(data)) - starts
        n = np.ones(len(starts), np.int64)
        rest = np.flatnonzero(~self.whole.match(data, starts, lengths) & (special < 0))
        buffer = data.tobytes()
        words = [buffer[a: a + k] for a, k in zip(starts[rest].tolist(), lengths[rest].tolist())]
        longer = np.fromiter((w not in self.whole.long for w in words), bool, len(words))
        slots = self.cache.slots([w for w, keep in zip(words, longer) if keep])
        n[rest[longer]] = np.diff(self.cache.bounds)[slots]
        total = np.append(0, np.cumsum(n))
        return total[of[1:]] - total[of[:-1]]


def _count(shared):
    def count(batches):
        counts = None
        for batch in batches:
            counts = counts or _Counts(*shared.value)
            data, bounds = utf8(batch.column(1))
            counted = [counts.count(data[bounds[a]: bounds[b]], bounds[a: b + 1] - bounds[a]) for a, b in pieces(bounds)]
            yield pa.record_batch(
                [batch.column(0), pa.array(np.diff(bounds)), pa.array(np.concatenate([*counted, np.zeros(0, np.int64)]))],
                names=["doc_id", "n_bytes", "n_tokens"])
        released()
    return count


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) for every row of `docs`.

    Counts are those of the vocabulary in `path` for the whole text, without added tokens; the
    strings of special tokens inside a text count one. Null and empty texts count 0. Repeated rows
    and null ids are returned as they come; other columns are left out.
    """
    small_batches(docs.sparkSession)
    vocabulary = Vocabulary(path)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, WholeTokens(vocabulary)))
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _count(shared), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
