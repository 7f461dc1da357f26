"""BPE encoding and decoding with a lexicon transducer for frequent words.

The words (pre-tokens) of all texts are counted; the frequent ones are compiled, with their ids,
into a minimal acyclic transducer. Encoding walks the transducer for all words of a batch and
merges the words it does not hold exactly. Which words are in the lexicon changes speed only.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bpe import Cache, Vocabulary
from .lexicon import Lexicon
from .pretokens import pre_tokens
from .shelf import Shelf
from .words import giving_back, pieces, small_batches, utf8

#: Words in the lexicon at most; it holds speed, not results.
LEXICON_WORDS = 1 << 16
#: A word is counted from a piece of about 2 MB in which it stands at least so often.
FREQUENT_IN_PIECE = 3
#: Bytes of text, and ids, that are worked on at once; each costs some 100 bytes of memory.
ENCODED_BYTES = 1 << 19
DECODED_IDS = 1 << 18



def _counter(specials):
    def count(batches):
        for batch in batches:
            data, bounds = utf8(batch.column(0))
            for first, last in pieces(bounds):
                found: dict[bytes, int] = {}
                part = data[bounds[first]: bounds[last]]
                starts, special, _ = pre_tokens(part, bounds[first: last + 1] - bounds[first], specials)
                ends, buffer = np.append(starts[1:], len(part)), part.tobytes()
                plain = special < 0
                for a, b in zip(starts[plain].tolist(), ends[plain].tolist()):
                    word = buffer[a:b]
                    found[word] = found.get(word, 0) + 1
                often = {w: c for w, c in found.items() if c >= FREQUENT_IN_PIECE}
                yield pa.record_batch(
                    [pa.array(list(often), pa.binary()), pa.array(list(often.values()), pa.int64())], names=["word", "n"])
    return giving_back(count)


def frequent_words(docs: DataFrame, specials: dict[bytes, int], most: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent pre-tokens of all texts, in ascending order of bytes."""
    counted = docs.select("text").mapInArrow(_counter(specials), "word binary, n long")
    rows = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most)
    return sorted(rows.select("word").toArrow()["word"].to_pylist())


class _Encoder:
    """The lexicon, mapped into memory, and the words met beside it; one for each task."""

    def __init__(self, vocabulary, tables, longest, ids, bounds):
        self.vocabulary = vocabulary
        self.lexicon = Lexicon.mapped(tables, longest)
        self.ids, self.bounds = ids, bounds
        self.cache = Cache(vocabulary)

    def encode(self, data, bounds):
        """Ids of all texts in a row and the bounds of each text in them."""
        starts, special, of = pre_tokens(data, bounds, self.vocabulary.specials)
        ends = np.append(starts[1:], len(data))
        number = self.lexicon.find(data, starts, ends)
        unknown = np.flatnonzero((number < 0) & (special < 0))
        buffer = data.tobytes()
        slots = self.cache.slots([buffer[a:b] for a, b in zip(starts[unknown].tolist(), ends[unknown].tolist())])
        # One table of ids: the lexicon's words, then those of the cache, then the special ids.
        marked = np.flatnonzero(special >= 0)
        pool = np.concatenate([self.ids, self.cache.ids, special[marked]])
        begin, size = np.zeros(len(starts), np.int64), np.ones(len(starts), np.int64)
        known = number >= 0
        begin[known], size[known] = self.bounds[number[known]], np.diff(self.bounds)[number[known]]
        begin[unknown] = len(self.ids) + self.cache.bounds[slots]
        size[unknown] = np.diff(self.cache.bounds)[slots]
        begin[marked] = len(self.ids) + len(self.cache.ids) + np.arange(len(marked))
        total = np.append(0, np.cumsum(size))
        at = np.arange(total[-1]) + np.repeat(begin - total[:-1], size)
        return pool[at], total[of]


def _encode(shared):
    def encode(batches):
        encoder = None  # for one task: a worker that lives on holds nothing of it
        for batch in batches:
            encoder = encoder or _Encoder(**shared.value)
            data, bounds = utf8(batch.column(1))
            for first, last in pieces(bounds, ENCODED_BYTES):
                ids, of = encoder.encode(data[bounds[first]: bounds[last]], bounds[first: last + 1] - bounds[first])
                lists = pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.record_batch([batch.column(0).slice(first, last - first), lists], names=["doc_id", "ids"])
    return giving_back(encode)


def encode(docs: DataFrame, path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """`doc_id` and `ids` array<int>: the ids the vocabulary in `path` gives for the whole text.

    A null or empty text has no ids. Strings of special tokens inside texts get the special id.
    Every row gives one row, repeated ones too; other columns are left out.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    small_batches(spark)
    vocabulary = Vocabulary(path)
    words = frequent_words(docs, vocabulary.specials, lexicon_words)
    ids, bounds = vocabulary.encode(words)
    lexicon = Lexicon(words)
    shared = spark.sparkContext.broadcast({
        "vocabulary": vocabulary, "tables": lexicon.tables(),
        "longest": lexicon.longest, "ids": ids, "bounds": bounds})
    return docs.mapInArrow(_encode(shared), "doc_id long, ids array<int>")


def _decode(shared, column):
    def decode(batches):
        data, bounds = shared.value
        for batch in batches:
            at = batch.schema.get_field_index(column)
            lists = batch.column(at)
            lists = lists.cast(pa.list_(pa.int32())).fill_null(pa.scalar([], pa.list_(pa.int32())))
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            of = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
            rest = [i for i in range(batch.num_columns) if i != at]
            names = [*(batch.schema.names[i] for i in rest), "decoded"]
            for first, last in pieces(of, DECODED_IDS):
                part = ids[of[first]: of[last]]
                size = np.diff(bounds)[part]
                total = np.append(0, np.cumsum(size))
                text = data[np.arange(total[-1]) + np.repeat(bounds[:-1][part] - total[:-1], size)].tobytes()
                cut = total[of[first: last + 1] - of[first]].tolist()
                texts = [text[a:b].decode("utf-8", "replace") for a, b in zip(cut[:-1], cut[1:])]
                rows = batch.slice(first, last - first)
                yield pa.record_batch([*(rows.column(i) for i in rest), pa.array(texts, pa.string())], names=names)
    return giving_back(decode)


def decode(rows: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """`rows` with the text of their ids, special tokens included, as `decoded` in place of `column`.

    Bytes that are no UTF-8 become U+FFFD. Null lists give an empty text.
    """
    small_batches(rows.sparkSession)
    pieces_ = Vocabulary(path).pieces
    bounds = np.append(0, np.cumsum([len(p) for p in pieces_]))
    shared = rows.sparkSession.sparkContext.broadcast((np.frombuffer(b"".join(pieces_), np.uint8), bounds))
    kinds = [(f.name, f.dataType.simpleString()) for f in rows.schema if f.name != column]
    schema = ", ".join([*(f"`{name}` {kind}" for name, kind in kinds), "decoded string"])
    return rows.mapInArrow(_decode(shared, column), schema)


def encoded_digests(docs: DataFrame, path: str, apart: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of `docs`.

    With `apart` the ids are written between encoding and decoding: else each task has a worker for both
    at once, and an executor keeps twice the workers, with their memory, for the steps that follow.
    """
    ids = encode(docs, path).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"))
    if apart:
        ids = Shelf(docs.sparkSession, "encoding").keep(ids, "ids")
    return decode(ids, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
