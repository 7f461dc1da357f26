"""Quality by compression: how much better one dictionary compresses a text than the other.

Two zstandard dictionaries are built from good and bad labelled texts. A text is cut into blocks,
so that a long one does not become its own dictionary; each block is compressed with either. The
difference of the sums over the whole text, divided by its length, is calibrated to a score.
"""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .labelled import fold, labelled_sample, logistic
from .words import giving_back, released, small_batches, utf8

#: Labelled rows that the dictionaries and the calibration are fitted on, at most.
SAMPLE_ROWS = 8_000
BLOCK_BYTES = 512
DICTIONARY_BYTES = 64 << 10
LEVEL = 3


def blocks(text: bytes) -> list[bytes]:
    return [text[i: i + BLOCK_BYTES] for i in range(0, len(text), BLOCK_BYTES)]


def build_dictionary(texts: list[bytes]) -> tuple[bytes, bool]:
    """A trained dictionary, or plain content where there is too little to train on; and which."""
    parts = [b for t in texts for b in blocks(t)]
    total = sum(map(len, parts))
    if len(parts) >= 100:
        try:
            return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, total // 4)), parts).as_bytes(), True
        except zstandard.ZstdError:
            pass  # the texts are too much alike to train on
    return b"".join(parts)[-DICTIONARY_BYTES:], False


class Compressors:
    """Compressors with the dictionaries of bad and good text."""

    def __init__(self, dictionaries):
        self.each = []
        for data, trained in dictionaries:
            held = None
            if data:
                kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
                held = zstandard.ZstdCompressionDict(data, dict_type=kind)
                held.precompute_compress(LEVEL)
            self.each.append(zstandard.ZstdCompressor(
                LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))

    def difference(self, text: bytes) -> float:
        """Bytes that the dictionary of good text saves against the other, per byte; empty: 0."""
        bad, good = (sum(len(c.compress(b)) for b in blocks(text)) for c in self.each)
        return (bad - good) / max(1, len(text))


def differences(compressors: Compressors, texts: pa.Array) -> np.ndarray:
    data, bounds = utf8(texts)
    return np.array([compressors.difference(data[a:b].tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], float)


def fit(texts: pa.Array, y: np.ndarray):
    """Dictionaries from one half of the sample, slope and offset from the other."""
    half = (len(y) + 1) // 2
    raw = [t.encode() for t in texts.slice(0, half).to_pylist()]
    dictionaries = [build_dictionary([t for t, q in zip(raw, y) if q == label]) for label in (0, 1)]
    slope, offset = logistic(differences(Compressors(dictionaries), texts.slice(half)), y[half:])
    return dictionaries, slope, offset


def _score(shared):
    def score(batches):
        compressors = None
        for batch in batches:
            dictionaries, slope, offset = shared.value
            compressors = compressors or Compressors(dictionaries)
            x = differences(compressors, batch.column(batch.num_columns - 1))
            p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
            yield pa.record_batch([*batch.columns, pa.array(p)], names=[*batch.schema.names, "score"])
    return giving_back(score)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.3) -> DataFrame:
    """row (a struct of all columns of `docs` but the text), text, held_out, score, predicted.

    score is between 0 and 1, higher for better text; null and empty texts get the score of no
    difference. predicted is 1 from `threshold` on. Labels of the fold `held_out` are never learned
    from; without labels of both kinds every text gets the same score. Every row gives one row.
    """
    small_batches(docs.sparkSession)
    texts, y, _ = labelled_sample(docs, labels, "quality", folds, held_out, SAMPLE_ROWS)
    shared = docs.sparkSession.sparkContext.broadcast(fit(texts, y))
    del texts
    released()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), "text")
    kind = rows.schema["row"].dataType.simpleString()
    scored = rows.mapInArrow(_score(shared), f"row {kind}, text string, score double")
    return scored.select(
        "row", "text", (fold(F.col("row.doc_id"), folds) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_bad(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that are not rejected; columns and rows stay as they are."""
    kept = quality_scores(docs, labels, threshold=threshold).filter("predicted = 1")
    return kept.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
