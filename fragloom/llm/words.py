"""Words, word hashes and shingle sets of whole text batches, as numpy arrays over UTF-8 bytes.

A word is a maximal run of bytes other than space and 0x09-0x0D; A-Z count as a-z. Hashes have
64 bits: two words are taken as equal when their hashes are.
"""

import ctypes
import functools

import numpy as np
import pyarrow as pa
import zstandard

#: Bytes of text that are worked on at once; each costs about 50 bytes of memory.
PIECE_BYTES = 1 << 19

#: Session settings that `small_batches` lowers.
BATCH_LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1_000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20,
    "spark.sql.parquet.columnarReaderBatchSize": 256}

_random = np.random.default_rng(20240611)
_BYTE = _random.integers(1, 2**64, 256, dtype=np.uint64, endpoint=False) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = _random.integers(1, 2**64, 16, dtype=np.uint64, endpoint=False) | np.uint64(1)
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes that are neither letters nor digits nor part of a character beyond ASCII.
IS_SIGN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(h):
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and the bounds of each text; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]: bounds[-1]], bounds - bounds[0]


def pieces(bounds: np.ndarray, most: int = PIECE_BYTES):
    """Ranges of texts with about `most` bytes each; a longer text is a range of its own."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def word_spans(data: np.ndarray, bounds: np.ndarray, gaps: np.ndarray = IS_SPACE):
    """Starts and ends of all words, and for each text the bounds of its words; `gaps` part words."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    ink = ~gaps[data]
    first = ink.copy()
    first[1:] &= ~ink[:-1] | cut[1:n]
    last = ink.copy()
    last[:-1] &= ~ink[1:] | cut[1:n]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int | None = None) -> np.ndarray:
    """A hash of each word, or of its first `most` bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts if most is None else np.minimum(ends - starts, most)
    begins = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(begins, lengths)
    power = np.full(int(lengths.max()), _BASE, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    values = _BYTE[data[at + np.repeat(starts, lengths)]] * power[at]
    return mix(np.add.reduceat(values, begins) + lengths.astype(np.uint64))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k words in a row of one text; with fewer words, one for all of them."""
    n = len(words)
    if n == 0:
        return words
    width = min(n, k)
    total = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        total += words[i: n - width + 1 + i] * _STEP[i]
    return mix(total)


def shingle_sets(texts: pa.Array, k: int):
    """Yields for each text, in order, its sorted distinct shingle hashes."""
    data, bounds = utf8(texts)
    for first, last in pieces(bounds):
        part, inner = data[bounds[first]: bounds[last]], bounds[first: last + 1] - bounds[first]
        starts, ends, of = word_spans(part, inner)
        words = word_hashes(part, starts, ends)
        for i in range(last - first):
            yield np.unique(shingle_hashes(words[of[i]: of[i + 1]], k))


def giving_back(work):
    """The function over the batches of a task, giving memory back when it has ended: only then are its
    own variables, the last batch and whatever it built for the task among them, free."""
    @functools.wraps(work)
    def ending(batches):
        yield from work(batches)
        released()
    return ending


@giving_back
def squeeze(batches):
    """Replace the text, the last column, by its compressed bytes, for shuffles of whole texts."""
    for batch in batches:
        data, bounds = utf8(batch.column(batch.num_columns - 1))
        press = zstandard.ZstdCompressor(3).compress
        texts = [press(data[a:b].tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        yield pa.record_batch([*batch.columns[:-1], pa.array(texts, pa.binary())], names=[*batch.schema.names[:-1], "text"])


def unsqueezed(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def gathered(batches, rows: int = 20_000):
    """Tables of at least so many rows (but for the last) from small batches of narrow rows."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def small_batches(spark) -> None:
    """Whole texts cross to Python and back in batches of a few megabytes: by default a batch has
    10,000 rows, which for texts means hundreds of megabytes on both sides of every task. A Parquet reader
    holds the texts or ids of a batch, by default 4,096 rows, in arrays that double as they grow."""
    for name, most in BATCH_LIMITS.items():
        now = int(spark.conf.get(name).rstrip("b"))
        if not 0 < now <= most:
            spark.conf.set(name, str(most))


def released():
    """Give memory of finished batches back: workers live on and share their machine."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)  # else the C library keeps what arrays of up to 32 MB have left
