"""Packing of tokenised documents into as few sequences of one capacity as possible.

Every document is its ids and one end id; only documents longer than a sequence are cut. Which
lengths go together is decided on the histogram of lengths, which has one entry for each length up
to the capacity however many documents there are. By minimum bin slack, the longest piece left
opens a sequence and a subset-sum over the lengths left, as bits of a whole number, finds the
fullest combination beside it; that combination is removed as often as the lengths last.

Pieces then get numbers within their length: a task numbers its own pieces while it encodes them,
and sums of these counts over the tasks place them behind each other. A number names the sequence
and the place in it. No group of pieces is ever gathered, however many have one length.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .bpe import Vocabulary
from .pretokens import pre_tokens
from .shelf import Shelf
from .words import pieces, released, small_batches, utf8

CAPACITY = 2048
END_ID = 0
#: Bytes of text that are encoded at once; each costs some 100 bytes of memory.
ENCODED_BYTES = 1 << 20
#: Words kept with their ids by one task.
CACHED_WORDS = 200_000

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def with_cuts(data: np.ndarray, bounds: np.ndarray, most: int = ENCODED_BYTES) -> np.ndarray:
    """`bounds` and, inside texts longer than `most`, places where encoding can be cut.

    A space between two ASCII letters always begins a pre-token. A stretch without such a place is
    not cut.
    """
    added = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        while b - a > most:
            look, cut = a + most, None
            while look < b - 1 and cut is None:
                window = data[look - 1: min(look + 65_536, b)]
                fits = np.flatnonzero((window[1:-1] == 32) & _LETTER[window[:-2]] & _LETTER[window[2:]])
                cut = look + int(fits[0]) if len(fits) else None
                look += 65_534
            if cut is None:
                break
            added.append(cut)
            a = cut
    return np.sort(np.concatenate([bounds, np.array(added, np.int64)])) if added else bounds


class Encoder:
    """Ids of whole texts; words met by one task are merged once."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._clear()

    def _clear(self):
        """Only the special strings are known; each is its own id."""
        specials = self.vocabulary.specials
        self.slot = {word: i for i, word in enumerate(specials)}
        self.ids, self.bounds = np.array([*specials.values()], np.int32), np.arange(len(specials) + 1)

    def _slots(self, words: list[bytes]) -> np.ndarray:
        if len(self.slot) > CACHED_WORDS:
            self._clear()
        fresh = [w for w in words if w not in self.slot]
        if fresh:
            ids, bounds = self.vocabulary.encode(fresh)
            self.slot.update(zip(fresh, range(len(self.bounds) - 1, len(self.bounds) - 1 + len(fresh))))
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + bounds[1:]])
            self.ids = np.concatenate([self.ids, ids])
        return np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))

    def _part(self, data, bounds):
        starts, _, of = pre_tokens(data, bounds, self.vocabulary.specials)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
        # Pre-tokens lie side by side, so that their starts are the offsets of an Arrow array.
        offsets = np.append(starts, len(data)).astype(np.int32)
        words = pa.BinaryArray.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        coded = words.dictionary_encode()
        slots = self._slots(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        size = np.diff(self.bounds)[slots]
        total = np.append(0, np.cumsum(size))
        at = np.arange(total[-1]) + np.repeat(self.bounds[slots] - total[:-1], size)
        return self.ids[at], total[of]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and the bounds of each text in them."""
        data, bounds = utf8(texts)
        cut = with_cuts(data, bounds)
        ids, ends = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for first, last in pieces(cut, ENCODED_BYTES):
            found, of = self._part(data[cut[first]: cut[last]], cut[first: last + 1] - cut[first])
            ids.append(found)
            ends.append(ends[-1][-1] + of[1:])
        return np.concatenate(ids), np.concatenate(ends)[_places_of(bounds, cut)]


def _places_of(bounds, cut):
    """Places of `bounds` in `cut`; empty texts repeat a bound in both."""
    place = np.searchsorted(cut, bounds, "left")
    same = np.arange(len(bounds)) - np.searchsorted(bounds, bounds, "left")
    return place + same


def cut_lengths(lengths: np.ndarray, capacity: int):
    """Document, number, start and length of every piece; the first piece takes what is left over."""
    n = -(-lengths // capacity)
    owner = np.repeat(np.arange(len(lengths)), n)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    first = lengths - (n - 1) * capacity
    length = np.where(number == 0, first[owner], capacity)
    start = np.where(number == 0, 0, first[owner] + (number - 1) * capacity)
    return owner, number, start, length


def _cut(shared, capacity, end_id, with_ids):
    def cut(batches):
        encoder, part, seen = Encoder(shared.value), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids, of = encoder.encode(batch.column(1))
            sizes = np.diff(of)
            whole = np.full(len(ids) + len(sizes), end_id, np.uint32)
            whole[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = ids
            begins = of[:-1] + np.arange(len(sizes))
            owner, number, start, length = cut_lengths(sizes + 1, capacity)
            at = begins[owner] + start
            raw = memoryview(whole.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a: 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist())]
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            nth = np.empty(len(order), np.int64)
            nth[order] = seen[ordered] + np.arange(len(order)) - np.searchsorted(ordered, ordered)
            seen += np.bincount(length, minlength=capacity + 1)
            columns = [batch.column(0).take(pa.array(owner)), pa.array(number, pa.int32()), pa.array(start), pa.array(length),
                       pa.array(crc, pa.int64()), pa.array(np.full(len(owner), part, np.int32)), pa.array(nth)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            if with_ids:
                ends = np.append(0, np.cumsum(length))
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(whole.astype(np.int32))))
                names.append("ids")
            yield pa.record_batch(columns, names=names)
        released()
    return cut


def fullest(room: int, left: dict[int, int]) -> dict[int, int]:
    """How often to take each length so that the sum is as near below `room` as can be.

    Bit s of `reach` says that some of the lengths so far sum to s. Longer lengths come first, and
    the search ends when the room can be filled.
    """
    mask, reach, steps = (1 << room + 1) - 1, 1, []
    for length in sorted((k for k, n in left.items() if n and k <= room), reverse=True):
        steps.append((length, reach))
        most, block = min(left[length], room // length), 1
        while most:
            block = min(block, most)
            reach |= reach << length * block & mask
            most -= block
            block *= 2
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> total & 1:
            total -= length
            n += 1
        if n:
            taken[length] = n
    return taken


def combinations(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths, in order, and the number of sequences of each; all pieces are used."""
    left, found = {k: n for k, n in histogram.items() if n}, []
    for longest in sorted(left, reverse=True):
        while left[longest]:
            left[longest] -= 1
            taken = fullest(capacity - longest, left)
            left[longest] += 1
            taken[longest] = taken.get(longest, 0) + 1
            times = min(left[k] // n for k, n in taken.items())
            for k, n in taken.items():
                left[k] -= n * times
            found.append((taken, times))
    return found


class Places:
    """Sequence and offset of the pieces of each length, by their number within the length."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        used, sequence, rows = dict.fromkeys(histogram, 0), 0, []
        for taken, times in combinations(histogram, capacity):
            offset = 0
            for length, n in sorted(taken.items(), reverse=True):
                rows.append((length, used[length], n, sequence, offset))
                used[length] += n * times
                offset += n * length
            sequence += times
        self.sequences = sequence
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.lengths = np.unique(table[:, 0])
        self.bounds = np.append(np.searchsorted(table[:, 0], self.lengths), len(table))
        _, self.first, self.each, self.sequence, self.offset = table.T.copy()

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        cuts = np.searchsorted(length[order], self.lengths, "left"), np.searchsorted(length[order], self.lengths, "right")
        for i, (a, b) in enumerate(zip(*cuts)):
            if a < b:
                some, lo, hi = order[a:b], self.bounds[i], self.bounds[i + 1]
                row = lo + np.searchsorted(self.first[lo:hi], number[some], "right") - 1
                copy, place = np.divmod(number[some] - self.first[row], self.each[row])
                sequence[some] = self.sequence[row] + copy
                offset[some] = self.offset[row] + place * self.lengths[i]
        return sequence, offset


def _place(shared):
    def place(batches):
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            number = batch.column(batch.schema.get_field_index("_number")).to_numpy()
            sequence, offset = shared.value.find(length, number)
            rest = [i for i, name in enumerate(batch.schema.names) if name != "_number"]
            yield pa.record_batch(
                [*(batch.column(i) for i in rest), pa.array(sequence), pa.array(offset)],
                names=[*(batch.schema.names[i] for i in rest), "sequence_id", "offset"])
    return place


def packed_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece; `ids` on request.

    Ids are those of the vocabulary in `path` for the whole text, special strings inside it as one
    id, and `end_id` behind them; a null or empty text is the end id alone. A document of more than
    `capacity` ids is cut: the first piece takes what is left over, the others are full. Pieces of a
    sequence lie side by side from offset 0. Every row is a document of its own, also where ids
    repeat or are null. Without rows there are no pieces; other columns are not read. Very long
    texts are encoded by the megabyte; what is held of them is their ids.
    """
    spark = docs.sparkSession
    shelf = Shelf(spark, "packing")
    small_batches(spark)
    vocabulary = spark.sparkContext.broadcast(Vocabulary(path))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = shelf.keep(rows.mapInArrow(
        _cut(vocabulary, capacity, end_id, with_ids), schema + (", ids array<int>" if with_ids else "")), "pieces")
    sizes = shelf.keep(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "sizes")
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.sparkContext.broadcast(Places(histogram, capacity))
    behind = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "part", F.coalesce(F.sum("n").over(behind), F.lit(0)).alias("_before"))
    numbered = cut.join(before, ["length", "part"]).withColumn("_number", F.col("_before") + F.col("nth"))
    wanted = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.select(*wanted).schema)
    return numbered.select(*wanted, "_number").mapInArrow(_place(places), f"{kinds}, sequence_id long, offset long")


def training_sequences(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """sequence_id, ids (at most `capacity`), parts (doc_id, piece, offset, length in order of offset)."""
    packed = packed_pieces(docs, path, capacity, end_id, True)
    part = F.struct("offset", "doc_id", "piece", "length", "ids")
    lists = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("all"))
    return lists.select(
        "sequence_id", F.flatten(F.transform("all", lambda p: p["ids"])).alias("ids"),
        F.transform("all", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"], p["length"])).alias("parts"))
