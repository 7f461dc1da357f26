"""Removal of repeated passages by a distributed suffix sort that knows common prefixes.

A passage is a string of `length` bytes. Sorting the suffixes at every byte would move the corpus
many times over, so suffixes are sorted at anchors: the anchor of a passage is its k-gram with the
least hash, so that equal passages have their anchors at the same place inside them, and each
anchor stands for a stretch of passage starts around it. Only anchors whose k-gram occurs twice
in the corpus go on.

1. Anchors are shuffled by k-gram; those met once are left out.
2. Each task sorts the suffixes at its anchors into a run, with the common prefix of neighbours,
   and cuts the run by key ranges into front-coded pieces: what a suffix shares with the one
   before it is not sent. Equal contexts inside a run are sent once.
3. The task of a key range combines its pieces with a loser tree. A comparison first holds the two
   known common prefixes with the last output against each other; bytes are compared only where
   these are equal, and only behind them.
4. Neighbours in the merged order give, for every anchor and shift, the passages that are equal to
   the right of the anchor; the same is done to the left. The least (document, start) of each
   class stays, the other starts are covered.

Splitters only decide balance. An anchor with very many occurrences is replaced by all passages
it stands for, which spread over the key ranges.
"""

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .shelf import Shelf
from .words import gathered, giving_back, mix, released, squeeze, unsqueezed, utf8

GRAM = 24
#: Anchors of one range and task, about.
RANGE_ROWS = 100_000
#: Anchors of one sorted run, about.
RUN_ROWS = 100_000
#: Anchors that the splitters are taken from.
SPLITTER_ROWS = 40_000
#: Occurrences of one k-gram from which its passages are sorted one by one; so many such k-grams are
#: told to every task (16 bytes each), more are joined by shuffle.
HOT_ROWS, BROADCAST_GRAMS = 100_000, 500_000
_PLACE = np.uint64((1 << 28) - 1)
#: Texts that are written out at once.
REMOVED_ROWS = 1_000
#: Of a row on its way to the others with its k-gram: to be found out; repeated for sure, and so
#: dealt out evenly, however frequent the k-gram; tells the others, then goes.
_OPEN, _KNOWN, _WITNESS = 0, 1, 2


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each byte on."""
    n = len(data) - GRAM + 1
    total = np.zeros(n, np.uint64)
    wide = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))
    for i, factor in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)):
        total += mix(wide[8 * i: 8 * i + n] + np.uint64(factor)) * np.uint64(factor)
    return mix(total)


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of one stretch of bytes: k-gram hash, place, first and last passage start."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none
    hashes = gram_hashes(data)
    low = hashes & ~_PLACE | np.arange(len(hashes), dtype=np.uint64) & _PLACE
    width, reach = length - GRAM + 1, 1
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < width:
        low = np.minimum(low[: len(low) - (width - reach)], low[width - reach:])
    place = (low & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    last = np.append(first[1:], len(place)) - 1
    return hashes[place[first]], place[first], first, last


def text_anchors(data: np.ndarray, length: int, stretch: int = 1 << 22):
    """Anchors of one text; long texts go stretch by stretch, every start in one of them."""
    for start in range(0, max(1, len(data) - length + 1), stretch):
        hashes, place, first, last = anchors(data[start: start + stretch + length - 1], length)
        yield hashes, place + start, first + start, last + start


def pack(place, first, last):
    """Place of an anchor and the reach of its passages to the left."""
    return place << 14 | (place - first) << 7 | (place - last)


def unpack(packed):
    return packed >> 14, (packed >> 7) & 127, packed & 127


def _find(length):
    def find(batches):
        for batch in batches:
            data, bounds = utf8(batch.column(1))
            keys = batch.column(0).to_numpy()
            held, count = [], 0

            def flush():
                gram, key, packed = (np.concatenate(c) for c in zip(*held))
                held.clear()
                _, first, group, n = np.unique(gram, return_index=True, return_inverse=True, return_counts=True)
                # Met twice here: known to be repeated, one row tells the others with its k-gram.
                kind = np.where(n[group] > 1, _KNOWN, _OPEN)
                told = first[n > 1]
                gram, key, packed = (np.concatenate([c, c[told]]) for c in (gram.view(np.int64), key, packed))
                kind = np.concatenate([kind, np.full(len(told), _WITNESS)]).astype(np.int8)
                return pa.record_batch([pa.array(c) for c in (gram, key, packed, kind)], names=["gram", "key", "packed", "kind"])

            for i in np.flatnonzero(np.diff(bounds) >= length).tolist():
                for gram, place, first, last in text_anchors(data[bounds[i]: bounds[i + 1]], length):
                    held.append((gram, np.full(len(gram), keys[i]), pack(place, first, last)))
                    count += len(gram)
                if count > 200_000:
                    yield flush()
                    count = 0
            if held:
                yield flush()
    return giving_back(find)


@giving_back
def _repeated(batches):
    """Of rows sorted by k-gram, those known to be repeated and those next to one of their k-gram."""
    def chosen(table, several):
        kind = table["kind"].to_numpy()
        keep = pa.array((kind == _KNOWN) | (kind == _OPEN) & several)
        return table.filter(keep).drop_columns(["kind"]).combine_chunks().to_batches()

    held, known = None, False
    for table in gathered(batches):
        table = pa.concat_tables([held, table]) if held is not None else table
        gram = table["gram"].to_numpy()
        same = gram[1:] == gram[:-1]
        several = np.append(known, same) | np.append(same, False)
        yield from chosen(table.slice(0, len(gram) - 1), several[:-1])
        held, known = table.slice(len(gram) - 1).combine_chunks(), bool(several[-1])
    if held is not None:
        yield from chosen(held, np.array([known]))


def common_prefixes(strings: list[bytes]) -> np.ndarray:
    """Length of the common prefix of each string with the one before it; 0 for the first."""
    out = np.zeros(len(strings), np.int64)
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    for start in range(0, len(strings), 1 << 15):
        some = strings[max(0, start - 1): start + (1 << 15)]
        size = lengths[max(0, start - 1): start + (1 << 15)]
        width = int(size.max(initial=0)) + 1
        rows = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in some), np.uint8).reshape(len(some), width)
        if len(some) > 1:
            differ = rows[1:] != rows[:-1]
            differ[:, -1] = True
            found = np.minimum(differ.argmax(1), np.minimum(size[1:], size[:-1]))
            out[max(0, start - 1) + 1: max(0, start - 1) + len(some)] = found
    return out


class Piece:
    """Items of one run and key range: sorted suffixes with what stands before and who owns them."""

    def __init__(self, right, left, doc, key, packed):
        self.right, self.left, self.doc, self.key, self.packed = right, left, doc, key, packed

    def coded(self):
        """Front-coded: common prefix with the suffix before, and the rest."""
        shared = common_prefixes(self.right)
        rest = [s[k:] for s, k in zip(self.right, shared.tolist())]
        size = lambda strings: np.fromiter(map(len, strings), np.uint8, len(strings)).tobytes()
        pack_ = zstandard.ZstdCompressor(1).compress
        return (
            pack_(shared.astype(np.uint8).tobytes()), pack_(size(rest)), pack_(b"".join(rest)), pack_(size(self.left)),
            pack_(b"".join(self.left)), pack_(self.doc.tobytes()), pack_(self.key.tobytes()), self.packed.tobytes())


def _bytes(data: bytes) -> np.ndarray:
    return np.frombuffer(unsqueezed(data), np.uint8)


def _cut(data: bytes, sizes: np.ndarray) -> list[bytes]:
    data = unsqueezed(data)
    ends = np.cumsum(sizes, dtype=np.int64)
    return [data[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]


def _runs(length, splitters):
    """Sort the suffixes of a task into runs and cut them by key ranges."""
    def runs(batches):
        right, left, doc, key, packed = [], [], [], [], []

        def flush():
            order = sorted(range(len(right)), key=lambda i: (right[i], left[i], doc[i], packed[i] >> 14))
            stay, covered = [], []
            before = None
            for i in order:
                # Equal contexts hold equal passages: only the first one is sent.
                if before is not None and right[i] == right[before] and left[i] == left[before]:
                    if (doc[i], packed[i] >> 14) != (doc[before], packed[before] >> 14):
                        covered.append(i)
                        continue
                    if (key[i], packed[i]) == (key[before], packed[before]):
                        continue
                stay.append(i)
                before = i
            heads = [right[i] for i in stay]
            docs, keys, packs = np.array(doc, np.int64), np.array(key, np.int64), np.array(packed, np.int64)
            cuts = [0, *(bisect.bisect_left(heads, s) for s in splitters), len(heads)]
            for number, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if a < b:
                    some = stay[a:b]
                    yield (number, *Piece(heads[a:b], [left[i] for i in some], docs[some], keys[some], packs[some]).coded())
            if covered:
                place, most, least = unpack(packs[covered])
                # These need no merge: numbers below 0, by their first text, spread them over all tasks.
                own, first, last = joined_stretches(keys[covered], place - most, place - least)
                yield (-1 - int(own[0] % 1_000_003), b"", b"", b"", b"", b"", b"", own.tobytes(), np.concatenate([first, last]).tobytes())
            for held in (right, left, doc, key, packed):
                held.clear()

        names = ["part", "shared", "rest_size", "rest", "left_size", "left", "doc", "key", "packed"]

        def rows():
            found = list(flush())
            kinds = [pa.int32(), *[pa.binary()] * 8]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

        for batch in batches:
            docs, keys, texts, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                text = unsqueezed(texts[i].as_py())
                items = lists[i].values
                owns = items.field("packed").to_numpy(zero_copy_only=False)
                hots = items.field("hot").to_numpy(zero_copy_only=False)
                # A few at once, so that what is held does not grow with the text.
                for first in range(0, len(owns), RUN_ROWS // length):
                    for own, hot in zip(owns[first: first + RUN_ROWS // length].tolist(), hots[first: first + RUN_ROWS // length].tolist()):
                        place, most, least = unpack(own)
                        if hot:
                            for start in range(place - most, place - least + 1):
                                right.append(text[start: start + length])
                                left.append(b"")
                                doc.append(docs[i])
                                key.append(keys[i])
                                packed.append(pack(start, start, start))
                        else:
                            right.append(text[place: place - least + length])
                            left.append(text[place - most: place])
                            doc.append(docs[i])
                            key.append(keys[i])
                            packed.append(own)
                    if len(right) > RUN_ROWS:
                        yield rows()
        if right:
            yield rows()
    return giving_back(runs)


def merged(pieces_: list[tuple[np.ndarray, list[bytes]]]) -> Iterator[tuple[int, int, int]]:
    """Merge front-coded runs with a loser tree: yields (run, item, common prefix with the last).

    Each run gives its common prefixes and the rest of each suffix behind them. A node keeps the
    loser of its match and the loser's common prefix with the last suffix put out. The larger
    common prefix wins a match unseen; equal ones are compared behind that prefix only.
    """
    k = len(pieces_)
    size = 1 << max(0, (k - 1).bit_length())
    shared = [p[0].tolist() for p in pieces_]
    rests = [p[1] for p in pieces_]
    head: list[bytes | None] = [r[0] for r in rests] + [None] * (size - k)
    known = [0] * size  # common prefix of each head with the last suffix put out
    at = [0] * size
    losers = [0] * size

    def match(a, b):
        """(winner, loser); the loser's common prefix with the winner is noted."""
        x, y = head[a], head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        p, q = known[a], known[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        most = min(len(x), len(y))
        if x[p:most] == y[p:most]:
            p = most
        else:
            while x[p] == y[p]:
                p += 1
        if p == len(x) or p < len(y) and x[p] < y[p]:
            known[b] = p
            return a, b
        known[a] = p
        return b, a

    winners = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = match(winners[2 * node], winners[2 * node + 1])
    best = winners[1]
    while head[best] is not None:
        yield best, at[best], known[best]
        i = at[best] = at[best] + 1
        if i < len(rests[best]):
            known[best] = shared[best][i]
            head[best] = head[best][: known[best]] + rests[best][i]
        else:
            head[best] = None
        node = (size + best) // 2
        while node:
            best, losers[node] = match(best, losers[node])
            node //= 2


def covered_starts(right_shared, left, doc, packed, length):
    """Covered stretches of passage starts: item, first and last start.

    Items are in suffix order; right_shared holds the common prefixes of neighbours.
    """
    n = len(doc)
    place, most, least = unpack(packed)
    turned = [s[::-1] for s in left]
    by_left = np.array(sorted(range(n), key=turned.__getitem__), np.int64)
    left_shared = common_prefixes([turned[i] for i in by_left.tolist()])
    around = lambda shared: np.maximum(shared, np.append(shared[1:], 0))
    reach_right, reach_left = around(right_shared), np.zeros(n, np.int64)
    reach_left[by_left] = around(left_shared)
    low, high = np.maximum(least, length - reach_right), np.minimum(most, reach_left)
    # Items by document and place; a larger rank starts later at every shift.
    order = np.lexsort((place, doc))
    new = np.append(True, (np.diff(doc[order]) != 0) | (np.diff(place[order]) != 0))[:n]
    rank = np.zeros(n, np.int64)
    rank[order] = np.cumsum(new)
    alive = order[low[order] <= high[order]]
    widest = int(high[alive].max(initial=-1)) + 1
    covered = np.zeros((len(alive), widest + 1), bool)
    class_left = np.zeros(n, np.int64)
    for shift in range(widest):
        some = np.flatnonzero((low[alive] <= shift) & (shift <= high[alive]))
        if not len(some):
            continue
        class_right = np.cumsum(right_shared < length - shift)
        class_left[by_left] = np.cumsum(left_shared < shift)
        item = alive[some]
        key = class_right[item] * (n + 1) + class_left[item]
        _, first, group = np.unique(key, return_index=True, return_inverse=True)
        covered[some, shift] = rank[item] > rank[item[first[group]]]
    flat = np.concatenate([np.zeros((len(alive), 1), bool), covered], axis=1).astype(np.int8)
    step = np.diff(flat, axis=1)
    row, begin = np.nonzero(step == 1)
    _, end = np.nonzero(step == -1)
    item = alive[row]
    return item, place[item] - (end - 1), place[item] - begin


_COVER = "key long, first long, last long"


def joined_stretches(key: np.ndarray, first: np.ndarray, last: np.ndarray):
    """The same starts of each text as stretches that neither meet nor overlap."""
    order = np.lexsort((first, key))
    key, first, last = (np.asarray(c, np.int64)[order] for c in (key, first, last))
    if not len(key):
        return key, first, last
    fresh = np.append(True, key[1:] != key[:-1])
    # The furthest end so far in the same text: later texts get larger numbers.
    text = np.cumsum(fresh) << 32
    reach = np.maximum.accumulate(text + last)
    begin = fresh.copy()
    begin[1:] |= text[1:] + first[1:] > reach[:-1] + 1
    at = np.flatnonzero(begin)
    ends = np.append(at[1:], len(key)) - 1
    return key[at], first[at], reach[ends] - text[ends]


def _combine(length):
    """Merge the pieces of each key range and give the covered stretches of starts."""
    def rows(key, first, last):
        return pa.record_batch([pa.array(c) for c in (key, first, last)], names=["key", "first", "last"])

    def merge(held):
        runs, left, doc, key, packed = [], [], [], [], []
        for r in held:
            runs.append((_bytes(r["shared"]), _cut(r["rest"], _bytes(r["rest_size"]))))
            left.append(_cut(r["left"], _bytes(r["left_size"])))
            doc.append(np.frombuffer(unsqueezed(r["doc"]), np.int64))
            key.append(np.frombuffer(unsqueezed(r["key"]), np.int64))
            packed.append(np.frombuffer(r["packed"], np.int64))
        run, item, shared = (np.array(c, np.int64) for c in zip(*merged(runs)))
        offset = np.cumsum([0, *map(len, doc)])
        at = offset[run] + item
        flat = [s for strings in left for s in strings]
        doc, key, packed = (np.concatenate(c)[at] for c in (doc, key, packed))
        found, first, last = covered_starts(shared, [flat[i] for i in at.tolist()], doc, packed, length)
        return rows(*joined_stretches(key[found], first, last))

    def combine(batches):
        part, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] < 0:
                    first, last = np.frombuffer(row["packed"], np.int64).reshape(2, -1)
                    yield rows(np.frombuffer(row["key"], np.int64), first, last)
                    continue
                if row["part"] != part and held:
                    yield merge(held)
                    held = []
                part = row["part"]
                held.append(row)
        if held:
            yield merge(held)
    return giving_back(combine)


@giving_back
def _grams(batches):
    """The first bytes of the suffixes at sampled anchors."""
    for batch in batches:
        found = []
        for text, packed in zip(batch.column(1), batch.column(2).to_pylist()):
            data = text.as_py().encode()
            places = [unpack(p)[0] for p in packed]
            found += [g for g in (data[at: at + GRAM] for at in places) if len(g) == GRAM]
        yield pa.record_batch([pa.array(found, pa.binary())], names=["gram"])


def _splitters(docs: DataFrame, repeated: DataFrame, parts: int, total: int) -> list[bytes]:
    """Keys that cut the repeated suffixes into about equal parts, from a sample of the anchors
    themselves: about `SPLITTER_ROWS` by a hash, wherever in however long texts they stand."""
    if parts < 2:
        return []
    share = min(1.0, SPLITTER_ROWS / max(total, 1))
    hashed = F.pmod(F.xxhash64("key", "packed", F.lit(11)), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = repeated.filter(hashed).groupBy("key").agg(F.collect_list("packed").alias("packed"))
    grams = docs.select("key", "text").join(F.broadcast(sample), "key").select("key", "text", "packed").mapInArrow(
        _grams, "gram binary").toArrow()["gram"].to_pylist()
    grams.sort()
    released()
    return sorted({grams[len(grams) * i // parts] for i in range(1, parts)}) if grams else []


@giving_back
def _remove(batches):
    for batch in batches:
        for first in range(0, batch.num_rows, REMOVED_ROWS):
            yield _removed(batch.slice(first, REMOVED_ROWS))


def _removed(batch):
    texts, lists = batch.column(1), batch.column(2)
    size, removed, spans, kept, digests = [], [], [], [], []
    for i in range(batch.num_rows):
        data = unsqueezed(texts[i].as_py())
        stretches = lists[i].as_py()
        runs = []
        if stretches:
            text = np.frombuffer(data, np.uint8)
            edge = np.zeros(len(text) + 1, np.int64)
            ends = np.array([(s["first"], s["last"]) for s in stretches], np.int64)
            np.add.at(edge, ends[:, 0], 1)
            np.add.at(edge, ends[:, 1], -1)
            gone = np.cumsum(edge[:-1]) > 0
            step = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
            runs = [{"first": int(a), "last": int(b)} for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1))]
            data = text[~gone].tobytes()
        spans.append(runs)
        removed.append(sum(r["last"] - r["first"] for r in runs))
        size.append(len(data) + removed[-1])
        kept.append(data.decode("utf-8", "ignore"))
        digests.append(hashlib.sha256(data).hexdigest())
    span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    return pa.record_batch(
        [batch.column(0), pa.array(kept, pa.string()), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
         pa.array(spans, span), pa.array(digests, pa.string())],
        names=["row", "kept", "n_bytes", "n_removed", "spans", "kept_sha256"])


def repeated_passages(docs: DataFrame, length: int = 100) -> DataFrame:
    """One row for each row of `docs`, with the repeated bytes of its text removed.

    A byte is repeated when a string of `length` bytes over it also starts earlier: in a document
    with a smaller doc_id or earlier in the same one. Columns: row (a struct of all columns of
    `docs` but the text, whatever their names), kept (the text left; parts of characters cut at
    the edges are left out), n_bytes, n_removed, spans (maximal runs of repeated bytes,
    [first, last) in bytes), kept_sha256 (of the bytes left). Null and empty texts and those below
    `length` have nothing repeated; a null text is kept as an empty one. A null doc_id counts as
    the largest. Rows that repeat a doc_id are one document: neither start is earlier than the same
    start of the other.
    """
    if not GRAM < length <= 127 + 1:
        raise ValueError(f"length must be over {GRAM} and at most 128")
    spark = docs.sparkSession
    shelf = Shelf(spark, "suffixes")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce("text", F.lit(""))
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    # A text is known by all 64 bits of a hash of its document and itself; rows equal in both are one.
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    texts = docs.select(
        doc.alias("doc"), F.xxhash64(doc, text).alias("key"), others.alias("row"), text.alias("text"))
    found = texts.select("key", "text").mapInArrow(_find(length), "gram long, key long, packed long, kind byte")
    deal = F.when(F.col("kind") == _KNOWN, F.xxhash64("key", "packed")).otherwise(F.col("gram"))
    repeated = shelf.keep(
        found.repartition(tasks, deal).sortWithinPartitions("gram")
        .mapInArrow(_repeated, "gram long, key long, packed long"), "repeated")
    hot = shelf.keep(repeated.groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") > HOT_ROWS).select(
        "gram", F.lit(True).alias("hot")), "hot")
    if hot.count() <= BROADCAST_GRAMS:
        hot = F.broadcast(hot)
    total = repeated.count()
    parts = max(tasks, -(-total // RANGE_ROWS))
    splitters = _splitters(texts, repeated, parts, total)
    by_text = (
        repeated.join(hot, "gram", "left").groupBy("key")
        .agg(F.collect_list(F.struct("packed", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("anchors")))
    runs = texts.select("doc", "key", "text").mapInArrow(squeeze, "doc long, key long, text binary") \
        .join(by_text, "key").select("doc", "key", "text", "anchors").mapInArrow(
        _runs(length, splitters),
        "part int, shared binary, rest_size binary, rest binary, left_size binary, left binary, doc binary, key binary, packed binary")
    covered = shelf.keep(
        runs.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_combine(length), _COVER)
        .groupBy("key").agg(F.collect_set(F.struct("first", (F.col("last") + length).alias("last"))).alias("stretches")),
        "covered")
    shelf.drop("repeated")
    kind = "row " + texts.schema["row"].dataType.simpleString()
    rows = texts.mapInArrow(squeeze, f"doc long, key long, {kind}, text binary").join(covered, "key", "left")
    return rows.select("row", "text", "stretches").mapInArrow(
        _remove, f"{kind}, kept string, n_bytes long, n_removed long, "
        "spans array<struct<first: bigint, last: bigint>>, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """`docs` with `text` reduced to what `repeated_passages` keeps, and `n_chars`, if there, counted
    again. All rows and columns stay; a null text becomes an empty one."""
    found = repeated_passages(docs, length)
    counted = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return found.select(*[
        counted.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
