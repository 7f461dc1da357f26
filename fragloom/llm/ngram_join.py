"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersection of sorted arrays.

Each text becomes the sorted array of its distinct word-shingle hashes (64 bits). Equal sets are
one class. A pair of classes can only reach the similarity if both prefixes, in one global order
of shingles, have a shingle in common, so documents meet in tiles: all classes with one prefix
shingle, ordered by set size and cut to the band of sizes that can still reach the similarity.
Inside a tile parity bitmaps are compared: the number of differing bits is never more than the
number of shingles in only one of the two sets, which bounds the overlap from above. Pairs that
pass are verified by intersecting the arrays themselves.

The order puts frequent shingles last. Which ones count as frequent changes the work only, not
the result: any order that all documents share is right.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components
from .shelf import Shelf
from .words import gathered, giving_back, mix, released, shingle_sets, squeeze, unsqueezed

#: Documents are counted in parts of about so many shingles; shingles this often in a part take
#: part in the count of frequent ones.
COUNTED_SHINGLES, FREQUENT_IN_PART = 1_000_000, 8
#: The order knows at most so many frequent shingles; the rest are ordered by hash.
FREQUENT_KNOWN = 1 << 17
#: At first each row of a tile is held against so many rows before it, for its best pair; the other
#: pairs are met later, where both ends are not yet in one component.
LOOK_BACK = 512
#: Tiles up to this many rows give all their pairs at once.
SMALL_TILE = 64
#: Tiles with more rows are cut.
TILE_ROWS = 20_000
#: Bytes of bitmaps that are compared at once.
PAIR_BYTES = 1 << 20
#: Pairs whose texts are opened at once.
VERIFIED_PAIRS = 50
#: Ids of texts to verify are broadcast up to this count (16 bytes each), else joined by shuffle.
BROADCAST_IDS = 200_000


def bits_for(n):
    """Width of the bitmap of a set of n shingles: a power of two, at least 128."""
    return 1 << max(7, int(n - 1).bit_length()) if n > 1 else 128


def signature(hashes: np.ndarray) -> np.ndarray:
    """Parity bitmap: bit i tells if an odd number of hashes fall on i."""
    width = bits_for(len(hashes))
    odd = np.bincount((mix(hashes) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def prefix_length(n, threshold):
    part, whole = threshold
    return n - -(-part * n // whole) + 1


def _frequent(k):
    def count(batches):
        held, size = [], 0

        def flush():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            often = counts >= FREQUENT_IN_PART
            return pa.record_batch(
                [pa.array(values[often].view(np.int64)), pa.array(counts[often])], names=["shingle", "n"])

        for batch in batches:
            for s in shingle_sets(batch.column(0), k):
                held.append(s)
                size += len(s)
                if size > COUNTED_SHINGLES:
                    yield flush()
                    size = 0
        if held:
            yield flush()
    return giving_back(count)


def frequent_shingles(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles over all documents with the binary logarithm of their counts."""
    rows = (
        docs.select("text").mapInArrow(_frequent(k), "shingle long, n long")
        .groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(FREQUENT_KNOWN)
        .select("shingle", F.floor(F.log2("n")).cast("int").alias("level")).toArrow())
    shingles = rows["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    released()
    return shingles[order], rows["level"].to_numpy()[order]


def _sketch(k, threshold, frequent):
    def sketch(batches):
        known, level = frequent.value
        for batch in batches:
            n, mark, other, bitmaps, prefixes = [], [], [], [], []
            for s in shingle_sets(batch.column(1), k):
                n.append(len(s))
                mark.append(int(np.bitwise_xor.reduce(mix(s))) if len(s) else 0)
                other.append(int(mix(s + np.uint64(1)).sum(dtype=np.uint64)) if len(s) else 0)
                bitmaps.append(signature(s).tobytes())
                if len(s) and len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    rank = np.where(known[at] == s, level[at], 0)
                    s = s[np.argsort(rank, kind="stable")]
                prefixes.append(s[: prefix_length(len(s), threshold)].view(np.int64) if len(s) else s.view(np.int64))
            sizes = [len(p) for p in prefixes]
            yield pa.record_batch([
                batch.column(0), pa.array(n, pa.int64()),
                pa.array(np.array(mark, np.uint64).view(np.int64)), pa.array(np.array(other, np.uint64).view(np.int64)),
                pa.array(bitmaps, pa.binary()),
                pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *sizes]), pa.int32()),
                    pa.array(np.concatenate([*prefixes, np.zeros(0, np.int64)])))],
                names=["doc_id", "n", "mark", "other", "bitmap", "prefix"])
    return giving_back(sketch)


class _Bitmaps:
    """Bitmaps of a batch, read from the buffers of a binary column."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        self.bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
        self.data = np.frombuffer(column.buffers()[2], np.uint8)
        self.width = np.diff(self.bounds)

    def rows(self, at: np.ndarray, width: int) -> np.ndarray:
        """Bitmaps as the given number of bytes would hold them, as 8-byte words."""
        out = np.empty((len(at), width), np.uint8)
        stored = self.width[at]
        for own in np.unique(stored).tolist():
            some = np.flatnonzero(stored == own)
            whole = self.data[self.bounds[at[some]][:, None] + np.arange(own)]
            out[some] = np.bitwise_xor.reduce(whole.reshape(len(some), own // width, width), axis=1)
        return out.view(np.uint64)

    def differing(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of differing bits of pairs of rows, each at the smaller of both widths."""
        bits = np.zeros(len(x), np.int64)
        widths = np.minimum(self.width[x], self.width[y])
        for width in np.unique(widths).tolist():
            of = np.flatnonzero(widths == width)
            for first in range(0, len(of), max(1, PAIR_BYTES // width)):
                some = of[first: first + max(1, PAIR_BYTES // width)]
                bits[some] = np.bitwise_count(self.rows(x[some], width) ^ self.rows(y[some], width)).sum(1)
        return bits


def _passing(n, bitmaps, x, y, threshold):
    """Which pairs of rows can reach the similarity, by their sizes and bits; and the bits."""
    part, whole = threshold
    fits = np.flatnonzero(whole * np.minimum(n[x], n[y]) >= part * np.maximum(n[x], n[y]))
    x, y = x[fits], y[fits]
    bits = bitmaps.differing(x, y)
    total = n[x] + n[y]
    overlap = (total - bits) // 2
    able = whole * overlap >= part * (total - overlap)
    return x[able], y[able], bits[able]


def _candidates(token, n, root, threshold):
    """Yields pairs of rows of one tile that fit by size; rows are sorted by tile and size.

    Pairs are made lag by lag for all tiles of the batch at once. Without roots a row looks back
    LOOK_BACK rows of its tile at most; with roots it meets every row of another root.
    """
    part, whole = threshold
    begin = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    tile_begin = np.repeat(begin, np.diff(np.append(begin, len(token))))
    # The first row of the tile that is large enough, found by bisection for all rows together.
    low, high = tile_begin.copy(), np.arange(len(token))
    while (low < high).any():
        middle = (low + high) // 2
        small = whole * n[middle] < part * n
        low, high = np.where(small & (low < high), middle + 1, low), np.where(~small & (low < high), middle, high)
    live, lag = np.arange(len(token)), 1
    while True:
        live = live[live - lag >= low[live]]
        if not len(live) or root is None and lag > LOOK_BACK:
            return
        other = live - lag
        apart = slice(None) if root is None else root[live] != root[other]
        yield live[apart], other[apart]
        lag += 1


def _whole_tiles(batches):
    """Tables of whole tiles, from rows sorted by tile."""
    rest = None
    for table in gathered(batches):
        rest = pa.concat_tables([rest, table]) if rest is not None else table
        token = rest["token"].to_numpy()
        cut = int(np.searchsorted(token, token[-1])) if len(token) else 0
        if cut:
            yield rest.slice(0, cut).combine_chunks()
            rest = rest.slice(cut).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def _pairs(threshold, with_root, best):
    """Pairs that pass the bound, x the larger row, with the number of differing bits; with roots
    only those of different roots. `best`: of large tiles the best earlier row of each row.
    """
    def pairs(batches):
        for table in _whole_tiles(batches):
            token, n, doc = (table[c].to_numpy() for c in ("token", "n", "doc_id"))
            root = table["root"].to_numpy() if with_root else None
            bitmaps = _Bitmaps(table["bitmap"].combine_chunks() if table["bitmap"].num_chunks != 1 else table["bitmap"].chunk(0))
            names, number = np.unique(doc, return_inverse=True)
            begin = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            rows = np.diff(np.append(begin, len(token)))
            large = np.repeat(rows > SMALL_TILE, rows) & best
            held, count = [], 0

            def flush():
                """Each pair of documents once, whatever tiles it comes from."""
                x, y = (np.concatenate(c) for c in zip(*held))
                held.clear()
                key = 2 * (number[x] * len(names) + number[y]) + large[x]
                _, once = np.unique(key, return_index=True)
                x, y, bits = _passing(n, bitmaps, x[once], y[once], threshold)
                order = np.lexsort((bits, number[x], large[x]))
                x, y, bits = x[order], y[order], bits[order]
                stay = ~large[x] | np.append(True, np.diff(number[x]) != 0)[: len(x)] | np.append(True, np.diff(large[x]))[: len(x)]
                return pa.record_batch(
                    [pa.array(c[stay]) for c in (doc[x], doc[y], bits)], names=["x", "y", "bits"])

            for x, y in _candidates(token, n, root, threshold):
                differ = doc[x] != doc[y]
                held.append((x[differ], y[differ]))
                count += len(x)
                if count > 500_000:
                    yield flush()
                    count = 0
            if held:
                yield flush()
    return giving_back(pairs)


def _verify(k, threshold):
    part, whole = threshold

    def verify(batches):
        for batch in batches:
            same = []
            for first in range(0, batch.num_rows, VERIFIED_PAIRS):
                rows = batch.slice(first, VERIFIED_PAIRS)
                texts = [unsqueezed(t) for pair in zip(rows.column(2).to_pylist(), rows.column(3).to_pylist()) for t in pair]
                sets = shingle_sets(pa.array(texts, pa.binary()).cast(pa.string()), k)
                for a, b in zip(sets, sets):
                    if len(a) > len(b):
                        a, b = b, a
                    at = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
                    overlap = int((b[at] == a).sum()) if len(a) else 0
                    same.append(overlap > 0 and whole * overlap >= part * (len(a) + len(b) - overlap))
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["x", "y"]).filter(pa.array(same, pa.bool_()))
    return giving_back(verify)


def jaccard_join(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id, component_id, kept.

    Documents link when the Jaccard similarity of their sets of k-word shingles is at least
    threshold[0] / threshold[1]. class_id is the smallest id with the same set, component_id the
    smallest id reachable by links; kept is true for that document. A text with fewer words than
    k has its whole word sequence as one shingle; null, empty and blank texts have none, link with
    nothing and are kept. A null doc_id links with nothing: its component is null and it is kept.
    Rows that repeat a doc_id are one vertex; each is returned. Other columns are ignored.
    """
    spark = docs.sparkSession
    shelf = Shelf(spark, "ngram-join")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, k))
    sets = shelf.keep(docs.mapInArrow(
        _sketch(k, threshold, frequent),
        "doc_id long, n long, mark long, other long, bitmap binary, prefix array<long>")
        .withColumn("row", F.monotonically_increasing_id()), "sets")
    usable = sets.filter("n > 0 AND doc_id IS NOT NULL")
    same = ["n", "mark", "other"]
    # One row leads each class, however many rows repeat its doc_id.
    entries = usable.groupBy("doc_id", *same).agg(F.min("row").alias("row"))
    classes = shelf.keep(
        entries.groupBy(*same).agg(F.min(F.struct("doc_id", "row")).alias("least"))
        .select(*same, F.col("least.doc_id").alias("class_id"), F.col("least.row").alias("row")), "classes")
    leaders = usable.join(classes.select("row"), "row", "left_semi")
    repeats = not usable.groupBy("doc_id").count().filter("count > 1").isEmpty()
    in_order = ["token", "n", "doc_id"]
    multi = shelf.keep(
        leaders.select(F.explode("prefix").alias("token"), "n", "doc_id", "mark")
        .repartition(tasks, "token").sortWithinPartitions(*in_order)
        .mapInArrow(_shared(threshold), "token long, n long, doc_id long, mark long"), "multi")
    bitmaps = leaders.select("doc_id", "mark", "bitmap")

    # Tiles that are too large for one task are cut into parts by document; later, when every pair
    # must be met, each two parts have a tile of their own.
    sizes = shelf.keep(
        multi.groupBy("token").agg(F.count("*").alias("rows")).filter(F.col("rows") > SMALL_TILE)
        .select("token", F.ceil(F.col("rows") / TILE_ROWS).alias("parts")), "sizes")

    def tiled(rows, every):
        own = F.pmod(F.xxhash64("doc_id"), F.col("parts"))
        cut = rows.join(sizes.filter("parts > 1"), "token").withColumn("own", own).withColumn(
            "other", F.explode(F.expr("sequence(0L, parts - 1)")) if every else F.col("own"))
        cut = cut.withColumn("token", F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other")))
        whole = rows.join(sizes.filter("parts > 1"), "token", "left_anti")
        return whole.select(*rows.columns).union(cut.select(*rows.columns))

    def met(rows, columns, with_root, best):
        return (
            rows.join(bitmaps, ["doc_id", "mark"]).select(*in_order, "bitmap", *columns)
            .repartition(tasks, "token").sortWithinPartitions(*in_order)
            .mapInArrow(_pairs(threshold, with_root, best), "x long, y long, bits long")
            .groupBy("x", "y").agg(F.min("bits").alias("bits")))

    passing = shelf.keep(met(tiled(multi, False), [], False, True), "passing")
    first = shelf.keep(passing.groupBy("x").agg(F.min_by("y", F.struct("bits", "y")).alias("y")), "first")
    linked = shelf.keep(_linked(docs, first, k, threshold, repeats), "linked")
    roots = shelf.keep(components(linked, shelf, "early"), "roots")

    def rooted(rows, column, name, roots):
        known = roots.select(F.col("vertex").alias(column), F.col("root").alias("_root"))
        return rows.join(known, column, "left").withColumn(name, F.coalesce("_root", column)).drop("_root")

    # In large tiles the best partner in another component comes next: it joins most of what
    # belongs together with one more pair for each document.
    large = shelf.keep(multi.join(sizes, "token", "left_semi"), "large")
    closest = shelf.keep(
        met(tiled(rooted(large, "doc_id", "root", roots), True), ["root"], True, True)
        .groupBy("x").agg(F.min_by("y", F.struct("bits", "y")).alias("y"))
        .join(first, ["x", "y"], "left_anti"), "closest")
    if not closest.isEmpty():
        first = first.union(closest)
        linked = shelf.keep(linked.union(_linked(docs, closest, k, threshold, repeats)), "linked-2")
        roots = shelf.keep(components(linked, shelf, "middle"), "roots-2")

    # What is left: pairs between different components, untested so far.
    apart = rooted(rooted(passing, "x", "a", roots), "y", "b", roots).filter("a <> b").select("x", "y")
    second = shelf.keep(
        apart.union(met(tiled(rooted(large, "doc_id", "root", roots), True), ["root"], True, False).select("x", "y")).distinct()
        .join(first, ["x", "y"], "left_anti"), "second")
    more = shelf.keep(_linked(docs, second, k, threshold, repeats), "more")
    final = components(linked.union(more), shelf, "final") if not more.isEmpty() else roots
    shelf.drop("multi", "large", "passing", "first", "closest", "second")

    known = classes.drop("row").join(final.withColumnRenamed("vertex", "class_id"), "class_id", "left").select(
        *same, "class_id", F.coalesce("root", "class_id").alias("component_id"))
    rows = sets.select("doc_id", *same).withColumn("usable", F.expr("n > 0 AND doc_id IS NOT NULL"))
    out = rows.filter("usable").join(known, same).select("doc_id", "n", "class_id", "component_id").union(
        rows.filter("NOT usable").select("doc_id", "n", "doc_id", "doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), "class_id", "component_id",
        F.expr("doc_id <=> component_id").alias("kept"))


def _shared(threshold):
    """Of rows sorted by token and size, those that could reach the similarity with a row next to
    them; a row that cannot with either neighbour cannot with any row of its tile."""
    part, whole = threshold

    def shared(batches):
        held, known = None, False  # the last row, and whether it fits the row before it
        for table in gathered(batches):
            table = pa.concat_tables([held, table]) if held is not None else table
            token, n = table["token"].to_numpy(), table["n"].to_numpy()
            fits = (token[1:] == token[:-1]) & (whole * n[:-1] >= part * n[1:])
            several = np.append(known, fits) | np.append(fits, False)
            yield from table.slice(0, len(token) - 1).filter(pa.array(several[:-1])).combine_chunks().to_batches()
            held, known = table.slice(len(token) - 1).combine_chunks(), bool(several[-1])
        if held is not None and known:
            yield from held.to_batches()
    return giving_back(shared)


def _linked(docs, pairs, k, threshold, repeats):
    """Those of the pairs whose arrays have the overlap that is asked for. `repeats`: some doc_ids
    have several rows; their equal texts are opened once."""
    wanted = pairs.select(F.col("x").alias("doc_id")).union(pairs.select("y")).distinct()
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, "doc_id", "left_semi").select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .mapInArrow(squeeze, "doc_id long, text binary")
    if repeats:
        texts = texts.dropDuplicates(["doc_id", "text"])
    left = texts.select(F.col("doc_id").alias("x"), F.col("text").alias("left"))
    right = texts.select(F.col("doc_id").alias("y"), F.col("text").alias("right"))
    return pairs.join(left, "x").join(right, "y").select("x", "y", "left", "right").mapInArrow(
        _verify(k, threshold), "x long, y long")


def remove_near_copies(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """The documents without those that `jaccard_join` finds to be copies of one with a smaller id.

    Rows that repeat a doc_id stay where their sets of shingles differ; of those with one set (or
    with none and one text) the first by all columns stays. Rows with a null doc_id all stay.
    Columns are kept.
    """
    found = jaccard_join(docs, k, threshold)
    removed = found.filter("NOT kept").select("doc_id").distinct()
    left = docs.join(removed, "doc_id", "left_anti").select(*docs.columns)
    several = left.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if several.isEmpty():
        return left
    repeated = left.join(several, "doc_id", "left_semi")
    rows = repeated.withColumn("_all", F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    named = rows.select("_all", F.coalesce("text", F.lit("")).alias("_text")).mapInArrow(
        _named_sets(k), "_all " + rows.schema["_all"].dataType.simpleString() + ", _name binary")
    first = named.groupBy(F.col("_all.doc_id"), "_name").agg(F.min("_all").alias("_all")).select("_all.*")
    return left.join(several, "doc_id", "left_anti").select(*docs.columns).union(first)


def _named_sets(k):
    """A digest of the set of shingles of each text, or of a text without any."""
    def named(batches):
        for batch in batches:
            names = [
                hashlib.sha256(s.tobytes() if len(s) else b"text " + (text or "").encode()).digest()
                for s, text in zip(shingle_sets(batch.column(1), k), batch.column(1).to_pylist())]
            yield pa.record_batch([batch.column(0), pa.array(names, pa.binary())], names=["_all", "_name"])
    return giving_back(named)
