"""Genomic bins, GC annotation and dense fragment counts per sample and bin."""

from pyspark.sql import DataFrame, Window, functions as F

from fragloom.functions import chrom as chrom_fn, measures as m
from fragloom.operators.intervals import overlap_join
from fragloom.operators.joins import lookup_join, product_rows
from fragloom.params import DEFAULTS, Params
from fragloom.schemas import BIN_COUNT_COLUMNS

#: Bases in a tile of places.
TILE = 1 << 11


def make_bins(sizes: DataFrame, bin_size: int, autosomes_only: bool = True) -> DataFrame:
    """Tiles of `bin_size` per contig; a last partial tile stays from half the size on."""
    contigs = sizes.filter(F.col("size") > 0)
    if autosomes_only:
        contigs = contigs.filter(chrom_fn.is_autosome(F.col("chrom")))
    step = F.lit(bin_size).cast("long")
    end = F.least(F.col("start") + step, F.col("size"))
    return (
        contigs.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, step)))
        .withColumn("end", end)
        .filter(F.col("end") - F.col("start") >= bin_size * 0.5)
        .select("chrom", "start", "end", tile_id().alias("bin_id"))
    )


def tile_id():
    """`chrom:start-end`."""
    return F.concat("chrom", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"))


def annotate_gc(bins: DataFrame, reference: DataFrame | None = None,
                bin_size: int | None = None) -> DataFrame:
    """Add gc_content and effective_bin_size.

    `reference` holds chunks (chrom, start, end, seq) with `seq` from start on, possibly
    longer than the chunk. Bases are counted per chunk and bin, then summed, so a bin
    never needs its whole sequence in one place. Without a reference, or when some bin
    has no sequence at all, every bin gets 0.5.
    """
    sized = bins.withColumn("effective_bin_size", F.col("end") - F.col("start"))
    if reference is None:
        return _ordered_bins(sized.withColumn("gc_content", F.lit(0.5)))
    chunks = reference.select("chrom", "start", "end", "seq")
    if bin_size:
        step = F.lit(bin_size).cast("long")
        tile = F.sequence(m.long_div(F.col("start"), bin_size) * step,
                          m.long_div(F.col("end") - 1, bin_size) * step, step)
        pieces = chunks.withColumn("r_start", F.explode(tile)).withColumn("r_end", F.col("r_start") + step)
        keys = ["chrom", "start"]
    else:
        spans = bins.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end")).distinct()
        pieces = overlap_join(chunks, spans)
        keys = ["chrom", "start", "end"]
    low, high = F.greatest("start", "r_start"), F.least("end", "r_end")
    piece = F.upper(F.substring("seq", low - F.col("start") + 1, high - low))
    kept = F.length(piece)
    counted = (
        pieces.select("chrom", F.col("r_start").alias("start"), F.col("r_end").alias("end"),
                      (kept - F.length(F.translate(piece, "GC", ""))).alias("gc"),
                      (kept - F.length(F.translate(piece, "ACGT", ""))).alias("acgt"))
        .groupBy(*keys).agg(F.sum("gc").alias("gc"), F.sum("acgt").alias("acgt"))
    )
    joined = sized.join(counted, keys, "left")
    uncovered = joined.agg(m.count_where(F.col("acgt").isNull()).alias("n")).scalar()
    gc = F.when(uncovered > 0, 0.5).otherwise(m.share(F.col("gc"), F.col("acgt")))
    return _ordered_bins(joined.withColumn("gc_content", gc))


def _ordered_bins(bins: DataFrame) -> DataFrame:
    return bins.select("chrom", "start", "end", "bin_id", "gc_content", "effective_bin_size")


def _hits_on_tiles(fragments: DataFrame, bin_size: int) -> DataFrame:
    """One row per fragment and tile it touches; the tile follows from the coordinates."""
    step = F.lit(bin_size).cast("long")
    first = m.long_div(F.col("start"), bin_size) * step
    last = m.long_div(F.col("end") - 1, bin_size) * step
    return (
        fragments.select("sample_id", "chrom", "length", first.alias("_first"), last.alias("_last"))
        .filter(F.col("_last") >= F.col("_first"))
        .select("sample_id", "chrom", "length",
                F.explode(F.sequence("_first", "_last", step)).alias("start"))
    )


def _hits_on_intervals(fragments: DataFrame, bins: DataFrame) -> DataFrame:
    """The same for bins of any shape, with the bucketed overlap join."""
    spans = bins.select(
        "chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end")).distinct()
    rows = fragments.select("sample_id", "chrom", "start", "end", "length")
    return overlap_join(rows, spans).select(
        "sample_id", "chrom", "length", F.col("r_start").alias("start"), F.col("r_end").alias("end"))


def _counts_on_intervals(fragments: DataFrame, bins: DataFrame) -> DataFrame:
    """(sample_id, chrom, start, end, n) of the intervals that fragments touch, without a row per hit.

    The fragments that touch an interval are those that start before its end, less those that end
    at or before its start. Starts and ends are counted by place and kept by tile, with the counts
    of all tiles before; each bound of an interval meets the one tile it lies in, once per sample.
    So work grows with fragments and with intervals x samples, not with hits. A tile holds at most
    `TILE` places, whatever the number of fragments there.
    """
    tile = lambda c: m.long_div(F.col(c), TILE)
    spans = bins.select("chrom", "start", "end").filter(F.col("start") < F.col("end")).distinct()
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    bounds = spans.withColumn("b", F.explode(F.array(
        F.struct((F.col("end") - 1).alias("at"), F.lit(True).alias("upper")),
        F.struct(F.col("start").alias("at"), F.lit(False).alias("upper")),
    ))).select("chrom", "start", "end", "b.*").withColumn("tile", tile("at"))
    places = (
        fragments.filter(F.col("end") >= F.col("start"))
        .select("sample_id", "chrom", F.explode(F.array(
            F.struct(F.col("start").alias("at"), one.alias("starts"), zero.alias("ends")),
            F.struct(F.col("end").alias("at"), zero.alias("starts"), one.alias("ends")))).alias("p"))
        .groupBy("sample_id", "chrom", F.col("p.at").alias("at"))
        .agg(F.sum("p.starts").alias("starts"), F.sum("p.ends").alias("ends"))
    )
    keys = ["sample_id", "chrom", "tile"]
    held = places.withColumn("tile", tile("at")).groupBy(*keys).agg(
        F.sum("starts").alias("all_starts"), F.sum("ends").alias("all_ends"),
        F.collect_list(F.struct("at", "starts", "ends")).alias("places"))
    # Tiles that a bound lies in count too where a sample has nothing there.
    asked = lookup_join(
        bounds.select("chrom", "tile").distinct(), fragments.select("sample_id", "chrom").distinct(), ["chrom"],
        max_bytes=0, grows=True)
    tiles = held.unionByName(asked, allowMissingColumns=True).groupBy(*keys).agg(
        F.sum(F.coalesce("all_starts", zero)).alias("all_starts"), F.sum(F.coalesce("all_ends", zero)).alias("all_ends"),
        F.flatten(F.collect_list("places")).alias("places"))
    # One row for each tile of a contig, a number set by the genome.
    before = Window.partitionBy("sample_id", "chrom").orderBy("tile").rowsBetween(Window.unboundedPreceding, -1)
    tiles = tiles.withColumns({
        "starts_before": F.coalesce(F.sum("all_starts").over(before), zero),
        "ends_before": F.coalesce(F.sum("all_ends").over(before), zero),
    }).drop("all_starts", "all_ends")

    def until(count):
        upto = F.aggregate("places", zero, lambda total, p: total + F.when(p["at"] <= F.col("at"), p[count]).otherwise(zero))
        return F.col(f"{count}_before") + upto

    met = lookup_join(tiles, bounds, ["chrom", "tile"], max_bytes=0, grows=True)
    part = F.when(F.col("upper"), until("starts")).otherwise(-until("ends"))
    return (
        met.select("sample_id", "chrom", "start", "end", part.alias("n"))
        .groupBy("sample_id", "chrom", "start", "end").agg(F.sum("n").alias("n")).filter(F.col("n") > 0)
    )


def fragment_hits(fragments: DataFrame, bins: DataFrame, bin_size: int | None = None, lengths: bool = True) -> DataFrame:
    """One row per fragment and bin it touches. Without `lengths` the hits of each sample on bins of
    any shape come counted, as `n`: no row is made per hit."""
    if bin_size:
        return _hits_on_tiles(fragments, bin_size)
    return _hits_on_intervals(fragments, bins) if lengths else _counts_on_intervals(fragments, bins)


def length_counts(hits: DataFrame, keys) -> DataFrame:
    """Fragments per sample, bin and length: a plain hash aggregate with map-side
    combine, after which no group has more rows than there are lengths."""
    return hits.groupBy(*keys, "length").agg(F.count(F.lit(1)).alias("n"))


def bin_statistics(rows: DataFrame, keys, carried=(), params: Params = DEFAULTS) -> DataFrame:
    """Statistics of each bin from (length, n) rows; a row without n only names its bin.

    The median follows from running counts over the lengths of a bin, at most histogram_max + 1
    once they are clipped. Windows and aggregate share one shuffle by bin.
    """
    length = F.col("length")
    place = Window.partitionBy(*keys)
    until = F.sum("n").over(place.orderBy("_clipped").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumns({
        "n": F.coalesce("n", F.lit(0)),
        "_clipped": F.least(F.greatest(length, F.lit(0)), F.lit(params.histogram_max))})
    rows = rows.withColumns({"_until": until, "_all": F.sum("n").over(place)})

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    def at(rank):
        return F.max(F.when((rank >= F.col("_until") - F.col("n")) & (rank < F.col("_until")), F.col("_clipped")))

    below = F.floor((F.col("_all") - 1) / 2)
    return rows.groupBy(*keys).agg(
        F.sum("n").alias("n_total_fragments"),
        total(m.is_short(length, params)).alias("n_short_100_150"),
        total(m.is_long(length, params)).alias("n_long_151_220"),
        F.sum(length * F.col("n")).alias("length_sum"),
        ((at(below) + at(F.floor(F.col("_all") / 2))) / 2).alias("median_fragment_length"),
        *[F.max(c).alias(c) for c in carried])


def bin_counts(fragments: DataFrame, bin_size: int, params: Params = DEFAULTS) -> DataFrame:
    """Counts and length statistics of the touched tiles only, one row per sample and tile."""
    keys = ["sample_id", "chrom", "start"]
    return bin_statistics(length_counts(_hits_on_tiles(fragments, bin_size), keys), keys, (), params)


def tiled_fragments(fragments: DataFrame, bin_size: int) -> DataFrame:
    """One row per fragment and tile it touches, with the start of the tile as `tile`; `owner` marks
    the row of the tile in which the fragment starts, so each fragment has one such row."""
    step = F.lit(bin_size).cast("long")
    first = m.long_div(F.col("start"), bin_size) * step
    last = m.long_div(F.greatest(F.col("end") - 1, F.col("start")), bin_size) * step
    tiles = F.explode(F.sequence(first, last, step))
    return fragments.withColumn("tile", tiles).withColumn("owner", F.col("tile") == first)


def tiled_bin_counts(tiled: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """`bin_counts` of a table of `tiled_fragments`. On a table written by
    `writers.write_tiled_fragments` nothing is shuffled: buckets hold whole tiles."""
    keys = ["sample_id", "chrom", "tile"]
    rows = tiled.filter(F.col("end") > F.col("start"))
    return bin_statistics(length_counts(rows.select(*keys, "length"), keys), keys, (), params).withColumnRenamed("tile", "start")


def dense_bin_counts(fragments: DataFrame, bins: DataFrame, samples: DataFrame,
                     bin_size: int | None = None, params: Params = DEFAULTS) -> DataFrame:
    """All 16 count columns for every sample and bin, zeros where nothing falls.

    `bins` comes from `annotate_gc`. `bin_size` says that bins are tiles of that size from
    `make_bins`, then a fragment finds its bins by arithmetic and no join touches the
    fragments.
    Fragments are first reduced to counts per length. Grid rows then enter the same
    aggregate as the counts, which fills zeros and drops fragments outside the bins
    without a join.
    """
    grid = product_rows(
        samples.select("sample_id"),
        bins.select("chrom", "start", "end", "bin_id", "gc_content", "effective_bin_size"),
    )
    # A tile is named by its place, so no text travels through the aggregate.
    keys = ["sample_id", "chrom", "start"] if bin_size else ["sample_id", "chrom", "start", "end"]
    carried = ["end", "gc_content", "effective_bin_size"] if bin_size else [
        "bin_id", "gc_content", "effective_bin_size"]
    hits = length_counts(fragment_hits(fragments, bins, bin_size), keys)
    rows = grid.select(*keys, *carried).unionByName(hits, allowMissingColumns=True)
    counted = bin_statistics(rows, keys, carried, params).filter(F.col("effective_bin_size").isNotNull())
    if bin_size:
        counted = counted.withColumn("bin_id", tile_id())
    size = F.greatest("effective_bin_size", F.lit(1))
    total, short, long = (F.col(c) for c in ("n_total_fragments", "n_short_100_150", "n_long_151_220"))
    return counted.select(
        "sample_id", "chrom", "start", "end", "bin_id",
        "n_total_fragments", "n_short_100_150", "n_long_151_220",
        m.ratio(short, long).alias("short_long_ratio"),
        F.coalesce(m.share(F.col("length_sum"), total), F.lit(0.0)).alias("mean_fragment_length"),
        F.coalesce("median_fragment_length", F.lit(0.0)).alias("median_fragment_length"),
        (total / size).alias("coverage_total"),
        (short / size).alias("coverage_short"),
        (long / size).alias("coverage_long"),
        "gc_content", "effective_bin_size",
    ).select(*BIN_COUNT_COLUMNS)


def unbinned_fragments(fragments: DataFrame, bins: DataFrame) -> DataFrame:
    """Fragments per sample on contigs that have no bin; counted before the anti join."""
    per_contig = fragments.groupBy("sample_id", "chrom").agg(F.count(F.lit(1)).alias("n_fragments"))
    return per_contig.join(bins.select("chrom").distinct(), "chrom", "left_anti").select(
        "sample_id", "chrom", "n_fragments")
