"""Features of arms, contigs, mitochondria, end motifs and protection windows."""

from pyspark.sql import DataFrame, Window, functions as F

from fragloom.functions import chrom as chrom_fn, measures as m
from fragloom.operators.intervals import NARROW_WIDTHS, overlap_join
from fragloom.operators.joins import lookup_join, product_rows, top_rows_per_group
from fragloom.params import DEFAULTS, Params

DEPTH = "coverage_total_gc_corrected"


def arm_features(corrected: DataFrame, arms: DataFrame, samples: DataFrame, bins: DataFrame | None = None) -> DataFrame:
    """Mean corrected depth of the bins that overlap each arm, 0.0 without bins.

    A bin over two arms counts in both. z is a placeholder of 0.0. `bins` names the bins of
    `corrected`; without it they are taken from the table itself.
    """
    place = ["chrom", "start", "end"]
    spans = arms.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"), "arm")
    # Bins are the same in all samples: overlaps are found once per bin, samples join by equality.
    arms_of_bin = overlap_join(
        bins.select(*place) if bins is not None else corrected.select(*place).distinct(), spans).select(*place, "arm")
    hits = lookup_join(corrected.select("sample_id", *place, F.col(DEPTH).alias("depth")), arms_of_bin, place).select(
        "sample_id", "arm", "depth")
    grid = product_rows(samples.select("sample_id"), arms.select("arm").distinct())
    named = F.regexp_replace("arm", "chr", "arm_chr")
    return (
        hits.unionByName(grid, allowMissingColumns=True)
        .groupBy("sample_id", "arm").agg(F.coalesce(F.avg("depth"), F.lit(0.0)).alias("depth"))
        .select("sample_id", named.alias("arm"), "depth", F.lit(0.0).alias("z"))
    )


def chrom_features(corrected: DataFrame) -> DataFrame:
    """The same per contig, for use without an arms table."""
    return (
        corrected.groupBy("sample_id", "chrom").agg(F.avg(DEPTH).alias("depth"))
        .select("sample_id", F.concat(F.lit("arm_"), "chrom").alias("arm"), "depth",
                F.lit(0.0).alias("z"))
    )


def aneuploidy_score(arm_table: DataFrame) -> DataFrame:
    """Mean absolute z over the arms of a sample."""
    return arm_table.groupBy("sample_id").agg(
        F.coalesce(F.avg(F.abs("z")), F.lit(0.0)).alias("plasma_aneuploidy_score"))


def arm_panel(arm_table: DataFrame) -> DataFrame:
    """Mean and sample sd of depth per arm over a healthy reference panel."""
    return arm_table.groupBy("arm").agg(
        F.avg("depth").alias("panel_mean"), F.stddev_samp("depth").alias("panel_sd"))


def with_panel_z(arm_table: DataFrame, panel: DataFrame) -> DataFrame:
    """Opt-in z against a reference panel; 0.0 where the panel has no spread."""
    z = F.when(F.col("panel_sd") > 0, (F.col("depth") - F.col("panel_mean")) / F.col("panel_sd"))
    return (
        lookup_join(arm_table.drop("z"), panel, ["arm"], "left")
        .select("sample_id", "arm", "depth", F.coalesce(z, F.lit(0.0)).alias("z"))
    )


def arm_long(arm_table: DataFrame) -> DataFrame:
    """Arm table as long features, with the aneuploidy score, in one pass.

    The window holds the arms of one sample; its first arm also emits the score.
    """
    sample = Window.partitionBy("sample_id")
    score = F.coalesce(F.avg(F.abs("z")).over(sample), F.lit(0.0))
    first = F.row_number().over(sample.orderBy("arm")) == 1

    def cell(name, value):
        return F.struct(name.alias("feature_name"), value.alias("value"))

    scored = arm_table.withColumns({"_score": score, "_first": first})
    cells = F.array_compact(F.array(
        cell(F.concat("arm", F.lit("_gc_corrected_depth")), F.col("depth")),
        cell(F.concat("arm", F.lit("_z")), F.col("z")),
        F.when(F.col("_first"), cell(F.lit("plasma_aneuploidy_score"), F.col("_score")))))
    return scored.select("sample_id", F.explode(cells).alias("c")).select(
        "sample_id", "c.feature_name", "c.value")


def mito_features(reads: DataFrame, column: str = "chrom") -> DataFrame:
    """Mitochondrial and other reads per sample, their share and its logarithm."""
    mito = chrom_fn.is_mito(F.col(column))
    counts = reads.filter(F.col(column).isNotNull()).groupBy("sample_id").agg(
        m.count_where(mito).alias("mito_reads"), m.count_where(~mito).alias("nuclear_reads"))
    fraction = m.share(F.col("mito_reads"), F.col("mito_reads") + F.col("nuclear_reads"))
    return counts.withColumn("mito_fraction", fraction).withColumn(
        "log10_mito_fraction", F.log10(F.greatest("mito_fraction", F.lit(1e-12))))


def _looked_up(rows, reference, chunk, column, salts):
    """`rows` with the sequence chunk of the number `chunk` as `column`; NULL for a NULL number."""
    # Rows without a number get keys that no chunk has, spread evenly.
    none = -1 - F.pmod(F.xxhash64(*rows.columns), F.lit(4096).cast("long"))
    keyed = rows.withColumn("chunk", F.coalesce(chunk, none))
    named = reference.select("chrom", "chunk", F.col("seq").alias(column))
    # Sequences are longer than any estimate of a text: they are never sent to every task.
    return lookup_join(keyed, named, ["chrom", "chunk"], "left", max_bytes=0, salts=salts, grows=True).drop("chunk")


def _pairs(fragments, reference, chunk_size, reach, salts):
    """(sample_id, left, right, n): fragments by their 4-mers. A chunk also holds bases after its end:
    a right end that lies within `reach` bases of the start is read from the chunk of the start.
    Others are counted by place and look up their own: no row carries a sequence to a shuffle."""
    size = F.lit(chunk_size).cast("long")
    start, end = F.col("start"), F.col("end")
    tail = F.greatest(end - 4, start)
    first, last = m.long_div(start, chunk_size), m.long_div(tail, chunk_size)
    far = (last != first) & (end - start > reach)

    def mer(sequence, chunk, begin, stop):
        return F.coalesce(F.upper(F.substring(sequence, begin - chunk * size + 1, stop - begin)), F.lit(""))

    looked = _looked_up(fragments.select("sample_id", "chrom", "start", "end"), reference, first, "_seq", salts)
    counted = looked.groupBy(
        "sample_id", mer(F.col("_seq"), first, start, start + 4).alias("left"),
        F.when(~far, mer(F.col("_seq"), first, tail, end)).alias("near"),
        F.when(far, F.col("chrom")).alias("chrom"), F.when(far, tail).alias("tail"), F.when(far, end).alias("end"),
    ).agg(F.count(F.lit(1)).alias("n"))
    place, stop = F.col("tail"), F.col("end")
    chunk = m.long_div(place, chunk_size)
    ended = _looked_up(counted, reference, chunk, "_seq", salts)
    right = F.coalesce("near", mer(F.col("_seq"), chunk, place, stop))
    return ended.groupBy("sample_id", "left", right.alias("right")).agg(F.sum("n").alias("n"))


def end_motif_counts(fragments: DataFrame, reference: DataFrame, chunk_size: int,
                     tail_bases: int, bounded_length: int | None = None, salts: int | None = None) -> DataFrame:
    """Motif counts per sample in three families: left, right and combined 4-mers.

    `reference` chunks carry `tail_bases` bases beyond their end. When the ingest filter bounds
    fragment lengths (`bounded_length`) and the tail covers that bound, both ends of a fragment are
    read from the chunk of its start; longer fragments, and without a bound all that cross a
    chunk, look up the chunk of their right end too, in the same pass. Fragments and chunks are
    shuffled and merged; adaptive execution splits hot chunks, `salts` repeats the genome so many
    times to split them without it. Pairs are counted first (at most 65,536 usual rows per sample), the families
    follow from the pair counts.
    """
    if tail_bases < 3:
        raise ValueError("reference chunks need at least 3 tail bases")
    covered = bounded_length is not None and tail_bases >= bounded_length
    pairs = _pairs(fragments, reference, chunk_size, tail_bases if covered else 0, salts)
    has_left, has_right = F.length("left") == 4, F.length("right") == 4
    names = F.array_compact(F.array(
        F.when(has_left, F.concat(F.lit("left_4mer_"), "left")),
        F.when(has_right, F.concat(F.lit("right_4mer_"), "right")),
        F.when(has_left & has_right, F.concat(F.lit("combined_4mer_"), "left", F.lit("_"), "right")),
    ))
    return (
        pairs.select("sample_id", F.explode(names).alias("feature_name"), "n")
        .groupBy("sample_id", "feature_name").agg(F.sum("n").alias("n"))
    )


def end_motifs(counts: DataFrame) -> DataFrame:
    """Share of each motif among all motif counts of its sample, over all families."""
    total = F.sum("n").over(Window.partitionBy("sample_id"))
    return counts.select("sample_id", "feature_name", (F.col("n").cast("double") / total).alias("value"))


def motif_diversity(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """Shannon entropy (bits) of the motif counts; 0.0 for samples without motifs."""
    total = F.sum("n").over(Window.partitionBy("sample_id"))
    scores = (
        counts.withColumn("total", total).groupBy("sample_id")
        .agg(m.entropy_bits(F.col("n"), F.col("total")).alias("motif_diversity_score"))
    )
    return samples.select("sample_id").join(scores, "sample_id", "left").fillna(
        0.0, ["motif_diversity_score"])


def wps_windows(regions: DataFrame, window: int) -> DataFrame:
    """Closed window of `window` bases around the centre of each region."""
    centre = m.long_div(F.col("start") + F.col("end"), 2)
    half = window // 2
    return regions.withColumn("w_start", centre - half).withColumn("w_end", centre + half)


def wps(fragments: DataFrame, regions: DataFrame, samples: DataFrame | None = None,
        params: Params = DEFAULTS) -> DataFrame:
    """Windowed protection score: fragments that span the window minus fragments with
    an end inside it, for every sample and region (0 without fragments).

    Regions with a `sample_id` column belong to that sample only; otherwise `samples`
    names the samples. Only overlapping fragments are paired with a window, by the
    bucketed overlap join; the counts are aggregated before the shuffle.
    """
    windows = wps_windows(regions, params.wps_window)
    own = "sample_id" in regions.columns
    keys = ["sample_id", "chrom"] if own else ["chrom"]
    spans = windows.select(
        *keys, "name", "w_start", "w_end",
        F.col("w_start").alias("r_start"), (F.col("w_end") + 1).alias("r_end"))
    rows = fragments.select("sample_id", "chrom", F.col("start").alias("f_start"),
                            (F.col("end") + 1).alias("f_end"))
    hits = overlap_join(rows, spans, keys=keys, left_span=("f_start", "f_end"),
                        widths=NARROW_WIDTHS)
    start, end = F.col("f_start"), F.col("f_end") - 1
    low, high = F.col("w_start"), F.col("w_end")
    spanning = (start <= low) & (end >= high)
    ending = start.between(low, high) | end.between(low, high)
    scored = hits.select("sample_id", "chrom", "name", "w_start", "w_end",
                         (spanning.cast("long") - ending.cast("long")).alias("score"))
    items = windows.select(*keys, "name", "w_start", "w_end")
    grid = items if own else product_rows(samples.select("sample_id"), items)
    return (
        scored.unionByName(grid.withColumn("score", F.lit(0).cast("long")))
        .groupBy("sample_id", "chrom", F.col("w_start").alias("start"), F.col("w_end").alias("end"), "name")
        .agg(F.sum("score").alias("wps"))
    )


def wps_default_regions(fragments: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Without a region table: the first fragments of each sample in coordinate order."""
    order = ["chrom", "start", "end", "strand", "mapq"]
    first = top_rows_per_group(
        fragments.select("sample_id", *order), ["sample_id"], order,
        params.wps_default_regions, index="_rank")
    name = F.concat(F.lit("region_"), (F.col("_rank") - 1).cast("string"))
    return first.select("sample_id", "chrom", "start", "end", name.alias("name"))
