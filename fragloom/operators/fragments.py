"""Fragment derivation, filters and per-sample quality tables."""

from pyspark.sql import DataFrame, functions as F

from fragloom import constants as C
from fragloom.functions import chrom as chrom_fn, measures as m
from fragloom.params import DEFAULTS, Params
from fragloom.schemas import FRAGMENT_COLUMNS


def with_length(raw: DataFrame) -> DataFrame:
    return raw.withColumn("length", F.col("end") - F.col("start"))


def filter_mapq(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return df.filter(F.col("mapq") >= params.min_mapq)


def filter_length(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return df.filter(F.col("length").between(params.min_length, params.max_length))


def with_size_class(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return (
        df.withColumn("is_short", m.is_short(F.col("length"), params))
        .withColumn("is_long", m.is_long(F.col("length"), params))
    )


def infer_style(bins: DataFrame) -> str:
    """Contig style of a bin or contig-size table: `chr` when its first row has the prefix."""
    first = bins.select("chrom").head(1)
    return "chr" if first and str(first[0][0]).startswith("chr") else "no_chr"


def ingest(raw: DataFrame, style: str = "no_chr", params: Params = DEFAULTS) -> DataFrame:
    """Raw rows (sample_id, chrom, start, end, mapq, strand) to canonical fragments.

    One narrow pass without a shuffle: filters first, then the derived columns.
    """
    kept = filter_length(filter_mapq(with_length(raw), params), params)
    named = kept.withColumn("chrom", chrom_fn.normalize_chrom(F.col("chrom"), style))
    return with_size_class(named, params).select(*FRAGMENT_COLUMNS)


def ingest_qc(raw: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Filter funnel and length summary per sample, in one pass over unfiltered rows.

    The exact median keeps one counter per length, at most max_length - min_length + 1.
    """
    length = F.col("end") - F.col("start")
    good = F.col("mapq") >= params.min_mapq
    passed = good & length.between(params.min_length, params.max_length)
    kept = F.when(passed, length)
    counts = raw.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("input_fragments"),
        m.count_where(good).alias("fragments_passing_mapq"),
        F.count(kept).alias("n"),
        F.sum(kept).alias("length_sum"),
        F.median(kept).alias("length_median"),
        m.count_where(m.is_short(kept, params)).alias("n_short"),
        m.count_where(m.is_long(kept, params)).alias("n_long"),
    )
    return counts.select(
        "sample_id", "input_fragments", "fragments_passing_mapq",
        F.col("n").alias("fragments_passing_mapq_and_length"),
        F.coalesce(m.share(F.col("length_sum"), F.col("n")), F.lit(0.0)).alias("mean_length"),
        F.coalesce("length_median", F.lit(0.0)).alias("median_length"),
        m.share(F.col("n_short"), F.col("n")).alias("fraction_short_100_150"),
        m.share(F.col("n_long"), F.col("n")).alias("fraction_long_151_220"),
        m.ratio(F.col("n_short"), F.col("n_long")).alias("short_long_ratio"),
        F.lit(params.min_mapq).alias("min_mapq_used"),
        F.lit(params.min_length).alias("min_fragment_length_used"),
        F.lit(params.max_length).alias("max_fragment_length_used"),
    )


def filter_autosomes(df: DataFrame, column: str = "chrom") -> DataFrame:
    return df.filter(chrom_fn.is_autosome(F.col(column)))


def filter_flags(alignments: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Proper pairs without any excluded flag bit and with enough mapping quality."""
    flag = F.col("flag")
    return alignments.filter(
        (flag.bitwiseAND(F.lit(C.FLAG_PROPER_PAIR)) != 0)
        & (flag.bitwiseAND(F.lit(params.exclude_flags)) == 0)
        & (F.col("mapq") >= params.min_mapq)
    )


def first_reads(alignments: DataFrame) -> DataFrame:
    """One primary, mapped, unduplicated first read per properly paired template."""
    flag = F.col("flag")
    wanted = C.FLAG_READ1 | C.FLAG_PROPER_PAIR
    refused = (C.FLAG_UNMAPPED | C.FLAG_MATE_UNMAPPED | C.FLAG_SECONDARY
               | C.FLAG_SUPPLEMENTARY | C.FLAG_DUPLICATE | C.FLAG_QC_FAIL)
    return alignments.filter(
        (flag.bitwiseAND(F.lit(wanted)) == wanted) & (flag.bitwiseAND(F.lit(refused)) == 0)
    )


def read_name_hash(name):
    """First 16 hexadecimal characters of the SHA-1 of a read name."""
    return F.substring(F.sha1(name), 1, 16)


def alignments_to_fragments(alignments: DataFrame, params: Params = DEFAULTS,
                            autosomes_only: bool = False) -> DataFrame:
    """Templates of paired alignments as canonical fragments plus `read_name_hash`.

    Positions are 1-based as in SAM text; fragments are 0-based and half-open.
    """
    reads = first_reads(alignments).filter(F.col("mapq") >= params.min_mapq)
    if autosomes_only:
        reads = filter_autosomes(reads, "rname")
    start = F.least("pos", "pnext") - 1
    length = F.abs("tlen")
    fragments = reads.filter(F.col("tlen") != 0).select(
        "sample_id",
        F.col("rname").alias("chrom"),
        start.alias("start"),
        (start + length).alias("end"),
        F.col("mapq").cast("long").alias("mapq"),
        F.when(F.col("flag").bitwiseAND(F.lit(C.FLAG_REVERSE)) != 0, "-").otherwise("+").alias("strand"),
        length.alias("length"),
        read_name_hash(F.col("qname")).alias("read_name_hash"),
    )
    sized = with_size_class(filter_length(fragments, params), params)
    return sized.select(*FRAGMENT_COLUMNS, "read_name_hash")


def mark_duplicates(fragments: DataFrame, name: str = "qname") -> DataFrame:
    """Best copy of each (sample, contig, start, end, strand) as a canonical fragment, with its
    `name` and the number of copies it had. Ties in mapping quality go to the lesser name.

    Copies are reduced by a partial aggregate before the shuffle, so a group that
    holds a large share of all rows reaches the reducer as one row per map task.
    """
    keys = ["sample_id", "chrom", "start", "end", "strand"]
    best = F.min(F.struct((-F.col("mapq")).alias("q"), F.col(name).alias("name")))
    marked = (
        fragments.groupBy(*keys)
        .agg(best.alias("best"), F.count(F.lit(1)).alias("n_copies"))
        .select(*keys, (-F.col("best.q")).alias("mapq"), F.col("best.name").alias(name), "n_copies")
    )
    return with_size_class(with_length(marked)).select(*FRAGMENT_COLUMNS, name, "n_copies")


def duplicate_rate(marked: DataFrame) -> DataFrame:
    total = F.sum("n_copies")
    return marked.groupBy("sample_id").agg(
        total.alias("fragments"),
        F.count(F.lit(1)).alias("unique_fragments"),
        m.share(total - F.count(F.lit(1)), total).alias("duplicate_rate"),
    )


def fragment_qc(fragments: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Length statistics per sample: median, mode and length-band shares."""
    length, n = F.col("length"), F.col("filtered_fragments")
    counts = fragments.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("filtered_fragments"),
        F.median("length").alias("median_fragment_length"),
        F.mode("length", True).alias("mode_fragment_length"),
        m.count_where(m.is_short(length, params)).alias("n_short"),
        m.count_where(m.is_long(length, params)).alias("n_long"),
        m.count_where(length < 100).alias("n_lt_100"),
        m.count_where(length.between(221, 320)).alias("n_221_320"),
        m.count_where(length > 320).alias("n_gt_320"),
    )
    short, long = F.col("n_short"), F.col("n_long")
    return counts.select(
        "sample_id", "filtered_fragments", "median_fragment_length", "mode_fragment_length",
        m.share(short, n).alias("fraction_short_100_150"),
        m.share(long, n).alias("fraction_long_151_220"),
        m.ratio(short, long).alias("short_long_ratio_global"),
        m.share(F.col("n_lt_100"), n).alias("fraction_lt_100"),
        m.share(short, n).alias("fraction_100_150"),
        m.share(long, n).alias("fraction_151_220"),
        m.share(F.col("n_221_320"), n).alias("fraction_221_320"),
        m.share(F.col("n_gt_320"), n).alias("fraction_gt_320"),
    )


def length_histogram(fragments: DataFrame) -> DataFrame:
    return fragments.groupBy("sample_id", "length").agg(F.count(F.lit(1)).alias("n_fragments"))


def autosomal_coverage(fragments: DataFrame, sizes: DataFrame) -> DataFrame:
    """mean_coverage per sample: bases of fragments on autosomes over the bases of the autosomes.

    `sizes` holds (chrom, size): contigs, or bins with their effective sizes. Samples without
    autosomal fragments get 0.
    """
    on = chrom_fn.is_autosome(F.col("chrom"))
    genome = sizes.filter(on).agg(F.sum("size").cast("double")).scalar()
    bases = F.coalesce(F.sum(F.when(on, F.col("end") - F.col("start"))), F.lit(0))
    return fragments.groupBy("sample_id").agg((bases / genome).alias("mean_coverage"))


def alignment_qc(alignments: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Per sample, in one pass: alignments, those that `filter_flags` keeps, primary records of
    pairs, and fraction_proper_pair, the share of these that are mapped in a proper pair."""
    flag = F.col("flag")

    def has(bits):
        return flag.bitwiseAND(F.lit(bits)) != 0

    primary = has(C.FLAG_PAIRED) & ~has(C.FLAG_SECONDARY | C.FLAG_SUPPLEMENTARY)
    proper = primary & has(C.FLAG_PROPER_PAIR) & ~has(C.FLAG_UNMAPPED | C.FLAG_MATE_UNMAPPED)
    kept = has(C.FLAG_PROPER_PAIR) & ~has(params.exclude_flags) & (F.col("mapq") >= params.min_mapq)
    counts = alignments.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("alignments"), m.count_where(kept).alias("kept_alignments"),
        m.count_where(primary).alias("paired_alignments"), m.count_where(proper).alias("_proper"))
    share = m.share(F.col("_proper"), F.col("paired_alignments"))
    return counts.withColumn("fraction_proper_pair", share).drop("_proper")


def sample_qc(fragments: DataFrame, sizes: DataFrame, *further: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """One row per sample with the quantities that `qc_flags` judges, and its verdict.

    Length statistics and coverage come from the filtered fragments; `further` tables, one row per
    sample, bring the rest: `duplicate_rate`, `alignment_qc`, `regions.mito_features`. A sample
    missing in a table has NULL there, which passes.
    """
    qc = fragment_qc(fragments, params).join(autosomal_coverage(fragments, sizes), "sample_id", "left")
    for table in further:
        qc = qc.join(table, "sample_id", "left")
    return qc_flags(qc, params)


def qc_flags(qc: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Opt-in quality verdict. Limits apply to the columns that `qc` has; NULL passes.

    Reads filtered_fragments, mean_coverage, duplicate_rate, median_fragment_length,
    mito_fraction and fraction_proper_pair.
    """
    rules = [
        ("filtered_fragments", "low_fragment_count", lambda c: c < params.qc_min_fragments),
        ("mean_coverage", "low_coverage", lambda c: c < params.qc_min_coverage),
        ("duplicate_rate", "high_duplicate_rate", lambda c: c > params.qc_max_duplicate_rate),
        ("median_fragment_length", "low_median_length", lambda c: c < params.qc_min_median_length),
        ("median_fragment_length", "high_median_length", lambda c: c > params.qc_max_median_length),
        ("mito_fraction", "high_mito_fraction", lambda c: c > params.qc_max_mito_fraction),
        ("fraction_proper_pair", "low_proper_pair", lambda c: c < params.qc_min_proper_pair),
    ]
    flags = [F.when(test(F.col(column)), name) for column, name, test in rules
             if column in qc.columns]
    text = F.concat_ws(";", *flags)
    return qc.withColumn("qc_flags", text).withColumn("qc_pass", text == "")
