"""Fragment derivation, filters and quality tables."""

from pyspark.sql import functions as F

from fragloom.catalog import views as v
from fragloom.catalog.registry import query, rounded
from fragloom.functions import chrom as chrom_fn, text as t
from fragloom.operators import fragments as fr
from fragloom.operators.intervals import overlap_join
from fragloom.params import Params

FRAGMENT_SQL = "sample_id, chrom, s AS start, e AS \"end\", mapq, strand, length, is_short, is_long"


@query("WITH " + v.RAW + """
SELECT chrom, CASE WHEN chrom = 'MT' THEN 'chrM' ELSE 'chr' || chrom END AS chr_style,
       replace(CASE WHEN chrom = 'MT' THEN 'chrM' ELSE 'chr' || chrom END, 'chrM', 'chrMT') AS renamed,
       CASE WHEN chrom = 'MT' THEN 'MT' ELSE chrom END AS bare_style, count(*) AS n
FROM raw GROUP BY ALL""")
def normalize_chrom(spark, sf):
    raw = v.raw_fragments(spark, sf)
    chr_style = chrom_fn.normalize_chrom(F.col("chrom"), "chr")
    return raw.select(
        "chrom", chr_style.alias("chr_style"),
        F.regexp_replace(chr_style, "^chrM$", "chrMT").alias("renamed"),
        chrom_fn.normalize_chrom(chr_style, "no_chr").alias("bare_style"),
    ).groupBy("chrom", "chr_style", "renamed", "bare_style").agg(F.count(F.lit(1)).alias("n"))


@query("WITH " + v.FRAGS + f" SELECT {FRAGMENT_SQL} FROM frags")
def ingest_filter(spark, sf):
    return v.fragments(spark, sf)


@query("WITH " + v.RAW + """
SELECT e - s AS length, (e - s) BETWEEN 100 AND 150 AS is_short,
       (e - s) BETWEEN 151 AND 220 AS is_long, count(*) AS n FROM raw GROUP BY ALL""")
def size_class(spark, sf):
    sized = fr.with_size_class(fr.with_length(v.raw_fragments(spark, sf)))
    return sized.groupBy("length", "is_short", "is_long").agg(F.count(F.lit(1)).alias("n"))


@query("WITH " + v.RAW + """,
k AS (SELECT *, e - s AS len, mapq >= 30 AS good, mapq >= 30 AND e - s BETWEEN 50 AND 500 AS ok FROM raw),
a AS (SELECT sample_id, count(*) AS input_fragments, count(*) FILTER (good) AS m, count(*) FILTER (ok) AS n,
             sum(len) FILTER (ok) AS total, median(len) FILTER (ok) AS med,
             count(*) FILTER (ok AND len BETWEEN 100 AND 150) AS sh,
             count(*) FILTER (ok AND len BETWEEN 151 AND 220) AS lo FROM k GROUP BY 1)
SELECT sample_id, input_fragments, m AS fragments_passing_mapq, n AS fragments_passing_mapq_and_length,
       CASE WHEN n > 0 THEN total / n ELSE 0.0 END AS mean_length, coalesce(med, 0.0) AS median_length,
       CASE WHEN n > 0 THEN sh / n ELSE 0.0 END AS fraction_short_100_150,
       CASE WHEN n > 0 THEN lo / n ELSE 0.0 END AS fraction_long_151_220,
       sh / greatest(lo, 1) AS short_long_ratio, 30 AS min_mapq_used,
       50 AS min_fragment_length_used, 500 AS max_fragment_length_used FROM a""")
def ingest_qc(spark, sf):
    return fr.ingest_qc(v.raw_fragments(spark, sf))


@query("WITH " + v.RAW + """
SELECT chrom, count(*) AS n FROM raw WHERE chrom NOT IN ('X', 'MT') GROUP BY chrom""")
def autosome_filter(spark, sf):
    kept = fr.filter_autosomes(v.raw_fragments(spark, sf))
    return kept.groupBy("chrom").agg(F.count(F.lit(1)).alias("n"))


@query("WITH " + v.ALIGNMENTS + """
SELECT sample_id, qname, flag, mapq FROM alignments
WHERE flag & 2 <> 0 AND flag & 3844 = 0 AND mapq >= 30""")
def flag_filter(spark, sf):
    return fr.filter_flags(v.alignments(spark, sf)).select("sample_id", "qname", "flag", "mapq")


@query("WITH " + v.ALIGNMENTS + """,
k AS (SELECT *, least(pos, pnext) - 1 AS s, abs(tlen) AS len FROM alignments
      WHERE flag & 66 = 66 AND flag & 3852 = 0 AND mapq >= 30 AND tlen <> 0)
SELECT sample_id, rname AS chrom, s AS start, s + len AS "end", mapq,
       CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand, len AS length,
       len BETWEEN 100 AND 150 AS is_short, len BETWEEN 151 AND 220 AS is_long,
       substr(sha1(qname), 1, 16) AS read_name_hash
FROM k WHERE len BETWEEN 50 AND 500""")
def alignment_to_fragment(spark, sf):
    return fr.alignments_to_fragments(v.alignments(spark, sf))


@query("WITH " + v.ALIGNMENTS + " SELECT qname, substr(sha1(qname), 1, 16) AS read_name_hash FROM alignments")
def read_name_hash(spark, sf):
    return v.alignments(spark, sf).select("qname", fr.read_name_hash(F.col("qname")).alias("read_name_hash"))


@query("WITH " + v.FRAGS + "," + v.MASKS + f"""
SELECT {FRAGMENT_SQL} FROM frags f
WHERE NOT EXISTS (SELECT 1 FROM masks m WHERE m.chrom = f.chrom AND m.r_start < f.e AND m.r_end > f.s)""")
def mask_anti_join(spark, sf):
    return overlap_join(v.fragments(spark, sf), v.masks(spark, sf), "left_anti")


@query("WITH " + v.COPIES + """
SELECT sample_id, chrom, s AS start, e AS "end", strand, mapq, qname, n_copies, e - s AS length,
  e - s BETWEEN 100 AND 150 AS is_short, e - s BETWEEN 151 AND 220 AS is_long FROM (
  SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY sample_id, chrom, s, e, strand) AS n_copies
  FROM copies WINDOW w AS (PARTITION BY sample_id, chrom, s, e, strand ORDER BY mapq DESC, qname))
WHERE rn = 1""")
def fragment_dedup(spark, sf):
    return fr.mark_duplicates(v.copies(spark, sf))


@query("WITH " + v.COPIES + """
SELECT sample_id, count(*) AS fragments, count(DISTINCT (chrom, s, e, strand)) AS unique_fragments,
       (count(*) - count(DISTINCT (chrom, s, e, strand))) / count(*) AS duplicate_rate
FROM copies GROUP BY sample_id""")
def duplicate_rate(spark, sf):
    return fr.duplicate_rate(fr.mark_duplicates(v.copies(spark, sf)))


QC_SQL = v.FRAGS + """,
modes AS (SELECT sample_id, length FROM (
  SELECT sample_id, length, row_number() OVER (PARTITION BY sample_id ORDER BY count(*) DESC, length) AS rn
  FROM frags GROUP BY sample_id, length) WHERE rn = 1),
qc AS (SELECT f.sample_id, count(*) AS filtered_fragments, median(f.length) AS median_fragment_length,
  any_value(m.length) AS mode_fragment_length, count(*) FILTER (is_short) / count(*) AS fraction_short_100_150,
  count(*) FILTER (is_long) / count(*) AS fraction_long_151_220,
  count(*) FILTER (is_short) / greatest(count(*) FILTER (is_long), 1) AS short_long_ratio_global,
  count(*) FILTER (f.length < 100) / count(*) AS fraction_lt_100,
  count(*) FILTER (is_short) / count(*) AS fraction_100_150,
  count(*) FILTER (is_long) / count(*) AS fraction_151_220,
  count(*) FILTER (f.length BETWEEN 221 AND 320) / count(*) AS fraction_221_320,
  count(*) FILTER (f.length > 320) / count(*) AS fraction_gt_320
  FROM frags f JOIN modes m USING (sample_id) GROUP BY f.sample_id)"""


@query("WITH " + QC_SQL + " SELECT * FROM qc")
def fragment_qc(spark, sf):
    return fr.fragment_qc(v.fragments(spark, sf))


@query("WITH " + v.FRAGS + """
SELECT sample_id, length, count(*) AS n_fragments FROM frags GROUP BY ALL""")
def length_histogram(spark, sf):
    return fr.length_histogram(v.fragments(spark, sf))


@query("WITH " + QC_SQL + """,
mito AS (SELECT sample_id, count(*) FILTER (chrom = 'MT') / count(*) AS mito_fraction FROM raw GROUP BY 1),
j AS (SELECT * FROM qc JOIN mito USING (sample_id)),
f AS (SELECT sample_id, filtered_fragments, median_fragment_length, mito_fraction,
  concat_ws(';', CASE WHEN filtered_fragments < 5000000 THEN 'low_fragment_count' END,
    CASE WHEN median_fragment_length < 120 THEN 'low_median_length' END,
    CASE WHEN median_fragment_length > 190 THEN 'high_median_length' END,
    CASE WHEN mito_fraction > 0.20 THEN 'high_mito_fraction' END) AS qc_flags FROM j)
SELECT *, qc_flags = '' AS qc_pass FROM f""")
def qc_flags(spark, sf):
    from fragloom.operators.regions import mito_features
    qc = fr.fragment_qc(v.fragments(spark, sf)).select(
        "sample_id", "filtered_fragments", "median_fragment_length")
    mito = mito_features(v.raw_fragments(spark, sf)).select("sample_id", "mito_fraction")
    return fr.qc_flags(qc.join(mito, "sample_id"))


LIMITS = Params(qc_min_fragments=680, qc_min_coverage=0.0038, qc_max_duplicate_rate=0.6, qc_min_median_length=250,
                qc_max_median_length=290, qc_max_mito_fraction=0.045, qc_min_proper_pair=0.7)


@query("WITH " + QC_SQL + "," + v.SIZES + "," + v.ALIGNMENTS.strip() + "," + v.COPIES.strip() + f""",
mito AS (SELECT sample_id, count(*) FILTER (chrom = 'MT') / count(*) AS mito_fraction FROM raw GROUP BY 1),
genome AS (SELECT CAST(sum(size) AS DOUBLE) AS bases FROM sizes WHERE chrom NOT IN ('chrX', 'chrM')),
cover AS (SELECT sample_id, coalesce(sum(e - s) FILTER (chrom NOT IN ('chrX', 'chrM')), 0) / any_value(bases) AS mean_coverage
  FROM frags, genome GROUP BY sample_id),
copied AS (SELECT sample_id, (count(*) - count(DISTINCT (chrom, s, e, strand))) / count(*) AS duplicate_rate FROM copies GROUP BY 1),
pairs AS (SELECT sample_id, count(*) FILTER (flag & 1 <> 0 AND flag & 2304 = 0) AS n,
  count(*) FILTER (flag & 1 <> 0 AND flag & 2304 = 0 AND flag & 2 <> 0 AND flag & 12 = 0) AS proper FROM alignments GROUP BY 1),
j AS (SELECT sample_id, filtered_fragments, round(mean_coverage, 9) AS mean_coverage, round(duplicate_rate, 9) AS duplicate_rate,
    median_fragment_length, round(mito_fraction, 9) AS mito_fraction, round(proper / n, 9) AS fraction_proper_pair
  FROM qc LEFT JOIN mito USING (sample_id) LEFT JOIN cover USING (sample_id) LEFT JOIN copied USING (sample_id)
  LEFT JOIN pairs USING (sample_id)),
f AS (SELECT *, concat_ws(';',
    CASE WHEN filtered_fragments < {LIMITS.qc_min_fragments} THEN 'low_fragment_count' END,
    CASE WHEN mean_coverage < {LIMITS.qc_min_coverage} THEN 'low_coverage' END,
    CASE WHEN duplicate_rate > {LIMITS.qc_max_duplicate_rate} THEN 'high_duplicate_rate' END,
    CASE WHEN median_fragment_length < {LIMITS.qc_min_median_length} THEN 'low_median_length' END,
    CASE WHEN median_fragment_length > {LIMITS.qc_max_median_length} THEN 'high_median_length' END,
    CASE WHEN mito_fraction > {LIMITS.qc_max_mito_fraction} THEN 'high_mito_fraction' END,
    CASE WHEN fraction_proper_pair < {LIMITS.qc_min_proper_pair} THEN 'low_proper_pair' END) AS qc_flags FROM j)
SELECT *, qc_flags = '' AS qc_pass FROM f""")
def sample_qc(spark, sf):
    """All seven rules, with the tables that produce what they judge."""
    from fragloom.operators.regions import mito_features
    further = [fr.duplicate_rate(fr.mark_duplicates(v.copies(spark, sf))).select("sample_id", "duplicate_rate"),
               fr.alignment_qc(v.alignments(spark, sf)).select("sample_id", "fraction_proper_pair"),
               mito_features(v.raw_fragments(spark, sf)).select("sample_id", "mito_fraction")]
    qc = fr.sample_qc(v.fragments(spark, sf), v.chrom_sizes(spark, sf), *further, params=LIMITS)
    shown = qc.select("sample_id", "filtered_fragments", "mean_coverage", "duplicate_rate", "median_fragment_length",
                      "mito_fraction", "fraction_proper_pair", "qc_flags", "qc_pass")
    return rounded(shown, "mean_coverage", "duplicate_rate", "mito_fraction", "fraction_proper_pair")


@query("WITH " + v.ALIGNMENTS + """
SELECT sample_id, count(*) AS alignments, count(*) FILTER (flag & 2 <> 0 AND flag & 3844 = 0 AND mapq >= 30) AS kept_alignments,
  count(*) FILTER (flag & 1 <> 0 AND flag & 2304 = 0) AS paired_alignments,
  round(count(*) FILTER (flag & 1 <> 0 AND flag & 2304 = 0 AND flag & 2 <> 0 AND flag & 12 = 0)
    / count(*) FILTER (flag & 1 <> 0 AND flag & 2304 = 0), 9) AS fraction_proper_pair
FROM alignments GROUP BY sample_id""")
def alignment_qc(spark, sf):
    return rounded(fr.alignment_qc(v.alignments(spark, sf)), "fraction_proper_pair")


@query("""
SELECT url, regexp_matches(url, '(\\.frag\\.tsv\\.bgz|\\.frag\\.tsv\\.gz|\\.tsv\\.bgz|\\.tsv\\.gz|\\.bed\\.bgz|\\.bed\\.gz|\\.bgz|\\.gz)$') AS accepted
FROM (SELECT url FROM pages UNION ALL SELECT url || '.frag.tsv.bgz' FROM pages
      UNION ALL SELECT url || '.bed.gz' FROM pages UNION ALL SELECT url || '.bigWig' FROM pages)""")
def accepted_extension(spark, sf):
    pages = v.table(spark, sf, "pages")
    urls = pages.select(F.explode(F.array(
        "url", *[F.concat("url", F.lit(s)) for s in (".frag.tsv.bgz", ".bed.gz", ".bigWig")])).alias("url"))
    return urls.select("url", t.accepted_extension(F.col("url")).alias("accepted"))


@query("""
WITH p AS (SELECT unnest([url, '/data/' || page_id, 'data/' || page_id || '.gz', 'hg19/' || page_id || '.frag.gz',
                         '//x/' || page_id]) AS path FROM pages)
SELECT path, CASE WHEN path LIKE 'http://%' OR path LIKE 'https://%' THEN path
  WHEN path LIKE '/data/%' THEN 'http://finaledb.research.cchmc.org' || path
  WHEN path LIKE 'data/%' THEN 'http://finaledb.research.cchmc.org/' || path
  ELSE 'http://finaledb.research.cchmc.org/data/' || ltrim(path, '/') END AS url FROM p""")
def normalize_url(spark, sf):
    pages = v.table(spark, sf, "pages")
    page = F.col("page_id").cast("string")
    paths = pages.select(F.explode(F.array(
        F.col("url"), F.concat(F.lit("/data/"), page), F.concat(F.lit("data/"), page, F.lit(".gz")),
        F.concat(F.lit("hg19/"), page, F.lit(".frag.gz")), F.concat(F.lit("//x/"), page))).alias("path"))
    return paths.select("path", t.normalize_download_url(F.col("path")).alias("url"))
