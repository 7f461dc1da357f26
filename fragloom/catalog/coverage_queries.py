"""Bins, counts, GC correction and region features."""

from pyspark.sql import functions as F

from fragloom.catalog import views as v
from fragloom.catalog.registry import query, rounded
from fragloom.operators import coverage as cv, gc, regions as rg
from fragloom.session import stage
from fragloom.sources.readers import chunk_sequence

BIN = 100_000
FRAGS = v.FRAGS + "," + v.SIZES + "," + v.SAMPLES


def bins_sql(size, autosomes=True):
    only = "AND chrom NOT IN ('chrX', 'chrM')" if autosomes else ""
    return f"""
tiles AS (SELECT chrom, size, unnest(range(0, size, {size})) AS s FROM sizes WHERE size > 0 {only}),
bins AS (SELECT chrom, s, least(s + {size}, size) AS e,
                chrom || ':' || s || '-' || least(s + {size}, size) AS bin_id
         FROM tiles WHERE least(s + {size}, size) - s >= {size} * 0.5)"""


def dense_sql(size=BIN, gc="CAST(0.5 AS DOUBLE)"):
    return FRAGS + "," + bins_sql(size) + f""",
hits AS (SELECT *, unnest(range(s // {size}, (e - 1) // {size} + 1)) * {size} AS b FROM frags),
agg AS (SELECT sample_id, chrom, b, count(*) AS n, count(*) FILTER (is_short) AS ns, count(*) FILTER (is_long) AS nl,
               CAST(sum(length) AS BIGINT) AS total, median(least(greatest(length, 0), 1000)) AS med
        FROM hits GROUP BY ALL),
dense AS (
  SELECT p.sample_id, i.chrom, i.s AS start, i.e AS "end", i.bin_id,
    coalesce(n, 0) AS n_total_fragments, coalesce(ns, 0) AS n_short_100_150, coalesce(nl, 0) AS n_long_151_220,
    coalesce(ns, 0) / greatest(coalesce(nl, 0), 1) AS short_long_ratio,
    coalesce(total / n, 0) AS mean_fragment_length, coalesce(med, 0) AS median_fragment_length,
    coalesce(n, 0) / (i.e - i.s) AS coverage_total, coalesce(ns, 0) / (i.e - i.s) AS coverage_short,
    coalesce(nl, 0) / (i.e - i.s) AS coverage_long, {gc} AS gc_content, i.e - i.s AS effective_bin_size
  FROM samples p CROSS JOIN bins i
  LEFT JOIN agg a ON a.sample_id = p.sample_id AND a.chrom = i.chrom AND a.b = i.s)"""


# A gc value per bin that varies along the contig.
GC_SQL = "CAST(0.3 AS DOUBLE) + (i.s // 100000 * 37 % 101) / CAST(250 AS DOUBLE)"


def tiles(spark, sf, size=BIN):
    return cv.annotate_gc(cv.make_bins(v.chrom_sizes(spark, sf), size))


def dense(spark, sf, size=BIN):
    return cv.dense_bin_counts(v.fragments(spark, sf), tiles(spark, sf, size), v.samples(spark, sf), size)


def dense_with_gc(spark, sf):
    place = F.floor(F.col("start") / BIN) * 37 % 101
    bins = tiles(spark, sf).withColumn("gc_content", F.lit(0.3) + place / F.lit(250.0))
    return cv.dense_bin_counts(v.fragments(spark, sf), bins, v.samples(spark, sf), BIN)


# Without a sequence gc is constant, then the correction is the identity branch.
CORRECTED_SQL = dense_sql() + """,
corrected AS (
  SELECT *, coverage_total - median(coverage_total) OVER w + median(coverage_total) OVER w AS coverage_total_gc_corrected,
    coverage_short - median(coverage_short) OVER w + median(coverage_short) OVER w AS coverage_short_gc_corrected,
    coverage_long - median(coverage_long) OVER w + median(coverage_long) OVER w AS coverage_long_gc_corrected
  FROM dense WINDOW w AS (PARTITION BY sample_id))"""


def corrected(spark, sf):
    return gc.correct_gc_identity(dense(spark, sf))


@query("WITH " + v.RAW + "," + v.SIZES + "," + bins_sql(300000) + """
SELECT chrom, s AS start, e AS "end", bin_id FROM bins""")
def make_bins(spark, sf):
    return cv.make_bins(v.chrom_sizes(spark, sf), 300_000)


@query("""WITH sizes AS (SELECT 'doc' || doc_id AS chrom, length(text) AS size FROM documents),""" + bins_sql(200, False) + """
SELECT chrom, s AS start, e AS "end", bin_id FROM bins""")
def make_bins_all_contigs(spark, sf):
    sizes = v.document_contigs(spark, sf).select("chrom", F.length("sequence").cast("long").alias("size"))
    return cv.make_bins(sizes, 200, autosomes_only=False)


def gc_sql(size):
    return """WITH c AS (SELECT 'doc' || doc_id AS chrom, length(text) AS size,
  translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTNN') AS seq FROM documents),
sizes AS (SELECT chrom, size FROM c),""" + bins_sql(size, False) + """,
p AS (SELECT b.*, substring(seq, s + 1, e - s) AS piece FROM bins b JOIN c USING (chrom)),
n AS (SELECT *, length(piece) - length(regexp_replace(piece, '[GCgc]', '', 'g')) AS gc,
             length(piece) - length(regexp_replace(piece, '[ACGTacgt]', '', 'g')) AS acgt FROM p)
SELECT chrom, s AS start, e AS "end", bin_id, CASE WHEN acgt > 0 THEN gc / acgt ELSE 0.0 END AS gc_content,
       e - s AS effective_bin_size FROM n"""


def document_bins(spark, sf, size):
    contigs = v.document_contigs(spark, sf)
    sizes = contigs.select("chrom", F.length("sequence").cast("long").alias("size"))
    return cv.make_bins(sizes, size, autosomes_only=False), chunk_sequence(contigs, 256)


@query(gc_sql(200))
def bin_gc(spark, sf):
    return cv.annotate_gc(*document_bins(spark, sf, 200), 200)


@query(gc_sql(1500))
def interval_gc(spark, sf):
    """The same without knowing that bins are tiles: through the bucketed join."""
    return cv.annotate_gc(*document_bins(spark, sf, 1500))


@query("WITH " + dense_sql() + """
SELECT sample_id, chrom, b AS start, n AS n_total_fragments, ns AS n_short_100_150, nl AS n_long_151_220,
       total AS length_sum, med AS median_fragment_length FROM agg""")
def bin_counts(spark, sf):
    return cv.bin_counts(v.fragments(spark, sf), BIN)


@query("WITH " + v.FRAGS + """,
r AS (SELECT 'chr' || (p_partkey % 22 + 1) AS chrom, p_partkey * 7919 % 2000000 AS r_start,
             p_partkey * 7919 % 2000000 + 300 + p_partkey % 50000 AS r_end FROM part)
SELECT f.sample_id, r.chrom, r_start AS start, r_end AS "end", count(*) AS n_total_fragments
FROM frags f JOIN (SELECT DISTINCT * FROM r) r ON f.chrom = r.chrom AND f.s < r_end AND f.e > r_start GROUP BY ALL""")
def interval_counts(spark, sf):
    """Bins of any shape, overlapping ones included."""
    key = F.col("p_partkey")
    start = key * 7919 % 2000000
    bins = v.table(spark, sf, "part").select(
        F.concat(F.lit("chr"), (key % 22 + 1).cast("string")).alias("chrom"), start.alias("start"),
        (start + 300 + key % 50000).alias("end"))
    hits = cv.fragment_hits(v.fragments(spark, sf), bins, lengths=False)
    return hits.groupBy("sample_id", "chrom", "start", "end").agg(F.sum("n").alias("n_total_fragments"))


@query("WITH " + dense_sql() + """
SELECT sample_id, bin_id, short_long_ratio, coverage_total, coverage_short, coverage_long FROM dense""")
def bin_coverage(spark, sf):
    return dense(spark, sf).select(
        "sample_id", "bin_id", "short_long_ratio", "coverage_total", "coverage_short", "coverage_long")


@query("WITH " + dense_sql() + " SELECT * FROM dense")
def bin_counts_dense(spark, sf):
    return dense(spark, sf)


@query("WITH " + dense_sql(500000) + " SELECT * FROM dense")
def bin_counts_large(spark, sf):
    return dense(spark, sf, 500_000)


@query("WITH " + FRAGS + "," + bins_sql(BIN) + """
SELECT sample_id, chrom, count(*) AS n_fragments FROM frags
WHERE chrom NOT IN (SELECT chrom FROM bins) GROUP BY ALL""")
def unbinned_fragments(spark, sf):
    return cv.unbinned_fragments(v.fragments(spark, sf), tiles(spark, sf))


def _lowess_sql():
    """The robust passes as aggregates over all pairs of gc values of a sample."""
    passes = ["points0 AS (SELECT *, CAST(1 AS DOUBLE) AS r FROM long)"]
    for t in range(4):
        passes.append(f"""
levels{t} AS MATERIALIZED (SELECT sample_id, metric, x, sum(r) AS r, sum(r * y) AS ry, avg(y) AS mean FROM points{t} GROUP BY ALL),
sums{t} AS (
  SELECT w.sample_id, metric, x0, sum(w * r) AS s0, sum(w * r * (x - x0)) AS s1, sum(w * r * (x - x0) * (x - x0)) AS s2,
    sum(w * ry) AS t0, sum(w * ry * (x - x0)) AS t1, max(mean) FILTER (x = x0) AS mean
  FROM weights w JOIN levels{t} USING (sample_id, x) GROUP BY ALL),
fits{t} AS MATERIALIZED (
  SELECT sample_id, metric, x0 AS x, CASE WHEN s0 > 1e-12 THEN t0 / s0
    - s1 / s0 * (t1 / s0 - s1 / s0 * t0 / s0) / greatest(s2 / s0 - s1 / s0 * s1 / s0, 1e-12) ELSE mean END AS fit FROM sums{t})""")
        if t < 3:
            passes.append(f"""
raw{t} AS MATERIALIZED (SELECT p.*, abs(y - fit) AS raw FROM points{t} p JOIN fits{t} USING (sample_id, metric, x)),
gaps{t} AS MATERIALIZED (SELECT * EXCLUDE (raw),
  CASE WHEN raw > 1e-9 * max(raw) OVER (PARTITION BY sample_id, metric) THEN raw ELSE 0 END AS gap FROM raw{t}),
scales{t} AS (SELECT sample_id, metric, 6 * median(gap) AS scale FROM gaps{t} GROUP BY ALL),
ratios{t} AS (SELECT * EXCLUDE (r), CASE WHEN scale > 0 THEN gap / scale WHEN gap > 0 THEN 1.0 ELSE 0.0 END AS u
  FROM gaps{t} JOIN scales{t} USING (sample_id, metric)),
points{t + 1} AS MATERIALIZED (SELECT sample_id, bin_id, metric, x, y,
  pow(1 - pow(CASE WHEN u >= 0.999 THEN 1 WHEN u <= 0.001 THEN 0 ELSE u END, 2), 2) AS r FROM ratios{t})""")
    long = " UNION ALL ".join(
        f"SELECT sample_id, bin_id, '{c}' AS metric, gc_content AS x, {c} AS y FROM dense" for c in gc.METRICS)
    values = ", ".join(
        f"round(max(value) FILTER (metric = '{c}'), 10) AS {c}_gc_corrected" for c in gc.METRICS)
    return "WITH " + dense_sql(gc=GC_SQL) + f""",
long AS MATERIALIZED ({long}),
spread AS (SELECT sample_id, x, count(*) AS n FROM long WHERE metric = '{gc.METRICS[0]}' GROUP BY ALL),
asked AS (SELECT sample_id, greatest(CAST(floor(0.3 * sum(n) + 1e-10) AS BIGINT), 1) AS k FROM spread GROUP BY sample_id),
pairs AS MATERIALIZED (SELECT a.sample_id, a.x AS x0, b.x, abs(b.x - a.x) AS d, sum(b.n) OVER (
    PARTITION BY a.sample_id, a.x ORDER BY abs(b.x - a.x) RANGE UNBOUNDED PRECEDING) AS near
  FROM spread a JOIN spread b USING (sample_id)),
radii AS (SELECT sample_id, x0, min(d) AS h FROM pairs JOIN asked USING (sample_id) WHERE near >= k GROUP BY ALL),
weights AS MATERIALIZED (SELECT sample_id, x0, x, CASE WHEN h > 0 THEN pow(1 - pow(d / h, 3), 3) ELSE 1 END AS w
  FROM pairs JOIN radii USING (sample_id, x0) WHERE d < h OR d = 0),
{",".join(passes)},
corrected AS (
  SELECT sample_id, bin_id, metric, y - fit + median(y) OVER (PARTITION BY sample_id, metric) AS value
  FROM points3 JOIN fits3 USING (sample_id, metric, x))
SELECT sample_id, bin_id, {values} FROM corrected GROUP BY sample_id, bin_id"""


def _corrected_columns(out):
    names = [c + gc.SUFFIX for c in gc.METRICS]
    return rounded(out.select("sample_id", "bin_id", *names), *names, digits=10)


@query(_lowess_sql())
def gc_correct_lowess(spark, sf):
    return _corrected_columns(gc.correct_gc(dense_with_gc(spark, sf)))


@query(_lowess_sql())
def gc_correct_ranged(spark, sf):
    """The same by ranges of gc: several tasks per sample."""
    return _corrected_columns(gc.correct_gc_ranged(dense_with_gc(spark, sf), block=128))


@query("WITH " + CORRECTED_SQL + """
SELECT sample_id, bin_id, coverage_total_gc_corrected, coverage_short_gc_corrected, coverage_long_gc_corrected
FROM corrected""")
def gc_correct_identity(spark, sf):
    return corrected(spark, sf).select(
        "sample_id", "bin_id", *[c + gc.SUFFIX for c in gc.METRICS])


def _linear(metric):
    return f"""round({metric} - (regr_slope({metric}, gc_content) OVER w * gc_content
      + regr_intercept({metric}, gc_content) OVER w) + median({metric}) OVER w, 12) AS {metric}_gc_corrected"""


@query("WITH " + dense_sql(gc=GC_SQL) + f"""
SELECT sample_id, bin_id, {", ".join(_linear(m) for m in gc.METRICS)}
FROM dense WINDOW w AS (PARTITION BY sample_id)""")
def gc_correct_linear(spark, sf):
    out = gc.correct_gc_linear(dense_with_gc(spark, sf))
    names = [c + gc.SUFFIX for c in gc.METRICS]
    return rounded(out.select("sample_id", "bin_id", *names), *names, digits=12)


ARM_SQL = CORRECTED_SQL + "," + v.ARMS + """,
arm_table AS (
  SELECT p.sample_id, replace(a.arm, 'chr', 'arm_chr') AS arm,
    coalesce(avg(c.coverage_total_gc_corrected), 0.0) AS depth, CAST(0 AS DOUBLE) AS z
  FROM samples p CROSS JOIN arms a LEFT JOIN corrected c
    ON c.sample_id = p.sample_id AND c.chrom = a.chrom AND c.start < a."end" AND c."end" > a.start GROUP BY ALL)"""


def arm_table(spark, sf):
    return rg.arm_features(
        corrected(spark, sf), v.arms(spark, sf), v.samples(spark, sf), cv.make_bins(v.chrom_sizes(spark, sf), BIN))


@query("WITH " + ARM_SQL + " SELECT sample_id, arm, round(depth, 12) AS depth, z FROM arm_table")
def arm_features(spark, sf):
    return rounded(arm_table(spark, sf), "depth", digits=12)


@query("WITH " + CORRECTED_SQL + """
SELECT sample_id, 'arm_' || chrom AS arm, round(avg(coverage_total_gc_corrected), 12) AS depth, CAST(0 AS DOUBLE) AS z
FROM corrected GROUP BY sample_id, chrom""")
def chrom_features(spark, sf):
    return rounded(rg.chrom_features(corrected(spark, sf)), "depth", digits=12)


def panel_z(spark, sf):
    arms = rg.chrom_features(corrected(spark, sf))
    healthy = arms.filter(F.substring("sample_id", 2, 9).cast("int") % 3 != 0)
    return rg.with_panel_z(arms, rg.arm_panel(healthy))


CHROM_PANEL_SQL = CORRECTED_SQL + """,
arm_table AS (SELECT sample_id, 'arm_' || chrom AS arm, avg(coverage_total_gc_corrected) AS depth
              FROM corrected GROUP BY sample_id, chrom),
panel AS (SELECT arm, avg(depth) AS panel_mean, stddev_samp(depth) AS panel_sd FROM arm_table
          WHERE CAST(substr(sample_id, 2) AS INT) % 3 <> 0 GROUP BY arm),
panel_z AS (SELECT sample_id, arm, depth,
  coalesce(CASE WHEN panel_sd > 0 THEN (depth - panel_mean) / panel_sd END, 0.0) AS z
  FROM arm_table LEFT JOIN panel USING (arm))"""


@query("WITH " + CHROM_PANEL_SQL + """
SELECT sample_id, arm, round(depth, 12) AS depth, round(z, 6) AS z FROM panel_z""")
def arm_panel_z(spark, sf):
    return rounded(rounded(panel_z(spark, sf), "depth", digits=12), "z", digits=6)


@query("WITH " + CHROM_PANEL_SQL + """
SELECT sample_id, round(avg(abs(z)), 6) AS plasma_aneuploidy_score FROM panel_z GROUP BY sample_id""")
def aneuploidy_score(spark, sf):
    return rounded(rg.aneuploidy_score(panel_z(spark, sf)), "plasma_aneuploidy_score", digits=6)


@query("WITH " + v.RAW + """,
m AS (SELECT sample_id, count(*) FILTER (chrom = 'MT') AS mito_reads, count(*) FILTER (chrom <> 'MT') AS nuclear_reads
      FROM raw GROUP BY sample_id),
f AS (SELECT *, mito_reads / (mito_reads + nuclear_reads) AS mito_fraction FROM m)
SELECT *, round(log10(greatest(mito_fraction, 1e-12)), 9) AS log10_mito_fraction FROM f""")
def mito_features(spark, sf):
    return rounded(rg.mito_features(v.raw_fragments(spark, sf)), "log10_mito_fraction")


MOTIF_SQL = v.FRAGS + """,
ends AS (SELECT sample_id, chrom, s AS p, 'left' AS side, row_number() OVER () AS id, e - 4 AS q FROM frags),
mers AS (
  SELECT sample_id, substring(
      translate(md5(chrom || '|' || (p // 32)), '0123456789abcdef', 'ACGTACGTACGTACGT')
      || translate(md5(chrom || '|' || (p // 32 + 1)), '0123456789abcdef', 'ACGTACGTACGTACGT'), p % 32 + 1, 4) AS l,
    substring(
      translate(md5(chrom || '|' || (q // 32)), '0123456789abcdef', 'ACGTACGTACGTACGT')
      || translate(md5(chrom || '|' || (q // 32 + 1)), '0123456789abcdef', 'ACGTACGTACGTACGT'), q % 32 + 1, 4) AS r
  FROM ends),
counts AS (
  SELECT sample_id, unnest(['left_4mer_' || l, 'right_4mer_' || r, 'combined_4mer_' || l || '_' || r]) AS feature_name
  FROM mers),
motifs AS (SELECT sample_id, feature_name, count(*) AS n FROM counts GROUP BY ALL)"""


def motif_counts(spark, sf, bounded=500):
    return rg.end_motif_counts(v.fragments(spark, sf), v.genome(spark, sf), v.CHUNK, v.TAIL, bounded)


@query("WITH " + MOTIF_SQL + """
SELECT sample_id, feature_name, n / sum(n) OVER (PARTITION BY sample_id) AS value FROM motifs""")
def end_motifs(spark, sf):
    return rg.end_motifs(motif_counts(spark, sf))


@query("WITH " + MOTIF_SQL + " SELECT sample_id, feature_name, n FROM motifs")
def end_motifs_any_length(spark, sf):
    """The plan for fragments without a length bound: one lookup per end."""
    return motif_counts(spark, sf, None)


@query("WITH " + MOTIF_SQL + """,
p AS (SELECT sample_id, n / sum(n) OVER (PARTITION BY sample_id) AS p FROM motifs)
SELECT sample_id, round(-sum(p * log2(p)), 9) AS motif_diversity_score FROM p GROUP BY sample_id""")
def motif_entropy(spark, sf):
    return rounded(rg.motif_diversity(motif_counts(spark, sf), v.samples(spark, sf)), "motif_diversity_score")


def wps_sql(windows, match):
    return f"""
SELECT w.sample_id, w.chrom, w.ws AS start, w.we AS "end", w.name,
  CAST(count(*) FILTER (f.s <= ws AND f.e >= we)
    - count(*) FILTER (f.s BETWEEN ws AND we OR f.e BETWEEN ws AND we) AS BIGINT) AS wps
FROM {windows} w LEFT JOIN frags f ON f.sample_id = w.sample_id AND f.chrom = w.chrom
  AND f.s <= w.we AND f.e >= w.ws {match} GROUP BY ALL"""


@query("WITH " + v.FRAGS + "," + v.SAMPLES + "," + v.REGIONS + """,
windows AS (SELECT sample_id, chrom, (start + "end") // 2 - 60 AS ws, (start + "end") // 2 + 60 AS we, name
            FROM samples CROSS JOIN regions)""" + wps_sql("windows", ""))
def wps(spark, sf):
    return rg.wps(v.fragments(spark, sf), v.regions(spark, sf), v.samples(spark, sf))


FIRST_SQL = v.FRAGS + """,
first AS (SELECT * FROM (SELECT sample_id, chrom, s, e, row_number() OVER
  (PARTITION BY sample_id ORDER BY chrom, s, e, strand, mapq) AS rn FROM frags) WHERE rn <= 100)"""


@query("WITH " + FIRST_SQL + """
SELECT sample_id, chrom, s AS start, e AS "end", 'region_' || (rn - 1) AS name FROM first""")
def wps_default_regions(spark, sf):
    return rg.wps_default_regions(v.fragments(spark, sf))


@query("WITH " + FIRST_SQL + """,
windows AS (SELECT sample_id, chrom, (s + e) // 2 - 60 AS ws, (s + e) // 2 + 60 AS we,
                   'region_' || (rn - 1) AS name FROM first)""" + wps_sql("windows", ""))
def wps_own_regions(spark, sf):
    fragments = v.fragments(spark, sf)
    return rg.wps(fragments, stage(rg.wps_default_regions(fragments), "regions"))
