"""Feature table, matrix, dictionary and summary."""

from pyspark.sql import functions as F

from fragloom.catalog import views as v
from fragloom.catalog.coverage_queries import ARM_SQL, CORRECTED_SQL, arm_table, corrected
from fragloom.catalog.registry import query, rounded
from fragloom.operators import matrix as mx, regions as rg
from fragloom.session import stage, stage_path
from fragloom.sources.readers import read_wide_lines, split_matrix
from fragloom.sources.writers import write_wide_lines

NAMED = "'bin_' || translate(bin_id, ':-', '__') || '_"
PLAIN_SQL = CORRECTED_SQL + ",\nplain AS (" + " UNION ALL ".join(
    f"SELECT sample_id, {NAMED}{name}' AS feature_name, CAST({column} AS DOUBLE) AS value FROM corrected"
    for name, column in mx.BIN_METRICS.items()) + ")"


@query("WITH " + PLAIN_SQL + " SELECT * FROM plain")
def bin_features_long(spark, sf):
    return mx.bin_features(corrected(spark, sf))


Z_SQL = CORRECTED_SQL + """,
u AS (""" + " UNION ALL ".join(
    f"SELECT sample_id, bin_id, '{name}' AS metric, {mx.BIN_METRICS[name]} AS x FROM corrected"
    for name in mx.Z_METRICS) + """),
z AS (SELECT *, avg(x) OVER w AS mu, stddev_samp(x) OVER w AS sd FROM u WINDOW w AS (PARTITION BY sample_id, metric))
SELECT sample_id, 'bin_' || translate(bin_id, ':-', '__') || '_' || metric || '_sample_z' AS feature_name,
       round((x - mu) / CASE WHEN sd = 0 THEN 1.0 ELSE sd END, 9) AS value FROM z"""


@query("WITH " + Z_SQL)
def sample_zscore(spark, sf):
    return rounded(mx.sample_z_features(corrected(spark, sf)), "value")


def _mito(spark, sf):
    mito = rg.mito_features(v.raw_fragments(spark, sf))
    return mx.scalar_features(mito.select("sample_id", "mito_reads", "mito_fraction"))


# Later groups replace equal names: per-contig sums of the fragments of both kinds.
GROUPS_SQL = v.FRAGS + """,
first_group AS (SELECT sample_id, 'frag_' || chrom AS feature_name, CAST(count(*) AS DOUBLE) AS value
                FROM raw GROUP BY ALL),
second_group AS (SELECT sample_id, 'frag_' || replace(chrom, 'chr1', '1') AS feature_name,
                CAST(sum(length) AS DOUBLE) AS value FROM frags WHERE chrom LIKE 'chr1%' GROUP BY ALL),
mito_group AS (
  SELECT sample_id, 'mito_reads' AS feature_name, CAST(count(*) FILTER (chrom = 'MT') AS DOUBLE) AS value FROM raw GROUP BY 1
  UNION ALL SELECT sample_id, 'mito_fraction', count(*) FILTER (chrom = 'MT') / count(*) FROM raw GROUP BY 1),
feats AS (
  SELECT * FROM mito_group UNION ALL SELECT * FROM second_group
  UNION ALL SELECT * FROM first_group ANTI JOIN second_group USING (sample_id, feature_name))"""


def feature_groups(spark, sf):
    raw, frags = v.raw_fragments(spark, sf), v.fragments(spark, sf)
    first = raw.groupBy("sample_id", F.concat(F.lit("frag_"), "chrom").alias("feature_name")).agg(
        F.count(F.lit(1)).cast("double").alias("value"))
    name = F.concat(F.lit("frag_"), F.regexp_replace("chrom", "chr1", "1"))
    second = frags.filter(F.col("chrom").startswith("chr1")).groupBy("sample_id", name.alias("feature_name")).agg(
        F.sum("length").cast("double").alias("value"))
    return mx.union_features(first, second, _mito(spark, sf))


@query("WITH " + GROUPS_SQL + " SELECT sample_id, feature_name, value FROM feats")
def feature_union(spark, sf):
    return feature_groups(spark, sf)


# The sheet lists samples in reverse key order; five samples are not listed, some have no features.
SHEET_SQL = """
sheet AS (
  SELECT 's' || lpad(CAST(c_custkey % 50 + 5 AS VARCHAR), 2, '0') AS sample_id, 100 - c_custkey % 50 AS line,
         CASE WHEN c_custkey % 50 % 3 = 0 THEN 'lung_cancer' ELSE 'control' END AS label,
         'b' || (c_custkey % 50 % 4) AS batch
  FROM customer GROUP BY ALL)"""


def sheet(spark, sf):
    key = F.col("c_custkey") % 50
    return v.table(spark, sf, "customer").select(
        F.concat(F.lit("s"), F.lpad((key + 5).cast("string"), 2, "0")).alias("sample_id"), (100 - key).alias("line"),
        F.when(key % 3 == 0, "lung_cancer").otherwise("control").alias("label"),
        F.concat(F.lit("b"), (key % 4).cast("string")).alias("batch")).distinct()


@query("WITH " + GROUPS_SQL + "," + SHEET_SQL + """
SELECT sample_id, label, batch, line IS NULL AS unlisted, line AS sheet_line
FROM (SELECT DISTINCT sample_id FROM feats) f LEFT JOIN sheet USING (sample_id)""")
def feature_metadata_join(spark, sf):
    return mx.attach_metadata(feature_groups(spark, sf), sheet(spark, sf))


WIDE_COLUMNS = ", ".join(
    f"max(value) FILTER (feature_name = '{name}') AS \"{name}\""
    for name in [f"frag_{c}" for c in [*range(1, 23), "X", "MT"]] + ["mito_fraction", "mito_reads"])


@query("WITH " + GROUPS_SQL + f" SELECT sample_id, {WIDE_COLUMNS} FROM feats GROUP BY sample_id")
def feature_pivot(spark, sf):
    return mx.pivot_features(feature_groups(spark, sf))


@query("WITH " + GROUPS_SQL + "," + SHEET_SQL + f"""
SELECT sample_id, label, batch, {WIDE_COLUMNS} FROM feats LEFT JOIN sheet USING (sample_id) GROUP BY ALL""")
def wide_matrix(spark, sf):
    features = stage(feature_groups(spark, sf), "groups")
    return mx.wide_matrix(features, mx.attach_metadata(features, sheet(spark, sf)))


BROAD_SQL = """broad AS (
  SELECT l_returnflag || l_linestatus AS sample_id, 'f' || l_orderkey || '_' || l_linenumber AS feature_name,
    max(CAST(l_quantity AS BIGINT)) AS value FROM lineitem GROUP BY ALL)"""


def broad(spark, sf):
    """A feature for every order line: as many columns as lines, few samples."""
    text = lambda c: F.col(c).cast("string")
    return v.table(spark, sf, "lineitem").groupBy(
        F.concat("l_returnflag", "l_linestatus").alias("sample_id"),
        F.concat(F.lit("f"), text("l_orderkey"), F.lit("_"), text("l_linenumber")).alias("feature_name"),
    ).agg(F.max(F.col("l_quantity").cast("long")).alias("value"))


def broad_pieces(spark, sf):
    features = stage(broad(spark, sf), "broad")
    metadata = features.select("sample_id").distinct().withColumns(
        {"unlisted": F.lit(True), "sheet_line": F.lit(None).cast("long")})
    return mx.wide_pieces(features, metadata)


@query("WITH " + BROAD_SQL + """,
names AS (SELECT DISTINCT feature_name FROM broad), samples AS (SELECT DISTINCT sample_id FROM broad),
lines AS (
  SELECT sample_id, row_number() OVER (ORDER BY sample_id) AS row, sample_id || chr(9) || line AS line FROM (
    SELECT sample_id, string_agg(coalesce(CAST(value AS VARCHAR), ''), chr(9) ORDER BY feature_name) AS line
    FROM samples CROSS JOIN names LEFT JOIN broad USING (sample_id, feature_name) GROUP BY sample_id)
  UNION ALL
  SELECT '', 0, 'sample_id' || chr(9) || string_agg(feature_name, chr(9) ORDER BY feature_name) FROM names)
SELECT row, md5(line) AS digest, CAST(length(line) AS BIGINT) AS n_chars FROM lines""")
def wide_matrix_text(spark, sf):
    """The wide matrix as text, with a column for every order line."""
    return mx.line_digests(broad_pieces(spark, sf))


@query("WITH " + BROAD_SQL + " SELECT sample_id, feature_name, CAST(value AS VARCHAR) AS value FROM broad")
def read_wide_text(spark, sf):
    """The same matrix written as text and read back into long features; missing cells are empty."""
    path = stage_path(spark, "wide")
    write_wide_lines(broad_pieces(spark, sf), path)
    return read_wide_lines(spark, path)[1].filter("value <> ''")


@query("WITH " + PLAIN_SQL + """,
names AS (SELECT DISTINCT feature_name FROM plain)
SELECT feature_name, split_part(feature_name, '_', 1) AS feature_group,
  'Transparent public-literature fragmentomics feature' AS description, 'bin_or_summary' AS genomic_region,
  'GC corrected and/or sample standardized where indicated' AS normalization,
  feature_name LIKE '%\\_z' ESCAPE '\\' AS requires_reference_panel
FROM names UNION ALL
SELECT DISTINCT 'bin_' || translate(bin_id, ':-', '__') || '_' || m || '_sample_z', 'bin',
  'Transparent public-literature fragmentomics feature', 'bin_or_summary',
  'GC corrected and/or sample standardized where indicated', true
FROM corrected, (VALUES ('total_gc_corrected'), ('short_gc_corrected'), ('short_long_ratio')) t(m)""")
def feature_dictionary(spark, sf):
    return mx.feature_dictionary(mx.all_bin_features(corrected(spark, sf)))


@query("WITH " + GROUPS_SQL + """
SELECT count(DISTINCT sample_id) AS n_samples, count(DISTINCT feature_name) AS n_features,
  (SELECT string_agg(g, ',' ORDER BY g) FROM (SELECT DISTINCT split_part(feature_name, '_', 1) AS g FROM feats)) AS feature_groups
FROM feats""")
def feature_summary(spark, sf):
    return mx.feature_summary(feature_groups(spark, sf))


@query("""SELECT 'c' || c_custkey AS sample_id, unnest(['acctbal', 'nation', 'constant']) AS feature_name,
  unnest([c_acctbal, CAST(c_nationkey AS DOUBLE), CAST(4 AS DOUBLE)]) AS value FROM customer""")
def matrix_unpivot(spark, sf):
    wide = v.table(spark, sf, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("sample_id"),
        F.col("c_mktsegment").alias("label"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_nationkey").cast("double").alias("nation"), F.lit(4.0).alias("constant"))
    long = split_matrix(wide, ["sample_id", "label"])[1]
    return long.withColumn("value", F.col("value").cast("double"))


@query("WITH " + GROUPS_SQL + " SELECT feature_name, value FROM feats WHERE sample_id = 's07'")
def sample_report(spark, sf):
    from fragloom.operators.analysis import sample_report as report
    return report(feature_groups(spark, sf), "s07")


@query("WITH " + ARM_SQL + """
SELECT sample_id, arm || '_gc_corrected_depth' AS feature_name, round(depth, 12) AS value FROM arm_table
UNION ALL SELECT sample_id, arm || '_z', z FROM arm_table
UNION ALL SELECT sample_id, 'plasma_aneuploidy_score', avg(abs(z)) FROM arm_table GROUP BY sample_id""")
def arm_feature_group(spark, sf):
    return rounded(rg.arm_long(arm_table(spark, sf)), "value", digits=12)
