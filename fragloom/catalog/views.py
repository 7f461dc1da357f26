"""Deterministic domain views over the driver tables, as DataFrames and as SQL.

Fragments, alignments, sample sheets, cohorts and scores are projections of the given
tables, so the work of every registered query grows with them. The SQL texts are the
DuckDB side of the same definitions.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from fragloom.session import shuffle_tasks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys) -> DataFrame:
    """Input files with fewer row groups than there are cores leave cores idle: then rows
    are spread by a hash of their keys. Larger inputs have splits enough and stay."""
    context = df.sparkSession.sparkContext
    tasks = context.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks, *keys)


def lineitem(spark, sf_dir) -> DataFrame:
    return spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


# --- fragments -----------------------------------------------------------------

RAW = """
raw AS (
  SELECT 's' || lpad(CAST(l_partkey % 40 AS VARCHAR), 2, '0') AS sample_id,
         CASE (l_orderkey + l_linenumber) % 24 WHEN 0 THEN 'MT' WHEN 23 THEN 'X'
              ELSE CAST((l_orderkey + l_linenumber) % 24 AS VARCHAR) END AS chrom,
         (l_orderkey*7919 + l_linenumber*104729 + l_partkey*31) % 2000000 AS s,
         (l_orderkey*7919 + l_linenumber*104729 + l_partkey*31) % 2000000
           + 30 + (l_orderkey*13 + l_partkey*7 + l_linenumber*29) % 500 AS e,
         (l_suppkey*3 + l_linenumber*17 + l_partkey) % 61 AS mapq,
         CASE WHEN l_returnflag = 'A' THEN '-' ELSE '+' END AS strand
  FROM lineitem)"""

FRAGS = RAW + """,
frags AS (
  SELECT sample_id, CASE WHEN chrom = 'MT' THEN 'chrM' ELSE 'chr' || chrom END AS chrom,
         s, e, mapq, strand, e - s AS length,
         (e - s) BETWEEN 100 AND 150 AS is_short, (e - s) BETWEEN 151 AND 220 AS is_long
  FROM raw WHERE mapq >= 30 AND e - s BETWEEN 50 AND 500)"""

SAMPLES = """
samples AS (
  SELECT DISTINCT 's' || lpad(CAST(l_partkey % 40 AS VARCHAR), 2, '0') AS sample_id FROM lineitem)"""

SIZES = """
sizes AS (
  SELECT CASE WHEN chrom = 'MT' THEN 'chrM' ELSE 'chr' || chrom END AS chrom, max(e) AS size
  FROM raw GROUP BY 1)"""


def _sample_id():
    return F.concat(F.lit("s"), F.lpad((F.col("l_partkey") % 40).cast("string"), 2, "0"))


def raw_fragments(spark, sf_dir, *extra, spread_rows: bool = True) -> DataFrame:
    li = lineitem(spark, sf_dir) if spread_rows else table(spark, sf_dir, "lineitem")
    order, line, part, supp = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    contig = (order + line) % 24
    start = (order * 7919 + line * 104729 + part * 31) % 2000000
    return li.select(
        _sample_id().alias("sample_id"),
        F.when(contig == 0, "MT").when(contig == 23, "X").otherwise(contig.cast("string")).alias("chrom"),
        start.alias("start"),
        (start + 30 + (order * 13 + part * 7 + line * 29) % 500).alias("end"),
        ((supp * 3 + line * 17 + part) % 61).alias("mapq"),
        F.when(F.col("l_returnflag") == "A", "-").otherwise("+").alias("strand"),
        *extra,
    )


def fragments(spark, sf_dir) -> DataFrame:
    from fragloom.operators.fragments import ingest
    return ingest(raw_fragments(spark, sf_dir), "chr")


def samples(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(_sample_id().alias("sample_id")).distinct()


def chrom_sizes(spark, sf_dir) -> DataFrame:
    from fragloom.functions.chrom import normalize_chrom
    raw = raw_fragments(spark, sf_dir, spread_rows=False)  # one light aggregate: no shuffle of rows pays
    return raw.groupBy(normalize_chrom(F.col("chrom"), "chr").alias("chrom")).agg(
        F.max("end").alias("size"))


# --- copies of fragments -----------------------------------------------------------

# Part keys over 40 share positions, so that groups of copies exist.
COPIES = """
copies AS (
  SELECT 's' || lpad(CAST(l_suppkey % 40 AS VARCHAR), 2, '0') AS sample_id,
         CAST(l_linenumber AS VARCHAR) AS chrom, l_partkey % 50 * 1000 AS s, l_partkey % 50 * 1000 + 167 AS e,
         CASE WHEN l_returnflag = 'A' THEN '-' ELSE '+' END AS strand,
         (l_suppkey*3 + l_linenumber*17 + l_partkey) % 61 AS mapq,
         'r' || l_orderkey || '_' || l_linenumber || '_' || l_partkey AS qname
  FROM lineitem)"""


def copies(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    start = F.col("l_partkey") % 50 * 1000
    return li.select(
        F.concat(F.lit("s"), F.lpad((F.col("l_suppkey") % 40).cast("string"), 2, "0")).alias("sample_id"),
        F.col("l_linenumber").cast("string").alias("chrom"), start.alias("start"), (start + 167).alias("end"),
        F.when(F.col("l_returnflag") == "A", "-").otherwise("+").alias("strand"),
        ((F.col("l_suppkey") * 3 + F.col("l_linenumber") * 17 + F.col("l_partkey")) % 61).alias("mapq"),
        F.concat(F.lit("r"), F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string"),
                 F.lit("_"), F.col("l_partkey").cast("string")).alias("qname"))


# --- alignments --------------------------------------------------------------------

ALIGNMENTS = """
aligned AS (
  SELECT 's' || lpad(CAST(l_partkey % 40 AS VARCHAR), 2, '0') AS sample_id,
         'r' || l_orderkey || '_' || l_linenumber AS qname,
         'chr' || ((l_orderkey + l_linenumber) % 22 + 1) AS rname,
         (l_orderkey*7919 + l_linenumber*104729 + l_partkey*31) % 2000000 AS s,
         30 + (l_orderkey*13 + l_partkey*7 + l_linenumber*29) % 500 AS len,
         (l_suppkey*3 + l_linenumber*17 + l_partkey) % 61 AS mapq,
         l_returnflag = 'A' AS rev, l_orderkey + l_linenumber*3 + l_partkey AS k
  FROM lineitem),
alignments AS (
  SELECT sample_id, qname, rname, mapq,
    1 + CASE WHEN k % 5 <> 0 THEN 2 ELSE 0 END + CASE WHEN k % 17 = 0 THEN 4 ELSE 0 END
      + CASE WHEN k % 19 = 0 THEN 8 ELSE 0 END + CASE WHEN rev THEN 16 ELSE 0 END
      + CASE WHEN k % 3 = 0 THEN 128 ELSE 64 END + CASE WHEN k % 13 = 0 THEN 256 ELSE 0 END
      + CASE WHEN k % 23 = 0 THEN 512 ELSE 0 END + CASE WHEN k % 11 = 0 THEN 1024 ELSE 0 END
      + CASE WHEN k % 29 = 0 THEN 2048 ELSE 0 END AS flag,
    CASE WHEN rev THEN s + len - 50 ELSE s END + 1 AS pos,
    CASE WHEN rev THEN s ELSE s + len - 50 END + 1 AS pnext,
    CASE WHEN k % 31 = 0 THEN 0 WHEN rev THEN -len ELSE len END AS tlen
  FROM aligned)"""


def alignments(spark, sf_dir) -> DataFrame:
    li = lineitem(spark, sf_dir)
    order, line, part, supp = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    k = order + line * 3 + part
    rev = F.col("l_returnflag") == "A"
    start = (order * 7919 + line * 104729 + part * 31) % 2000000
    length = 30 + (order * 13 + part * 7 + line * 29) % 500
    other = start + length - 50

    def bit(condition, value):
        return F.when(condition, value).otherwise(0)

    flag = (
        F.lit(1) + bit(k % 5 != 0, 2) + bit(k % 17 == 0, 4) + bit(k % 19 == 0, 8) + bit(rev, 16)
        + F.when(k % 3 == 0, 128).otherwise(64) + bit(k % 13 == 0, 256) + bit(k % 23 == 0, 512)
        + bit(k % 11 == 0, 1024) + bit(k % 29 == 0, 2048))
    return li.select(
        _sample_id().alias("sample_id"),
        F.concat(F.lit("r"), order.cast("string"), F.lit("_"), line.cast("string")).alias("qname"),
        F.concat(F.lit("chr"), ((order + line) % 22 + 1).cast("string")).alias("rname"),
        ((supp * 3 + line * 17 + part) % 61).alias("mapq"), flag.alias("flag"),
        (F.when(rev, other).otherwise(start) + 1).alias("pos"),
        (F.when(rev, start).otherwise(other) + 1).alias("pnext"),
        F.when(k % 31 == 0, F.lit(0)).when(rev, -length).otherwise(length).alias("tlen"))


# --- regions -----------------------------------------------------------------------

MASKS = """
masks AS (
  SELECT 'chr' || (s_suppkey % 22 + 1) AS chrom, s_suppkey * 104729 % 2000000 AS r_start,
         s_suppkey * 104729 % 2000000 + 2000 + s_suppkey * 7919 % 30000 AS r_end FROM supplier)"""

REGIONS = """
regions AS (
  SELECT 'chr' || (p_partkey % 22 + 1) AS chrom, p_partkey * 7919 % 2000000 AS start,
         p_partkey * 7919 % 2000000 + 500 AS "end", 'gene' || p_partkey AS name FROM part)"""

ARMS = """
arms AS (
  SELECT chrom, 0 AS start, 930000 AS "end", chrom || 'p' AS arm FROM sizes
  UNION ALL SELECT chrom, 930000, size, chrom || 'q' FROM sizes)"""


def masks(spark, sf_dir) -> DataFrame:
    key = F.col("s_suppkey")
    start = key * 104729 % 2000000
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("chr"), (key % 22 + 1).cast("string")).alias("chrom"), start.alias("r_start"),
        (start + 2000 + key * 7919 % 30000).alias("r_end"))


def regions(spark, sf_dir) -> DataFrame:
    key = F.col("p_partkey")
    start = key * 7919 % 2000000
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("chr"), (key % 22 + 1).cast("string")).alias("chrom"), start.alias("start"),
        (start + 500).alias("end"), F.concat(F.lit("gene"), key.cast("string")).alias("name"))


def arms(spark, sf_dir) -> DataFrame:
    middle, zero = F.lit(930000).cast("long"), F.lit(0).cast("long")
    return chrom_sizes(spark, sf_dir).select("chrom", F.explode(F.array(
        F.struct(zero.alias("start"), middle.alias("end"), F.concat("chrom", F.lit("p")).alias("arm")),
        F.struct(middle.alias("start"), F.col("size").alias("end"), F.concat("chrom", F.lit("q")).alias("arm")),
    )).alias("a")).select("chrom", "a.*")


# --- reference sequence ---------------------------------------------------------------

HEX, BASES = "0123456789abcdef", "ACGTACGTACGTACGT"
LETTERS, LETTER_BASES = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTNN"
CHUNK, TAIL = 4096, 512


def genome(spark, sf_dir) -> DataFrame:
    """Sequence chunks of the contigs that the fragments cover; 32 bases per hash."""
    piece = lambda i: F.translate(
        F.md5(F.concat(F.col("chrom"), F.lit("|"), i.cast("string"))), HEX, BASES)
    last = F.floor((F.col("size") - 1) / F.lit(CHUNK)).cast("long")
    per_chunk, pieces = CHUNK // 32, (CHUNK + TAIL) // 32
    start = F.col("chunk") * CHUNK
    sequence = F.array_join(F.transform(
        F.sequence(F.col("chunk") * per_chunk, F.col("chunk") * per_chunk + pieces - 1), piece), "")
    return (
        chrom_sizes(spark, sf_dir)
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        # Few short rows, much hashing: a stated number of tasks is not merged by size.
        .repartition(shuffle_tasks(spark), "chrom", "chunk")
        .select("chrom", "chunk", start.alias("start"),
                F.least(start + CHUNK, F.col("size")).alias("end"),
                F.substring(sequence, F.lit(1), (F.col("size") - start).cast("int")).alias("seq")))


def document_contigs(spark, sf_dir) -> DataFrame:
    """Each document as a contig: letters stand for bases, everything else stays."""
    return spread(table(spark, sf_dir, "documents"), "doc_id").select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("chrom"),
        F.translate("text", LETTERS, LETTER_BASES).alias("sequence"))


# --- scored cohort --------------------------------------------------------------------

SCORED = """
scored AS (
  SELECT 'c' || c_custkey AS sample_id, (c_custkey*7919 % 997) / CAST(1000 AS DOUBLE) AS cancer_probability,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'lung_cancer' WHEN 'MACHINERY' THEN ' Case '
      WHEN 'AUTOMOBILE' THEN 'control' WHEN 'FURNITURE' THEN 'Healthy' END AS label,
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 1 ELSE 0 END AS y_true,
    CASE WHEN c_custkey % 4 = 0 THEN 'test' ELSE 'train' END AS "partition"
  FROM customer)"""


def scored(spark, sf_dir) -> DataFrame:
    segment, key = F.col("c_mktsegment"), F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), key.cast("string")).alias("sample_id"),
        ((key * 7919 % 997) / F.lit(1000.0)).alias("cancer_probability"),
        F.when(segment == "BUILDING", "lung_cancer").when(segment == "MACHINERY", " Case ")
        .when(segment == "AUTOMOBILE", "control").when(segment == "FURNITURE", "Healthy").alias("label"),
        F.when(segment.isin("BUILDING", "MACHINERY"), 1).otherwise(0).alias("y_true"),
        F.when(key % 4 == 0, "test").otherwise("train").alias("partition"))


# --- cohort with long features ------------------------------------------------------------

COHORT = """
cohort AS (
  SELECT 'k' || s_suppkey AS sample_id,
    CASE s_suppkey % 3 WHEN 0 THEN 'lung_cancer' WHEN 1 THEN 'control' ELSE 'Healthy' END AS label,
    CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END AS y FROM supplier),
long0 AS (
  SELECT l_suppkey, l_orderkey % 50 AS f, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY ALL),
feats AS (
  SELECT 'k' || l_suppkey AS sample_id, 'f' || lpad(CAST(f AS VARCHAR), 2, '0') AS feature_name,
    CASE WHEN f = 7 THEN CAST(4 AS DOUBLE) WHEN q % 11 = 0 OR f = 13 THEN NULL
      ELSE CAST(q + CASE WHEN l_suppkey % 3 = 0 THEN f * 3 ELSE 0 END AS DOUBLE) END AS value FROM long0)"""


def cohort(spark, sf_dir) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("k"), key.cast("string")).alias("sample_id"),
        F.when(key % 3 == 0, "lung_cancer").when(key % 3 == 1, "control").otherwise("Healthy").alias("label"),
        F.when(key % 3 == 0, 1).otherwise(0).alias("y"))


def cohort_features(spark, sf_dir) -> DataFrame:
    """Sums of quantities as features: one constant, one all-missing, some gaps, and a
    shift for cases that grows with the feature number."""
    long = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", (F.col("l_orderkey") % 50).alias("f"))
        .agg(F.sum("l_quantity").cast("long").alias("q")))
    f, q = F.col("f"), F.col("q")
    shift = F.when(F.col("l_suppkey") % 3 == 0, f * 3).otherwise(0)
    value = F.when(f == 7, 4.0).when((q % 11 == 0) | (f == 13), None).otherwise((q + shift).cast("double"))
    return long.select(
        F.concat(F.lit("k"), F.col("l_suppkey").cast("string")).alias("sample_id"),
        F.concat(F.lit("f"), F.lpad(f.cast("string"), 2, "0")).alias("feature_name"), value.alias("value"))
