"""Sample sheets, archive metadata and manifests."""

from pyspark.sql import functions as F

from fragloom.catalog import views as v
from fragloom.catalog.registry import query
from fragloom.functions import text as t
from fragloom.operators import samples as sm
from fragloom.operators.joins import top_rows_per_group
from fragloom.schemas import METADATA_RECORD
from fragloom.sources import writers

# A sheet per order: some ids blank or repeated, inputs in all combinations.
SHEET = """
sheet AS (
  SELECT o_orderkey + 2 AS line,
    CASE WHEN o_orderkey % 97 = 0 THEN '  ' WHEN o_orderkey % 20 = 3 THEN 'S' || (o_orderkey - 1)
         WHEN o_orderkey % 3 = 1 AND o_orderkey % 9 = 4 THEN 'HOT' ELSE 'S' || o_orderkey END AS sample_id,
    CASE WHEN o_orderkey % 7 IN (0, 1) THEN 'r1.fq.gz' WHEN o_orderkey % 7 = 2 THEN 'NA' ELSE '' END AS fastq_1,
    CASE WHEN o_orderkey % 7 IN (0, 3) THEN ' r2.fq.gz' WHEN o_orderkey % 7 = 1 THEN 'None' ELSE '' END AS fastq_2,
    CASE WHEN o_orderkey % 7 = 4 THEN ' a.bam ' WHEN o_orderkey % 7 = 1 THEN 'null' ELSE '' END AS bam,
    CASE WHEN o_orderkey % 7 IN (5, 6) AND o_orderkey % 2 = 0 THEN 'a.cram' ELSE '' END AS cram,
    CASE WHEN o_orderkey % 11 = 0 THEN ' na ' ELSE o_orderstatus END AS label,
    CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE o_orderpriority END AS cancer_type,
    '' AS batch, 'F' AS sex, ' 61 ' AS age, '' AS smoking_status
  FROM orders)"""
MISSING = "('', 'NA', 'na', 'null', 'None')"


def sheet(spark, sf):
    key = F.col("o_orderkey")

    def pick(*cases, otherwise=""):
        out = F
        for condition, value in cases:
            out = out.when(condition, value)
        return out.otherwise(otherwise)

    m7 = key % 7
    return v.table(spark, sf, "orders").select(
        (key + 2).alias("line"),
        pick((key % 97 == 0, "  "), (key % 20 == 3, F.concat(F.lit("S"), (key - 1).cast("string"))),
             ((key % 3 == 1) & (key % 9 == 4), "HOT"),
             otherwise=F.concat(F.lit("S"), key.cast("string"))).alias("sample_id"),
        pick((m7.isin(0, 1), "r1.fq.gz"), (m7 == 2, "NA")).alias("fastq_1"),
        pick((m7.isin(0, 3), " r2.fq.gz"), (m7 == 1, "None")).alias("fastq_2"),
        pick((m7 == 4, " a.bam "), (m7 == 1, "null")).alias("bam"),
        pick((m7.isin(5, 6) & (key % 2 == 0), "a.cram")).alias("cram"),
        pick((key % 11 == 0, " na "), otherwise=F.col("o_orderstatus")).alias("label"),
        pick((key % 13 == 0, ""), otherwise=F.col("o_orderpriority")).alias("cancer_type"),
        F.lit("").alias("batch"), F.lit("F").alias("sex"), F.lit(" 61 ").alias("age"),
        F.lit("").alias("smoking_status"))


FACTS = SHEET + f""",
facts AS (SELECT *, trim(sample_id) AS sid, trim(fastq_1) NOT IN {MISSING} AS f1, trim(fastq_2) NOT IN {MISSING} AS f2,
  trim(bam) NOT IN {MISSING} AS b, trim(cram) NOT IN {MISSING} AS c, trim(label) NOT IN {MISSING} AS l,
  trim(cancer_type) NOT IN {MISSING} AS ct,
  row_number() OVER (PARTITION BY trim(sample_id) ORDER BY line) > 1 AS dup FROM sheet)"""


@query("WITH " + FACTS + """,
m AS (SELECT line, 'sample_id is required' AS t FROM facts WHERE sid = ''
  UNION ALL SELECT line, 'duplicate sample_id ''' || sid || '''' FROM facts WHERE dup
  UNION ALL SELECT line, 'provide exactly one input type: paired FASTQ, BAM, or CRAM' FROM facts
    WHERE CAST(f1 AND f2 AS INT) + CAST(b AS INT) + CAST(c AS INT) <> 1
  UNION ALL SELECT line, 'FASTQ input requires fastq_1 and fastq_2' FROM facts WHERE (f1 OR f2) AND NOT (f1 AND f2)
  UNION ALL SELECT line, 'CRAM input requires --fasta' FROM facts WHERE c
  UNION ALL SELECT line, 'label is required in train mode' FROM facts WHERE NOT l
  UNION ALL SELECT line, 'cancer_type is required for tissue-of-origin training' FROM facts WHERE NOT ct)
SELECT line, 'line ' || line || ': ' || t AS message FROM m""")
def validate_rules(spark, sf):
    return sm.validation_errors(sheet(spark, sf), mode="train", tissue_of_origin=True).select("line", "message")


@query("WITH " + FACTS + " SELECT line, sample_id, dup AS is_duplicate FROM facts")
def validate_duplicates(spark, sf):
    return sm.mark_repeats(sheet(spark, sf)).select("line", "sample_id", "is_duplicate")


@query("WITH " + FACTS + """
SELECT count(*) AS sample_count, count(*) FILTER (f1 AND f2) AS fastq, count(*) FILTER (b) AS bam,
       count(*) FILTER (c) AS cram, CAST(0 AS BIGINT) AS fragments FROM facts""")
def input_counts(spark, sf):
    return sm.input_counts(sheet(spark, sf))


@query("WITH " + FACTS + """
SELECT 'fragloom' AS tool, 'train' AS mode, 'auto' AS input_type, 'hg19' AS genome, 'hg19' AS assembly,
  count(*) AS sample_count, count(*) FILTER (f1 AND f2) AS fastq, count(*) FILTER (b) AS bam,
  count(*) FILTER (c) AS cram FROM facts""")
def run_manifest(spark, sf):
    manifest = writers.run_manifest(sm.input_counts(sheet(spark, sf)), "train", "auto", "hg19")
    return manifest.select("tool", "mode", "input_type", "genome", "assembly", "sample_count",
                           "input_counts.fastq", "input_counts.bam", "input_counts.cram")


@query("WITH " + SHEET + """
SELECT line, trim(sample_id) AS sample_id, trim(fastq_1) AS fastq_1, trim(fastq_2) AS fastq_2, trim(bam) AS bam,
  trim(cram) AS cram, trim(label) AS label, trim(cancer_type) AS cancer_type, trim(batch) AS batch,
  trim(sex) AS sex, trim(age) AS age, trim(smoking_status) AS smoking_status FROM sheet""")
def canonical_sheet(spark, sf):
    return sm.canonical_sheet(sheet(spark, sf))


# A fragment sheet per customer, without sample_id and label columns.
FRAGMENT_SHEET = """
fsheet AS (
  SELECT c_custkey + 2 AS line, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'EE' || c_custkey END AS finaledb_id,
    c_name AS sample_name,
    CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'control' WHEN 2 THEN ' lung_cancer' ELSE 'lung_cancer' END AS cohort,
    'Lung cancer' AS disease, CASE WHEN c_custkey % 3 = 0 THEN 'given' ELSE ' ' END AS cancer_type,
    CASE WHEN c_custkey % 6 = 0 THEN 'entries/EE' || c_custkey || '/x.frag.tsv.bgz' WHEN c_custkey % 6 = 1 THEN 'NA' ELSE '' END AS finaledb_fragment,
    CASE WHEN c_custkey % 6 = 2 THEN ' /data/' || c_custkey || '.bigWig ' WHEN c_custkey % 6 = 1 THEN '/data/' || c_custkey || '.bed.gz' ELSE 'null' END AS local_fragment,
    CASE WHEN c_custkey % 6 = 3 THEN 'https://host.example/' || c_custkey ELSE '' END AS fragment,
    'http://host.example/f/' || c_custkey AS fragment_url, '' AS finaledb_url
  FROM customer)"""


def fragment_sheet(spark, sf):
    key = F.col("c_custkey")
    text, m6 = key.cast("string"), key % 6
    cohort = F.when(key % 4 == 0, "").when(key % 4 == 1, "control").when(key % 4 == 2, " lung_cancer").otherwise("lung_cancer")
    return v.table(spark, sf, "customer").select(
        (key + 2).alias("line"),
        F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("EE"), text)).alias("finaledb_id"),
        F.col("c_name").alias("sample_name"), cohort.alias("cohort"), F.lit("Lung cancer").alias("disease"),
        F.when(key % 3 == 0, "given").otherwise(" ").alias("cancer_type"),
        F.when(m6 == 0, F.concat(F.lit("entries/EE"), text, F.lit("/x.frag.tsv.bgz"))).when(m6 == 1, "NA").otherwise("")
        .alias("finaledb_fragment"),
        F.when(m6 == 2, F.concat(F.lit(" /data/"), text, F.lit(".bigWig "))).when(
            m6 == 1, F.concat(F.lit("/data/"), text, F.lit(".bed.gz"))).otherwise("null").alias("local_fragment"),
        F.when(m6 == 3, F.concat(F.lit("https://host.example/"), text)).otherwise("").alias("fragment"),
        F.concat(F.lit("http://host.example/f/"), text).alias("fragment_url"), F.lit("").alias("finaledb_url"))


@query("WITH " + FRAGMENT_SHEET + """
SELECT line, CASE WHEN finaledb_id <> '' THEN finaledb_id ELSE sample_name END AS sample_id,
  CASE WHEN cohort <> '' THEN cohort ELSE disease END AS label,
  CASE WHEN trim(cancer_type) = '' AND trim(cohort) NOT IN ('', 'control') THEN cohort ELSE cancer_type END AS cancer_type
FROM fsheet""")
def validate_defaults(spark, sf):
    return sm.apply_defaults(fragment_sheet(spark, sf)).select("line", "sample_id", "label", "cancer_type")


DIRECT = FRAGMENT_SHEET + f""",
picked AS (SELECT *, coalesce(CASE WHEN trim(finaledb_fragment) NOT IN {MISSING} THEN trim(finaledb_fragment) END,
  CASE WHEN trim(local_fragment) NOT IN {MISSING} THEN trim(local_fragment) END,
  CASE WHEN trim(fragment) NOT IN {MISSING} THEN trim(fragment) END, '') AS direct FROM fsheet)"""


@query("WITH " + DIRECT + """
SELECT line, direct, CASE WHEN direct <> '' THEN direct ELSE trim(finaledb_fragment) END AS finaledb_fragment,
  CASE WHEN direct LIKE 'entries/%' THEN 'http://finaledb.research.cchmc.org/data/' || direct
       WHEN direct <> '' THEN fragment_url ELSE '' END AS finaledb_url FROM picked""")
def fragment_source(spark, sf):
    return sm.resolve_sources(fragment_sheet(spark, sf)).select("line", "direct", "finaledb_fragment", "finaledb_url")


@query("WITH " + DIRECT + """
SELECT line, 'line ' || line || ': unsupported fragment extension ''' || direct || '''' AS message FROM picked
  WHERE direct LIKE '%.bigWig'
UNION ALL SELECT line, 'line ' || line || ': fragment input requires a fragment column or metadata_json' FROM picked WHERE direct = ''""")
def fragment_sheet_rules(spark, sf):
    df = sm.apply_defaults(fragment_sheet(spark, sf))
    return sm.validation_errors(df, input_type=sm.FRAGMENT_INPUT).select("line", "message")


# --- archive metadata --------------------------------------------------------------------

# One JSON record per customer: structured entries, only nested strings, or nothing usable.
RECORDS = """
recs AS (
  SELECT c_custkey AS id, c_custkey * 7919 * 13 % 120000000 AS frag_num, c_custkey % 4 AS kind,
    CASE WHEN c_custkey % 3 = 0 THEN 'Healthy' WHEN c_custkey % 3 = 1 THEN 'Lung cancer' ELSE 'Other' END AS disease,
    CASE WHEN c_custkey % 10 = 0 THEN 'urine' ELSE 'blood plasma' END AS tissue,
    CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'P ' || c_custkey || '#1' END AS sample_name,
    'entries/EE' || c_custkey || '/hg19/EE' || c_custkey || '.hg19.frag.tsv.bgz' AS key
  FROM customer)"""


def records(spark, sf):
    key = F.col("c_custkey")
    text = key.cast("string")
    kind = key % 4
    disease = F.when(key % 3 == 0, "Healthy").when(key % 3 == 1, "Lung cancer").otherwise("Other")
    tissue = F.when(key % 10 == 0, "urine").otherwise("blood plasma")
    name = F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("P "), text, F.lit("#1")))
    path = F.concat(F.lit("entries/EE"), text, F.lit("/hg19/EE"), text, F.lit(".hg19.frag.tsv.bgz"))
    profile = F.concat(F.lit('{"desc":"fragment profile","type":"tsv","key":"entries/p.frag_profile.frag.tsv.bgz"},'))
    structured = F.concat(F.lit('"analysis":{"hg19":['), profile, F.lit('{"desc":" Fragment ","type":"TSV","key":"'),
                          path, F.lit('"}]}'))
    nested = F.concat(F.lit('"files":{"a.frag.gz":["x.frag.bedgraph.gz",{"u":"'), path, F.lit('"}]}'))
    bed = F.concat(F.lit('"analysis":{"hg19":[{"desc":"fragment","type":"bed","key":"/data/b'), text, F.lit('.bed.gz"}]}'))
    body = F.when(kind == 0, structured).when(kind == 1, nested).when(kind == 2, bed).otherwise('"analysis":{}')
    json = F.concat(
        F.lit('{"id":'), text, F.lit(',"frag_num":'), (key * 7919 * 13 % 120000000).cast("string"),
        F.lit(',"sample":{"name":"'), name, F.lit('","disease":"'), disease, F.lit('","tissue":"'), tissue,
        F.lit('"},'), body, F.lit("}"))
    parsed = v.table(spark, sf, "customer").select(json.alias("json"), F.from_json(json, METADATA_RECORD).alias("r"))
    return parsed.select("json", "r.*")


BASE = "http://finaledb.research.cchmc.org"


@query("WITH " + RECORDS + f"""
SELECT id, CASE WHEN kind = 0 THEN key END AS metadata_key,
  CASE WHEN kind = 0 THEN '{BASE}/data/' || key END AS url FROM recs""")
def metadata_key(spark, sf):
    df = records(spark, sf)
    key = sm.find_fragment_key(F.struct("analysis"), "hg19")
    return df.select("id", key.alias("metadata_key")).withColumn(
        "url", t.build_download_url(F.col("metadata_key")))


@query("WITH " + DIRECT + "," + RECORDS.strip() + f""",
found AS (SELECT p.*, p.line - 2 AS ckey, r.id IS NOT NULL AS metadata_found, CASE WHEN r.kind = 0 THEN r.key END AS metadata_key
  FROM picked p LEFT JOIN recs r ON (p.line - 2) % 3 <> 0 AND r.id = p.line - 2 AND r.id % 10 <> 7)
SELECT line, CASE WHEN ckey % 3 = 0 THEN '' ELSE 'm' || ckey END AS metadata_path, metadata_found, metadata_key,
  CASE WHEN direct <> '' THEN direct WHEN metadata_key IS NOT NULL THEN metadata_key ELSE trim(finaledb_fragment) END AS finaledb_fragment,
  CASE WHEN metadata_key IS NOT NULL THEN '{BASE}/data/' || metadata_key WHEN direct LIKE 'entries/%' THEN '{BASE}/data/' || direct
    WHEN direct <> '' THEN fragment_url ELSE '' END AS finaledb_url FROM found""")
def resolved_sources(spark, sf):
    """Sources of a sheet whose lines name metadata records: a third names none, some records are missing."""
    key = F.col("line") - 2
    lines = fragment_sheet(spark, sf).withColumn(
        "metadata_json", F.when(key % 3 == 0, "  ").otherwise(F.concat(F.lit(" m"), key.cast("string"))))
    metadata = records(spark, sf).filter(F.col("id").cast("long") % 10 != 7).select(
        F.concat(F.lit("m"), F.col("id").cast("string")).alias("metadata_json"), "json")
    found = sm.resolve_sources(lines, metadata, "hg19")
    return found.select("line", "metadata_path", "metadata_found", "metadata_key", "finaledb_fragment", "finaledb_url")


URLS = RECORDS + f""",
urls AS (SELECT *, CASE kind WHEN 0 THEN '{BASE}/data/' || key WHEN 1 THEN '{BASE}/data/' || key
  WHEN 2 THEN '{BASE}/data/b' || id || '.bed.gz' END AS url FROM recs)"""


@query("WITH " + URLS + " SELECT id, url FROM urls WHERE url IS NOT NULL")
def fragment_urls(spark, sf):
    found = records(spark, sf).select("id", sm.discover_fragment_urls(F.col("json"), "any").alias("urls"))
    return found.select("id", F.explode("urls").alias("url"))


@query("WITH " + URLS + """,
picked AS (
  (SELECT 'control' AS cohort, * FROM urls WHERE disease = 'Healthy' AND tissue = 'blood plasma'
     AND frag_num BETWEEN 5000000 AND 100000000 ORDER BY id LIMIT 25)
  UNION ALL
  (SELECT 'lung_cancer', * FROM urls WHERE disease = 'Lung cancer' AND tissue = 'blood plasma'
     AND frag_num BETWEEN 5000000 AND 100000000 ORDER BY id LIMIT 25))
SELECT cohort, 'EE' || id AS finaledb_id, CASE WHEN sample_name <> '' THEN sample_name ELSE 'EE' || id END AS sample_name,
  disease, tissue, 'hg19' AS assembly, url AS fragment_url,
  'out/fragments/' || cohort || '/EE' || id || '_' || CASE WHEN sample_name <> '' THEN 'P_' || id || '_1' ELSE 'EE' || id END
    || '_hg19' || CASE WHEN kind = 2 THEN '.bed.gz' ELSE '.frag.tsv.gz' END AS local_fragment,
  'out/metadata_json/EE' || id || '.json' AS metadata_json
FROM picked WHERE url IS NOT NULL""")
def cohort_manifest(spark, sf):
    chosen = sm.select_cohorts(records(spark, sf), {
        "control": ("Healthy", 25), "lung_cancer": ("Lung cancer", 25)})
    return sm.cohort_manifest(chosen, "out")


@query("""SELECT c_mktsegment, c_custkey FROM (SELECT c_mktsegment, c_custkey,
  row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) WHERE rn <= 5""")
def first_per_group(spark, sf):
    rows = v.table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    order = [F.col("c_acctbal").desc(), F.col("c_custkey")]
    return top_rows_per_group(rows, ["c_mktsegment"], order, 5).select("c_mktsegment", "c_custkey")
