"""Sources and sinks: tables derived from the given ones, written and read back."""

import uuid

from pyspark.sql import functions as F

from fragloom.catalog import views as v
from fragloom.catalog.coverage_queries import CORRECTED_SQL, bins_sql, corrected, dense_sql, tiles
from fragloom.catalog.fragment_queries import FRAGMENT_SQL
from fragloom.catalog.registry import query
from fragloom.catalog.sample_queries import SHEET, RECORDS, records, sheet
from fragloom.operators import coverage as cv, fragments as fr
from fragloom.session import stage_path
from fragloom.sources import readers as rd, writers as wr
from fragloom.sources.fragment_source import register
from fragloom.streaming import fragments as st

RAW_ROWS = ' SELECT sample_id, chrom, s AS start, e AS "end", mapq, strand FROM raw'


def _fragment_files(spark, sf):
    path = stage_path(spark, "fragment-files")
    v.raw_fragments(spark, sf).write.partitionBy("sample_id").option("compression", "gzip").csv(path, sep="\t")
    return path


@query("WITH " + v.RAW + RAW_ROWS)
def read_fragments(spark, sf):
    """Gzip text per sample; the sample sheet maps files to ids."""
    path = _fragment_files(spark, sf)
    rows = rd.read_gz_fragments(spark, f"{path}/*/*.gz")
    folder = F.element_at(F.split("path", "/"), -2)
    names = v.samples(spark, sf).select(F.concat(F.lit("sample_id="), "sample_id").alias("file_name"), "sample_id")
    return rd.name_samples(rows.withColumn("file_name", folder), names)


def _block_files(spark, sf):
    """The raw fragments as block-gzipped files, one folder per sample, through the sink."""
    path = stage_path(spark, "block-files")
    register(spark)
    v.raw_fragments(spark, sf).write.format("fragments").mode("append").save(path)
    return path


def _folder():
    return F.element_at(F.split("path", "/"), -2).alias("sample_id")


RAW_COLUMNS = ["chrom", "start", "end", "mapq", "strand"]


@query("WITH " + v.RAW + RAW_ROWS)
def read_bgz_fragments(spark, sf):
    """Block-gzipped files through the data source, in splits."""
    path = _block_files(spark, sf)
    return spark.read.format("fragments").option("splitBytes", 1 << 14).load(path).select(_folder(), *RAW_COLUMNS)


@query("WITH " + v.RAW + RAW_ROWS)
def read_mixed_fragments(spark, sf):
    """Gzip and block-gzipped files in one call of the reader, named by a sample sheet."""
    path = stage_path(spark, "mixed-files")
    register(spark)
    raw = v.raw_fragments(spark, sf)
    number = F.substring("sample_id", 2, 9).cast("int")
    raw.filter(number % 10 != 1).write.format("fragments").mode("append").save(f"{path}/blocks")
    for i in (1, 11, 21, 31):  # a write of its own for each: file names are unique in one write only
        raw.filter(number == i).write.partitionBy("sample_id").mode("append").option("compression", "gzip").csv(
            f"{path}/gzip", sep="\t")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.{gz,bgz}").load(path).select("path")
    names = files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"),
                         F.regexp_replace(_folder(), "^sample_id=", "").alias("sample_id"))
    return rd.read_fragments(spark, [r["path"] for r in files.collect()], names)


@query("WITH " + v.FRAGS + f" SELECT {FRAGMENT_SQL} FROM frags")
def stream_ingest_bgz(spark, sf):
    """The data source as a stream of block-gzipped files."""
    path, out, checkpoint = _block_files(spark, sf), stage_path(spark, "stream-out"), stage_path(spark, "stream-state")
    raw = spark.readStream.format("fragments").load(path).select(_folder(), *RAW_COLUMNS)
    st.ingest_stream(raw, out, checkpoint, "chr").awaitTermination()
    return wr.read_written_fragments(spark, out)


@query("WITH " + v.FRAGS + f" SELECT {FRAGMENT_SQL} FROM frags")
def fragment_table(spark, sf):
    path = stage_path(spark, "fragments")
    wr.write_fragments(v.fragments(spark, sf), path, cluster=True)
    return wr.read_written_fragments(spark, path)


@query("WITH " + v.FRAGS + f" SELECT {FRAGMENT_SQL} FROM frags")
def read_fragment_parquet(spark, sf):
    """The same table through the reader that also takes one file per sample."""
    path = stage_path(spark, "fragments")
    table = v.fragments(spark, sf)
    wr.write_fragments(table, path, cluster=True)
    return rd.read_fragment_parquet(spark, path).select(*table.columns)


@query("WITH " + v.FRAGS + """
SELECT chrom, s AS start, e AS "end", sample_id AS name, mapq, strand FROM frags""")
def bed_export(spark, sf):
    path = stage_path(spark, "bed")
    wr.write_bed(v.fragments(spark, sf), path)
    return spark.read.csv(path, sep="\t", schema="chrom string, start bigint, end bigint, name string, mapq bigint, strand string")


@query("WITH " + v.RAW + "," + v.SIZES + "," + v.ARMS + " SELECT * FROM arms")
def read_bed(spark, sf):
    path = stage_path(spark, "arms")
    v.arms(spark, sf).write.csv(path, sep="\t")
    return rd.read_bed(spark, path, "arm")


@query("WITH " + v.RAW + "," + v.SIZES + " SELECT * FROM sizes")
def read_chrom_sizes(spark, sf):
    path = stage_path(spark, "sizes")
    v.chrom_sizes(spark, sf).write.csv(path, sep="\t")
    return rd.read_chrom_sizes(spark, path)


@query("WITH " + SHEET + " SELECT * EXCLUDE (line) FROM sheet")
def read_samplesheet(spark, sf):
    """The sheet as tab-delimited text with a header."""
    path = stage_path(spark, "sheet")
    rows = sheet(spark, sf)
    rows.drop("line").write.option("emptyValue", "").option(
        "ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path, sep="\t", header=True)
    return rd.read_samplesheet(spark, path, "\t").drop("line")


@query("""WITH bases AS (
  SELECT 'doc' || doc_id AS chrom,
    regexp_replace(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTNN'), '[^ACGTN]', '', 'g') AS seq
  FROM (SELECT doc_id, regexp_replace(text, '[^a-z]', '', 'g') AS text FROM documents) WHERE text <> '')
SELECT chrom, chunk, 512 * chunk AS start, least(512 * (chunk + 1), length(seq)) AS "end",
  md5(substring(seq, 512 * chunk + 1, 515)) AS digest
FROM bases, LATERAL (SELECT unnest(range(CAST(ceil(length(seq) / 512) AS BIGINT))) AS chunk)""")
def read_reference(spark, sf):
    """FASTA text of the document contigs in lines of 60 bases, read back as chunks."""
    path = stage_path(spark, "fasta")
    bases = F.translate(F.regexp_replace("text", "[^a-z]", ""), v.LETTERS, v.LETTER_BASES)
    docs = v.table(spark, sf, "documents").select("doc_id", bases.alias("seq")).filter("seq <> ''")
    lines = F.concat(F.lit(">doc"), F.col("doc_id").cast("string"), F.lit(" contig\n"),
                     F.regexp_replace("seq", "(.{60})", "$1\n"))
    docs.select(lines.alias("value")).write.text(path)
    chunks = rd.read_reference(spark, path, 512)
    return chunks.select("chrom", "chunk", "start", "end", F.md5("seq").alias("digest"))


@query("WITH " + RECORDS + """
SELECT id, frag_num, sample_name AS name, disease FROM recs""")
def read_metadata_json(spark, sf):
    """Each record as a file of its own, read whole and parsed with the explicit record schema."""
    path = stage_path(spark, "records")
    wr.write_metadata_json(records(spark, sf).select("json"), path)
    return rd.read_metadata_json(spark, path).select(
        "record.id", "record.frag_num", "record.sample.name", "record.sample.disease")


@query("WITH " + v.ALIGNMENTS + """
SELECT qname, flag, rname, pos, mapq, rname AS rnext, pnext, tlen FROM alignments""")
def read_alignments(spark, sf):
    path = stage_path(spark, "sam")
    a = v.alignments(spark, sf)
    line = F.concat_ws("\t", "qname", F.col("flag").cast("string"), "rname", F.col("pos").cast("string"),
                       F.col("mapq").cast("string"), F.lit("100M"), F.lit("="), F.col("pnext").cast("string"),
                       F.col("tlen").cast("string"), F.lit("*"), F.lit("*"))
    lines = a.select(line.alias("value")).unionByName(
        v.chrom_sizes(spark, sf).select(F.concat(F.lit("@SQ\tSN:"), "chrom").alias("value")))
    lines.write.text(path)
    return rd.read_alignments(spark, path).drop("path")


@query("WITH " + CORRECTED_SQL + """
SELECT sample_id, bin_id, n_total_fragments, coverage_total_gc_corrected FROM corrected""")
def tsv_round_trip(spark, sf):
    path = stage_path(spark, "corrected")
    wr.write_tsv(corrected(spark, sf).select(
        "sample_id", "bin_id", "n_total_fragments", "coverage_total_gc_corrected"), path, compress=True)
    return spark.read.csv(path, sep="\t", header=True, schema=(
        "sample_id string, bin_id string, n_total_fragments bigint, coverage_total_gc_corrected double"))


@query("WITH " + v.FRAGS + "," + v.SIZES + "," + bins_sql(100000) + """
SELECT '{"n_bins":' || count(*) || '}' AS value FROM bins""")
def json_summary(spark, sf):
    path = stage_path(spark, "summary")
    wr.write_json_summary(tiles(spark, sf).agg(F.count(F.lit(1)).alias("n_bins")), path)
    return spark.read.text(path)


# --- streams -------------------------------------------------------------------------------


@query("WITH " + v.FRAGS + f" SELECT {FRAGMENT_SQL} FROM frags")
def stream_ingest(spark, sf):
    """A file stream over the written fragment files, run until all files are read."""
    path, out, checkpoint = (_fragment_files(spark, sf), stage_path(spark, "stream-out"),
                             stage_path(spark, "stream-state"))
    raw = st.fragment_stream(spark, path).withColumn("sample_id", F.regexp_replace("sample_id", "^sample_id=", ""))
    st.ingest_stream(raw, out, checkpoint, "chr").awaitTermination()
    return wr.read_written_fragments(spark, out)


@query("WITH " + v.FRAGS + """,
hits AS (SELECT *, unnest(range(s // 500000, (e - 1) // 500000 + 1)) * 500000 AS b FROM frags)
SELECT sample_id, chrom, b AS start, count(*) AS n_total_fragments, count(*) FILTER (is_short) AS n_short_100_150,
  count(*) FILTER (is_long) AS n_long_151_220, CAST(sum(length) AS BIGINT) AS length_sum FROM hits GROUP BY ALL""")
def stream_bin_counts(spark, sf):
    """Running counts of a stream; every trigger appends the keys it touched."""
    path, out, checkpoint = (_fragment_files(spark, sf), stage_path(spark, "counts-out"),
                             stage_path(spark, "counts-state"))
    raw = st.fragment_stream(spark, path, 100).withColumn(
        "sample_id", F.regexp_replace("sample_id", "^sample_id=", ""))
    counts = st.running_bin_counts(fr.ingest(raw, "chr"), 500_000)
    st.store_updates(counts, out, checkpoint).awaitTermination()
    return st.latest_rows(spark, out, st.KEYS, counts.schema)


@query("WITH " + dense_sql() + """
SELECT sample_id, chrom, b AS start, n AS n_total_fragments, ns AS n_short_100_150, nl AS n_long_151_220,
       total AS length_sum, med AS median_fragment_length FROM agg""")
def stream_bin_medians(spark, sf):
    """Bin statistics of a stream in several triggers; half of the files arrive after a compaction."""
    path, checkpoint = stage_path(spark, "bins-in"), stage_path(spark, "bins-state")
    state, raw = st.BinState(spark, stage_path(spark, "bins"), 100_000), v.raw_fragments(spark, sf)
    late = F.substring("sample_id", 2, 9).cast("int") >= 20
    for part in (~late, late):
        raw.filter(part).write.mode("append").partitionBy("sample_id").option("compression", "gzip").csv(path, sep="\t")
        stream = st.fragment_stream(spark, path, 60).withColumn("sample_id", F.regexp_replace("sample_id", "^sample_id=", ""))
        state.follow(fr.ingest(stream, "chr"), checkpoint).awaitTermination()
        state.compact()
    return state.statistics()


@query("WITH " + dense_sql() + """
SELECT sample_id, chrom, b AS start, n AS n_total_fragments, ns AS n_short_100_150, nl AS n_long_151_220,
       total AS length_sum, med AS median_fragment_length FROM agg""")
def bin_counts_bucketed(spark, sf):
    """Bin counts on a fragment table in buckets of tiles: no fragment is shuffled."""
    name = f"tiled_{uuid.uuid4().hex}"
    tiled = wr.write_tiled_fragments(v.fragments(spark, sf), stage_path(spark, name), name, 100_000)
    return cv.tiled_bin_counts(tiled)
