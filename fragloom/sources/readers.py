"""Readers. Every text table has an explicit schema; nothing is inferred."""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from fragloom import schemas as S
from fragloom.session import stage
from fragloom.sources import record_files
from fragloom.sources.split_text import BGZ_SPLIT, frames

# The function that places cells travels inside the task, executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BGZ_TASKS = 50_000
#: Groups of small files, as Spark plans them, that one task reads.
FILE_GROUPS = 256


def _paths(paths):
    return [paths] if isinstance(paths, str) else list(paths)


def check_suffixes(paths) -> None:
    from fragloom.constants import ACCEPTED_SUFFIXES
    refused = [p for p in _paths(paths) if not p.endswith(tuple(ACCEPTED_SUFFIXES))]
    if refused:
        raise ValueError(f"Unsupported fragment file extension: {', '.join(refused[:10])}")


def tab_fields(lines: DataFrame, schema: T.StructType, optional=()) -> list:
    """Columns of `schema` from tab-separated lines in `value`; further fields are ignored.

    A line with a missing field or a number that does not parse fails the job; fields named in
    `optional` may be missing.
    """
    parts = F.split("value", "\t")
    bad = F.raise_error(F.concat(F.lit("Malformed line: "), F.substring("value", 1, 200)))
    columns = []
    for i, field in enumerate(schema.fields):
        text = F.get(parts, F.lit(i))
        value = text if isinstance(field.dataType, T.StringType) else F.trim(text).try_cast(field.dataType)
        checked = value if field.name in optional else F.when(value.isNull(), bad.cast(field.dataType)).otherwise(value)
        columns.append(checked.alias(field.name))
    return columns


def read_gz_fragments(spark: SparkSession, paths) -> DataFrame:
    """Five-column fragment text in `.gz` files, with the file path of each row.

    Spark decodes it; the `.gz` format cannot be split, so one file is one task. Malformed rows
    fail the job; `.bgz` files, which Spark would take for plain text, are refused.
    """
    blocked = [p for p in _paths(paths) if p.endswith(".bgz")]
    if blocked:
        raise ValueError(f"read .bgz files with read_bgz_fragments: {', '.join(blocked[:10])}")
    lines = spark.read.text(_paths(paths)).filter(F.trim("value") != "")
    return lines.select(*tab_fields(lines, S.RAW_FRAGMENT), F.col("_metadata.file_path").alias("path"))


def read_bgz_fragments(spark: SparkSession, paths, split_bytes: int = BGZ_SPLIT) -> DataFrame:
    """The same for `.bgz` files, read in parallel splits of `split_bytes`.

    File sizes come from Spark's file listing (contents are not read for that), splits
    are rows, and each task decodes the blocks of its splits with Arrow batches out.
    One huge file is therefore spread over many tasks.
    """
    files = spark.read.format("binaryFile").load(_paths(paths)).select("path", "length")
    splits = bgz_splits(files, split_bytes)
    # A split is one short row but much work: a stated number of tasks keeps adaptive
    # execution from merging them by size.
    total = files.agg(F.sum("length")).head()[0] or 0
    tasks = min(max(-(-total // split_bytes), 1), BGZ_TASKS)
    return decode_splits(splits.repartition(tasks, "path", "start"), split_bytes)


def bgz_splits(files: DataFrame, split_bytes: int = BGZ_SPLIT) -> DataFrame:
    """Byte ranges (path, length, start) of files (path, length)."""
    step = F.lit(split_bytes).cast("long")
    return files.filter(F.col("length") > 0).withColumn(
        "start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, step)))


def decode_splits(splits: DataFrame, split_bytes: int = BGZ_SPLIT) -> DataFrame:
    """Raw fragments with the file path of the lines that begin in each byte range."""
    schema = T.StructType(S.RAW_FRAGMENT.fields + [T.StructField("path", T.StringType())])

    def decode(batches):
        for batch in batches:
            for path, length, start in batch[["path", "length", "start"]].itertuples(index=False):
                yield from frames(path, length, start, split_bytes)

    return splits.mapInPandas(decode, schema)


def read_fragments(spark: SparkSession, paths, sample_map: DataFrame) -> DataFrame:
    """Raw fragments with sample ids.

    `sample_map` holds (file_name, sample_id), with the last part of each path. The
    suffix decides the codec; refused suffixes raise.
    """
    check_suffixes(paths)
    bgz = [p for p in _paths(paths) if p.endswith(".bgz")]
    gz = [p for p in _paths(paths) if not p.endswith(".bgz")]
    parts = ([read_bgz_fragments(spark, bgz)] if bgz else []) + ([read_gz_fragments(spark, gz)] if gz else [])
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return name_samples(rows.withColumn("file_name", F.element_at(F.split("path", "/"), -1)), sample_map)


def name_samples(rows: DataFrame, sample_map: DataFrame) -> DataFrame:
    """Sample ids of rows by `file_name`.

    The map has a row per file, names that the driver lists to plan the read anyway, so it goes to
    every task whatever its estimate says (which counts the contents of listed files): rows of
    large files are never shuffled by the name of their file.
    """
    names = F.broadcast(sample_map.select("file_name", "sample_id"))
    return rows.join(names, "file_name").select(
        "sample_id", *S.RAW_FRAGMENT.fieldNames())


def read_fragment_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Canonical fragments: a table partitioned by sample, or one `<sample>.fragments.parquet`
    (or `<sample>.parquet`) per sample, whose name then gives the id."""
    df = spark.read.parquet(path)
    if "sample_id" in df.columns:
        # Ids are text also where folder names look like numbers ("007").
        fields = [T.StructField(f.name, T.StringType() if f.name == "sample_id" else f.dataType) for f in df.schema]
        return spark.read.schema(T.StructType(fields)).parquet(path)
    stem = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.fragments)?\.parquet(/[^/]*)?$", 1)
    return df.withColumn("sample_id", stem)


def read_bed(spark: SparkSession, path, name: str = "name") -> DataFrame:
    """Headerless BED with a name in the fourth field, if any; lines with `#` are comments."""
    lines = spark.read.text(path).filter((F.trim("value") != "") & ~F.col("value").startswith("#"))
    return lines.select(*tab_fields(lines, S.bed4(name), [name]))


def read_chrom_sizes(spark: SparkSession, path) -> DataFrame:
    """Contigs and sizes; malformed rows fail the job."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(*tab_fields(lines, S.CHROM_SIZES))


def with_line_numbers(df: DataFrame, name: str = "line", first: int = 2) -> DataFrame:
    """File line numbers of the rows of one text file read without a shuffle.

    Rows are numbered inside their file split; the sizes of the splits before are added.
    Only one number per split leaves the scan.
    """
    numbered = df.withColumn("_id", F.monotonically_increasing_id())
    split = F.shiftright("_id", 33)
    sizes = numbered.groupBy(split.alias("_split")).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(F.lit(0)).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_split", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_offset"))
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        numbered.join(offsets, split == F.col("_split"))
        .withColumn(name, inside + F.col("_offset") + first).drop("_id", "_split", "_offset")
    )


def read_samplesheet(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All columns as text, with the file line of each row."""
    sheet = spark.read.csv(path, sep=sep, header=True, inferSchema=False, escape='"')
    return with_line_numbers(sheet.na.fill(""))


def chunk_sequence(contigs: DataFrame, chunk_size: int, tail_bases: int = 3) -> DataFrame:
    """(chrom, sequence) to chunks (chrom, chunk, start, end, seq).

    `seq` also holds up to `tail_bases` bases after the chunk, so short reads across a
    chunk end need one chunk only.
    """
    size = F.lit(chunk_size).cast("long")
    start = F.col("chunk") * size
    # One walk along the contig: cutting each chunk by its position would walk from the contig's
    # start again and copy the contig into every row.
    pattern = f"(?s)(?=(.{{1,{chunk_size + tail_bases}}})).{{1,{chunk_size}}}"
    cut = F.posexplode(F.regexp_extract_all("sequence", F.lit(pattern), F.lit(1)))
    return (
        contigs.select("chrom", cut.alias("chunk", "seq")).withColumn("chunk", F.col("chunk").cast("long"))
        .select("chrom", "chunk", start.alias("start"),
                (start + F.least(F.length("seq"), F.lit(chunk_size))).alias("end"), "seq")
    )


def read_reference(spark: SparkSession, path: str, chunk_size: int, tail_bases: int = 3) -> DataFrame:
    """FASTA as sequence chunks (chrom, chunk, start, end, seq), in linear time.

    Files are read by line and may be split anywhere. Each line learns its contig and offset from
    running sums inside its file split and from the sums of the splits before, of which there
    is one row per split; then lines are cut at chunk ends and joined chunk by chunk. No task
    holds more than the lines of one split or one chunk. Lines before the first header are ignored.
    """
    block = ["path", "block"]
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), F.col("value"))
    is_header = F.col("value").startswith(">")
    name = F.split(F.trim(F.regexp_replace(F.substr("value", F.lit(2)), "\r", "")), r"\s+")[0]
    order = Window.partitionBy(*block).orderBy("line")
    parsed = lines.select(
        *block, "line", F.when(is_header, F.struct("line", name.alias("chrom"))).alias("header"),
        F.when(is_header, "").otherwise(F.translate("value", "\r ", "")).alias("bases"))
    headed = parsed.withColumn("record", F.last("header", ignorenulls=True).over(order))
    inside = Window.partitionBy(*block, "record").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    placed = headed.withColumn("before", F.coalesce(F.sum(F.length("bases")).over(inside), F.lit(0)))
    # What each split hands to the next: its last header and the bases behind it.
    ends = headed.groupBy(*block).agg(
        F.max("record").alias("last"),
        F.sum(F.when(F.col("record").isNull(), F.length("bases")).otherwise(0)).alias("leading"))
    tails = headed.filter(F.col("record").isNotNull()).groupBy(*block, "record").agg(F.sum(F.length("bases")).alias("tail"))
    ends = ends.join(tails.withColumnRenamed("record", "last"), [*block, "last"], "left").withColumn(
        "carried", F.coalesce("tail", "leading"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.max(F.when(F.col("last").isNotNull(), F.struct("block", "last"))).over(earlier)
    sums = ends.withColumn("open", opened)
    since = Window.partitionBy("path", "open").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Splits under one open header add up; the first of them carries the header's own split.
    sums = sums.withColumn("mid", F.coalesce(F.sum("leading").over(since), F.lit(0)))
    first = ends.select("path", F.col("block").alias("_b"), F.col("carried").alias("first"))
    sums = sums.join(first, (sums["path"] == first["path"]) & (F.col("open.block") == F.col("_b")), "left").select(
        sums["path"], "block", F.col("open.last").alias("open"), (F.coalesce("first", F.lit(0)) + F.col("mid")).alias("offset"))
    known = placed.filter(F.length("bases") > 0).join(sums, block).select(
        "path", F.coalesce("record", "open").alias("record"),
        (F.col("before") + F.when(F.col("record").isNull(), F.col("offset")).otherwise(0)).alias("off"), "bases"
    ).filter(F.col("record").isNotNull())
    size = F.lit(chunk_size).cast("long")
    stop = F.col("off") + F.length("bases")
    lowest = F.greatest(F.lit(0).cast("long"), F.floor((F.col("off") - tail_bases) / size))
    pieces = known.withColumn("chunk", F.explode(F.sequence(lowest, F.floor((stop - 1) / size))))
    low = F.greatest("off", F.col("chunk") * size)
    high = F.least(stop, (F.col("chunk") + 1) * size + tail_bases)
    own = F.greatest(F.lit(0), F.least(stop, (F.col("chunk") + 1) * size) - low)
    piece = F.substring("bases", (low - F.col("off") + 1).cast("int"), (high - low).cast("int"))
    return (
        pieces.filter(high > low).groupBy("path", "record", "chunk")
        .agg(F.sort_array(F.collect_list(F.struct(low.alias("low"), piece.alias("piece")))).alias("pieces"), F.sum(own).alias("own"))
        .select(F.col("record.chrom").alias("chrom"), "chunk", (F.col("chunk") * size).alias("start"),
                (F.col("chunk") * size + F.col("own")).alias("end"), F.array_join("pieces.piece", "").alias("seq")))


def read_metadata_json(spark: SparkSession, paths) -> DataFrame:
    """One JSON record per file as (path, json, record).

    Folders are listed and files read by tasks, so the driver knows no file. Patterns, and stores that
    Arrow does not open, are left to Spark's reader. It plans few small files for a task, by what it costs to
    open one; a task takes several of these groups, so the number of tasks does not follow the number of files.
    """
    parsed = F.from_json("json", S.METADATA_RECORD).alias("record")
    if all(record_files.opens(p) for p in _paths(paths)):
        return record_files.read_files(spark, _paths(paths)).select("path", "json", parsed)
    text = spark.read.text(paths, wholetext=True)
    groups = text.rdd.getNumPartitions()
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-groups // FILE_GROUPS))
    return text.coalesce(min(max(groups, 1), tasks)).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("json")).select("path", "json", parsed)


def read_alignments(spark: SparkSession, paths) -> DataFrame:
    """SAM text: header lines dropped, mate contig `=` resolved, file path kept."""
    lines = spark.read.text(paths).filter(~F.col("value").startswith("@"))
    fields = F.split("value", "\t")
    rname = fields[2]
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        fields[0].alias("qname"), fields[1].cast("int").alias("flag"), rname.alias("rname"),
        fields[3].cast("long").alias("pos"), fields[4].cast("int").alias("mapq"),
        F.when(fields[6] == "=", rname).otherwise(fields[6]).alias("rnext"),
        fields[7].cast("long").alias("pnext"), fields[8].cast("long").alias("tlen"))


def read_feature_matrix(spark: SparkSession, path: str, limit: int = 5000):
    """Wide matrix file as (metadata, long features). Widths above `limit` are refused."""
    from fragloom.constants import META_COLUMNS

    wide = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    return split_matrix(wide, META_COLUMNS, limit)


def split_matrix(wide: DataFrame, meta_columns, limit: int = 5000):
    names = [c for c in wide.columns if c not in meta_columns]
    if len(names) > limit:
        raise ValueError(f"more than {limit} feature columns; store long features instead")
    meta = wide.select(*[c for c in meta_columns if c in wide.columns])
    values = wide.select("sample_id", *[F.col(f"`{c}`").cast("string").alias(c) for c in names])
    long = values.unpivot("sample_id", [F.col(f"`{c}`") for c in names], "feature_name", "value")
    return meta, long


def read_wide_lines(spark: SparkSession, path):
    """Wide matrix file of any width as (metadata, long features), values as text.

    Files are cut at tabs, not at lines, so a row is one cell wherever a split begins. A cell with a
    line end inside closes one line and opens the next. Cells are numbered by the counts of the
    splits before; the number at which each line opens, of which there is one per sample, gives
    every cell its line and place. Header lines begin with sample_id and give the names.
    """
    from fragloom.constants import META_COLUMNS

    block = ["path", "block"]
    cells = spark.read.text(path, lineSep="\t").select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), "value")
    sizes = stage(cells.groupBy(*block).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), "splits")
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    offsets = stage(sizes.select(*block, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("offset")), "offsets")
    parts = F.split("value", "\r\n|\n|\r")
    numbered = cells.join(F.broadcast(offsets), block).select(
        "path", "block", (F.col("id") + F.col("offset")).alias("g"), parts.alias("parts"))
    # A line opens at 2g with the first cell of a file, at 2g + 1 behind a line end inside cell g.
    heads = sizes.groupBy("path").agg(F.min_by("first", "block").alias("id")).join(offsets, "path").join(
        sizes.select(*block, F.col("first").alias("own")), block).filter("id = own").select((F.col("own") + F.col("offset")).alias("g"))
    opened = numbered.select("g", F.posexplode("parts").alias("k", "name")).join(
        F.broadcast(heads.withColumnRenamed("g", "head")), F.col("g") == F.col("head"), "left").filter("k > 0 OR head IS NOT NULL")
    lines = stage(opened.select((2 * F.col("g") + F.when(F.col("k") > 0, 1).otherwise(0)).alias("at"), "k", "name"), "lines")
    starts = spark.sparkContext.broadcast(lines.orderBy("at", "k").select("at", "name").toArrow())
    long = numbered.select("g", F.col("parts")[0].alias("value")).mapInArrow(
        _cells_of_lines(starts), "sample_id string, at long, value string")
    header = F.col("sample_id") == "sample_id"
    names = long.filter(header).select("at", F.col("value").alias("feature_name")).distinct()
    rows = long.filter(~header).join(names.hint("merge"), "at")
    is_meta = F.col("feature_name").isin(list(META_COLUMNS))
    ids = lines.filter("name NOT IN ('', 'sample_id')").select(F.col("name").alias("sample_id"), F.lit("sample_id"), "name")
    meta = rows.filter(is_meta).select("sample_id", "feature_name", "value").union(ids).groupBy("sample_id").pivot(
        "feature_name", list(META_COLUMNS)).agg(F.first("value"))
    return meta, rows.filter(~is_meta).select("sample_id", "feature_name", "value")


def _cells_of_lines(starts):
    """Line, as its first cell, and place in the line of numbered cells; first cells themselves go."""
    def placed(batches):
        opens, names = starts.value["at"].to_numpy(), starts.value["name"].combine_chunks()
        for batch in batches:
            g = batch.column(0).to_numpy()
            line = np.searchsorted(opens, 2 * g, "right") - 1
            at = g - opens[line] // 2
            rows = pa.record_batch(
                [names.take(pa.array(line)), pa.array(at), batch.column(1)], names=["sample_id", "at", "value"])
            yield rows.filter(pa.array(at > 0))
    return placed


def read_predictions(spark: SparkSession, path: str, score: str = "cancer_probability") -> DataFrame:
    df = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    numbers = [c for c in (score, "threshold_used", "cv_probability", "test_probability") if c in df.columns]
    for column in numbers:
        df = df.withColumn(column, F.col(column).try_cast("double"))
    if "y_true" in df.columns:
        df = df.withColumn("y_true", F.col("y_true").cast("int"))
    return df


