"""Readers and writers on small files."""

import gzip
import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from fragloom.operators import matrix
from fragloom.sources import bgzf, readers as rd, writers as wr


def block(data: bytes) -> bytes:
    """One gzip member with the size field of the block format."""
    codec = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = codec.compress(data) + codec.flush()
    size = len(body) + 25
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + size.to_bytes(2, "little") + body
            + zlib.crc32(data).to_bytes(4, "little") + len(data).to_bytes(4, "little"))


def write_blocks(path, data: bytes, step: int):
    with open(path, "wb") as f:
        for at in range(0, len(data), step):
            f.write(block(data[at:at + step]))
        f.write(block(b""))


def lines(n, seed=1):
    r = random.Random(seed)
    return "".join(f"{r.randint(1, 22)}\t{s}\t{s + r.randint(30, 600)}\t{r.randint(0, 60)}\t{r.choice('+-')}\n"
                   for s in (r.randint(0, 10**8) for _ in range(n))).encode()


@pytest.mark.parametrize("split", [1 << 30, 5000, 700, 97])
@pytest.mark.parametrize("step", [64, 1000, 60000])
def test_every_line_is_read_once(tmp_path, split, step):
    data = lines(400)
    path = str(tmp_path / "a.bgz")
    write_blocks(path, data, step)
    length = (tmp_path / "a.bgz").stat().st_size
    got = [piece for start in range(0, length, split)
           for piece in bgzf.split_text(path, start, start + split, length)]
    assert b"".join(got) == data
    assert all(piece.endswith(b"\n") for piece in got)


def test_lines_longer_than_a_split(tmp_path):
    data = b"x" * 5000 + b"\n" + b"y" * 3000 + b"\nlast"
    path = str(tmp_path / "a.bgz")
    write_blocks(path, data, 100)
    length = (tmp_path / "a.bgz").stat().st_size
    got = [p for start in range(0, length, 150) for p in bgzf.split_text(path, start, start + 150, length)]
    assert b"".join(got) == data


def test_read_fragments_of_all_codecs(spark, tmp_path):
    data = {name: lines(300, seed) for seed, name in enumerate(("a", "b", "c"))}
    write_blocks(tmp_path / "a.frag.tsv.bgz", data["a"], 500)
    with gzip.open(tmp_path / "b.bgz", "wb") as f:  # plain gzip behind the block suffix
        f.write(data["b"])
    with open(tmp_path / "c.tsv.gz", "wb") as f:  # several members
        f.write(gzip.compress(data["c"][:100]) + gzip.compress(data["c"][100:]))
    names = ["a.frag.tsv.bgz", "b.bgz", "c.tsv.gz"]
    samples = spark.createDataFrame([(n, n[0]) for n in names], "file_name string, sample_id string")
    paths = [str(tmp_path / n) for n in names]
    rows = rd.read_fragments(spark, paths, samples).collect()
    for name, text in data.items():
        got = sorted("\t".join(map(str, r[1:])) for r in rows if r["sample_id"] == name)
        assert got == sorted(text.decode().split("\n")[:-1])
    one = rd.read_bgz_fragments(spark, paths[0], split_bytes=2000)
    assert one.count() == 300 and one.rdd.getNumPartitions() > 1  # one file, several tasks
    with pytest.raises(ValueError, match="extension"):
        rd.read_fragments(spark, ["x.bigWig"], samples)


def test_fragment_table_keeps_its_schema_when_empty(spark, tmp_path):
    from fragloom.operators.fragments import ingest
    raw = spark.createDataFrame([], "sample_id string, chrom string, start bigint, `end` bigint, mapq bigint, strand string")
    wr.write_fragments(ingest(raw), str(tmp_path / "t"))
    back = wr.read_written_fragments(spark, str(tmp_path / "t"))
    assert back.count() == 0 and back.columns[0] == "sample_id" and len(back.columns) == 9


def test_sample_id_from_file_name(spark, tmp_path, fragments):
    fragments.drop("sample_id").write.parquet(str(tmp_path / "P7.fragments.parquet"))
    df = rd.read_fragment_parquet(spark, str(tmp_path / "*.parquet"))
    assert {r[0] for r in df.select("sample_id").distinct().collect()} == {"P7"}


def test_fasta_chunks(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">chr1 first\nACGTACGTAC\nGTTT\n>chr2\r\nNNac\r\n>empty\n")
    chunks = rd.read_reference(spark, str(tmp_path / "g.fa"), 8, 3).orderBy("chrom", "chunk").collect()
    assert [(r["chrom"], r["start"], r["end"], r["seq"]) for r in chunks] == [
        ("chr1", 0, 8, "ACGTACGTACG"), ("chr1", 8, 14, "ACGTTT"), ("chr2", 0, 4, "NNac")]


def test_sheet_lines(spark, tmp_path):
    (tmp_path / "s.csv").write_text("sample_id,label\n" + "".join(f"s{i},control\n" for i in range(5)) + '"a,b",\n')
    rows = rd.read_samplesheet(spark, str(tmp_path / "s.csv")).orderBy("line").collect()
    assert [r["line"] for r in rows] == [2, 3, 4, 5, 6, 7]
    assert rows[-1]["sample_id"] == "a,b" and rows[-1]["label"] == ""


def test_line_numbers_over_splits(spark, tmp_path):
    (tmp_path / "n.txt").write_text("".join(f"{i}\n" for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        df = rd.with_line_numbers(spark.read.text(str(tmp_path / "n.txt")), first=0)
        assert all(int(r["value"]) == r["line"] for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_small_tables(spark, tmp_path):
    (tmp_path / "sizes").write_text("chr1\t100\textra\n\nchr2\t50\n")
    assert [tuple(r) for r in rd.read_chrom_sizes(spark, str(tmp_path / "sizes")).collect()] == [("chr1", 100), ("chr2", 50)]
    (tmp_path / "r.bed").write_text("#c\nchr1\t1\t5\tx\n")
    assert [tuple(r) for r in rd.read_bed(spark, str(tmp_path / "r.bed")).collect()] == [("chr1", 1, 5, "x")]
    (tmp_path / "a.sam").write_text("@HD\tVN:1\nq1\t99\tchr1\t101\t60\t50M\t=\t180\t130\tA\tB\tNM:i:0\n")
    row = rd.read_alignments(spark, str(tmp_path / "a.sam")).head()
    assert (row["flag"], row["pos"], row["rnext"], row["tlen"]) == (99, 101, "chr1", 130)
    (tmp_path / "m.json").write_text('{"id": 5,\n "sample": {"name": "P"}, "other": [1]}')
    rec = rd.read_metadata_json(spark, str(tmp_path / "m.json")).head()["record"]
    assert rec["id"] == 5 and rec["sample"]["name"] == "P"


def test_matrix_file(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("sample_id\tlabel\tf.1\tf2\ns1\tcontrol\t1.5\t\ns2\tcancer\tbad\t2\n")
    meta, long = rd.read_feature_matrix(spark, str(tmp_path / "m.tsv"))
    assert meta.columns == ["sample_id", "label"]
    from fragloom.operators.cohort import numeric_values
    got = {(r[0], r[1]): r[2] for r in numeric_values(long).collect()}
    assert got == {("s1", "f.1"): 1.5, ("s1", "f2"): None, ("s2", "f.1"): None, ("s2", "f2"): 2.0}
    with pytest.raises(ValueError):
        rd.read_feature_matrix(spark, str(tmp_path / "m.tsv"), limit=1)


def test_bed_names_carry_the_read_hash(spark):
    df = spark.createDataFrame([("s1", "chr1", 1, 2, 60, "+", "abc")],
                               "sample_id string, chrom string, start bigint, `end` bigint, mapq bigint, strand string, read_name_hash string")
    assert wr.bed_rows(df).head()["name"] == "s1:abc"


def test_json_summary(spark, tmp_path):
    counts = spark.createDataFrame([(3, 1, 1, 1, 0)], "sample_count bigint, fastq bigint, bam bigint, cram bigint, fragments bigint")
    wr.write_json_summary(wr.run_manifest(counts, "train", "auto", "hg38"), str(tmp_path / "run"))
    facts = wr.read_json_metadata(spark, str(tmp_path / "run"))
    assert facts["sample_count"] == 3 and facts["input_counts"]["bam"] == 1 and facts["assembly"] == "hg38"
    assert "created_utc" in facts


def test_numeric_looking_ids_stay_text(spark, tmp_path, fragments):
    from pyspark.sql import functions as F
    df = fragments.withColumn("sample_id", F.lit("007")).withColumn("is_short", F.lit(True)).withColumn("is_long", F.lit(False))
    wr.write_fragments(df, str(tmp_path / "t"), cluster=True)
    back = rd.read_fragment_parquet(spark, str(tmp_path / "t"))
    assert {r[0] for r in back.select("sample_id").collect()} == {"007"} and back.count() == 4


@pytest.mark.parametrize("split", [37, 200, 1 << 20])
def test_fasta_over_splits_equals_cutting_the_string(spark, tmp_path, split):
    r = random.Random(split)
    contigs = {f"c{i}": "".join(r.choice("ACGTN") for _ in range(n)) for i, n in enumerate((0, 1, 8, 500, 333, 7))}
    for name, own in (("a.fa", ["c0", "c3", "c1"]), ("b.fa", ["c2", "c4", "c5"])):
        text = "".join(f">{c} x\n" + "".join(contigs[c][k: k + 11] + "\n" for k in range(0, len(contigs[c]), 11)) for c in own)
        (tmp_path / name).write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = rd.read_reference(spark, str(tmp_path), 16, 5).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = sorted((c, k // 16, k, min(k + 16, len(s)), s[k: k + 21]) for c, s in contigs.items() for k in range(0, len(s), 16))
    assert sorted(tuple(row) for row in got) == want


def test_malformed_rows_fail(spark, tmp_path):
    with gzip.open(tmp_path / "x.tsv.gz", "wb") as f:
        f.write(b"1\t10\t90\t60\t+\n1\tten\t90\t60\t+\n")
    with pytest.raises(Exception, match="[Mm]alformed"):
        rd.read_gz_fragments(spark, str(tmp_path / "x.tsv.gz")).collect()
    with pytest.raises(ValueError, match="bgz"):
        rd.read_gz_fragments(spark, "x.bgz")


def test_stream_reads_blocks_and_text(spark, tmp_path):
    from fragloom.streaming import fragments as st
    data = {name: lines(200, seed) for seed, name in enumerate(("s1", "s2"))}
    for name in data:
        (tmp_path / "in" / name).mkdir(parents=True)
    write_blocks(tmp_path / "in" / "s1" / "a.bgz", data["s1"], 500)
    with gzip.open(tmp_path / "in" / "s2" / "b.tsv.gz", "wb") as f:
        f.write(data["s2"])
    raw = st.fragment_stream(spark, str(tmp_path / "in"))
    query = raw.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    for name, text in data.items():
        got = sorted(f"{r['chrom']}\t{r['start']}\t{r['end']}\t{r['mapq']}\t{r['strand']}" for r in rows if r["sample_id"] == name)
        assert got == sorted(text.decode().split("\n")[:-1])


# The data source, streaming state, and the bucketed layout


@pytest.fixture(scope="module")
def source(spark):
    from fragloom.sources.fragment_source import register
    register(spark)
    return spark


def raw_rows(spark, n=2000, seed=4):
    r = random.Random(seed)
    rows = [(r.choice("ab"), r.choice(["1", "2", "MT"]), s, s + r.randint(30, 600), r.randint(0, 60), r.choice("+-"))
            for s in (r.randint(0, 10**6) for _ in range(n))]
    return rows, spark.createDataFrame(rows, "sample_id string, chrom string, start long, `end` long, mapq long, strand string")


def test_sink_and_source_round_trip(source, tmp_path):
    rows, df = raw_rows(source)
    folder = str(tmp_path / "files")
    df.repartition(3).write.format("fragments").mode("append").save(folder)
    assert not list((tmp_path / "files" / "_temporary").glob("*"))
    files = sorted((tmp_path / "files").glob("*/*.frag.tsv.bgz"))
    assert {f.parent.name for f in files} == {"a", "b"} and all(bgzf.is_blocked(str(f)) for f in files)
    assert sum(gzip.decompress(f.read_bytes()).count(b"\n") for f in files) == len(rows)
    for size in (700, 1 << 20):
        back = source.read.format("fragments").option("splitBytes", size).load(folder)
        got = sorted((r.path.split("/")[-2], r.chrom, r.start, r.end, r.mapq, r.strand) for r in back.collect())
        assert got == sorted(rows)
    assert source.read.format("fragments").option("splitBytes", 700).load(folder).rdd.getNumPartitions() > len(files)
    df.limit(5).drop("sample_id").write.format("fragments").mode("overwrite").save(folder)
    assert source.read.format("fragments").load(folder).count() == 5


def test_source_reads_all_codecs_and_refuses_bad_input(source, tmp_path):
    data = {name: lines(200, seed) for seed, name in enumerate(("a", "b", "c"))}
    write_blocks(tmp_path / "a.frag.tsv.bgz", data["a"], 300)
    for name in ("b.bgz", "c.tsv.gz"):  # the first one is plain gzip behind the block suffix
        with gzip.open(tmp_path / name, "wb") as f:
            f.write(data[name[0]])
    (tmp_path / "empty.bgz").write_bytes(b"")
    (tmp_path / "notes.txt").write_text("not a fragment file")
    rows = source.read.format("fragments").option("splitBytes", 500).load(str(tmp_path)).collect()
    for name, text in data.items():
        got = ["\t".join(map(str, r[:5])) for r in rows if r.path.split("/")[-1].startswith(f"{name}.")]
        assert sorted(got) == sorted(text.decode().split("\n")[:-1])
    with gzip.open(tmp_path / "d.gz", "wb") as f:
        f.write(b"1\t2\t3\tmany\t+\n")
    with pytest.raises(Exception, match="many|int64|invalid literal"):
        source.read.format("fragments").load(str(tmp_path)).collect()
    with pytest.raises(Exception, match="no such path"):
        source.read.format("fragments").load(str(tmp_path / "gone")).collect()
    with pytest.raises(Exception, match="mapq"):
        raw_rows(source, 3)[1].drop("mapq").write.format("fragments").mode("append").save(str(tmp_path / "out"))


def test_stream_reads_each_file_once(source, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    counts = []
    for i in range(3):
        write_blocks(folder / f"f{i}.bgz", lines(100, i), 400)
        stream = source.readStream.format("fragments").load(str(folder))
        stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
        counts.append(source.read.parquet(out).count())
    assert counts == [100, 200, 300]


def test_addresses_of_other_file_systems():
    from fragloom.sources import fragment_source as fsrc
    assert fsrc.open_system("file:/tmp/x")[1] == "/tmp/x" and fsrc.open_system("file:///tmp/x")[1] == "/tmp/x"
    assert fsrc._full_path("s3a://bucket/folder", object(), "bucket/folder/f.bgz") == "s3://bucket/folder/f.bgz"


def batch_bins(spark, rows, size):
    from fragloom.operators.coverage import bin_counts
    frags = spark.createDataFrame([(r[0], r[1], r[2], r[3], r[3] - r[2]) for r in rows],
                                  "sample_id string, chrom string, start long, `end` long, length long")
    return frags, sorted(map(tuple, bin_counts(frags, size).collect()))


def test_bin_state_merges_replays_and_compacts(spark, tmp_path):
    from fragloom.streaming.fragments import BinState
    state = BinState(spark, str(tmp_path / "state"), 50_000)
    assert state.counts().count() == 0
    state.compact()
    rows, _ = raw_rows(spark, 900)
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    schema = "sample_id string, chrom string, start long, `end` long, length long"
    deltas = []
    for i in range(4):
        part, _ = batch_bins(spark, rows[i * 200: (i + 1) * 200], 50_000)
        part.coalesce(1).write.mode("append").parquet(folder)
        state.follow(spark.readStream.schema(schema).parquet(folder), checkpoint).awaitTermination()
        deltas.append(spark.read.parquet(str(tmp_path / "state" / "deltas" / f"batch={i}")).agg({"n": "sum"}).head()[0])
        if i in (1, 2):
            state.compact()
        _, want = batch_bins(spark, rows[: (i + 1) * 200], 50_000)
        assert sorted(map(tuple, state.statistics().collect())) == want
    assert max(deltas) < 250  # a trigger adds its own rows only
    assert state._numbers("base") == [1, 2] and state._numbers("deltas") == [2, 3]
    again = spark.read.parquet(str(tmp_path / "state" / "deltas" / "batch=3"))
    again.cache().count()
    again.write.mode("overwrite").parquet(str(tmp_path / "state" / "deltas" / "batch=3"))  # the batch is run again
    assert sorted(map(tuple, state.statistics().collect())) == want


def test_tiled_table_counts_without_a_shuffle(spark, tmp_path):
    from fragloom.operators.coverage import tiled_bin_counts
    rows, _ = raw_rows(spark, 1500)
    frags, want = batch_bins(spark, rows, 10_000)
    table = wr.write_tiled_fragments(frags, str(tmp_path / "tiled"), "tiled_test", 10_000, 5)
    counted = tiled_bin_counts(table)
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, counted.collect())) == want
    assert table.filter("owner").count() == len(rows) < table.count()
    spark.sql("DROP TABLE tiled_test")
    again = wr.open_tiled_fragments(spark, str(tmp_path / "tiled"), "tiled_again", 5)
    other = wr.write_tile_table(
        again.select(*wr.TILE_KEYS).distinct().selectExpr("*", "1 AS weight"), str(tmp_path / "weights"), "tile_weights", 5)
    joined = again.hint("merge").join(other, list(wr.TILE_KEYS))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == again.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("tiled_again", "tile_weights"):
            spark.sql(f"DROP TABLE {name}")


def test_each_record_is_a_file_in_few_tasks(spark, tmp_path):
    from pyspark.sql import functions as F
    path = str(tmp_path / "records")
    texts = spark.range(900).select(F.concat(F.lit('{"id":'), (F.col("id") % 890).cast("string"), F.lit("}")).alias("json"))
    wr.write_metadata_json(texts, path)
    got = rd.read_metadata_json(spark, path)
    assert got.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    rows = got.select("path", "record.id").collect()
    assert len({r["path"] for r in rows}) == 900 and sorted(r["id"] for r in rows) == sorted(i % 890 for i in range(900))


def test_chunks_of_a_contig_do_not_carry_it(spark):
    texts = ["", None, "A", "AC\nGT" * 7, "é𝄞\r\n" * 11, "G" * 64]
    contigs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "chrom string, sequence string")
    for size, tail in ((8, 3), (5, 0), (64, 9)):
        cut = rd.chunk_sequence(contigs, size, tail)
        want = [(str(i), at // size, at, min(at + size, len(t)), t[at:at + size + tail])
                for i, t in enumerate(texts) if t for at in range(0, len(t), size)]
        assert sorted(map(tuple, cut.collect())) == want
        generate = cut._jdf.queryExecution().optimizedPlan().toString().split("Generate ")[1].split("\n")[0]
        assert "posexplode" in generate and "[1]" in generate  # the sequence ends there


def test_names_of_files_shuffle_no_rows(spark, tmp_path):
    data = lines(200)
    with gzip.open(tmp_path / "b.tsv.gz", "wb") as f:
        f.write(data)
    from pyspark.sql import functions as F
    (tmp_path / "big.bin").touch()
    with open(tmp_path / "big.bin", "r+b") as f:
        f.truncate(1 << 33)  # what a listing of large files says
    listed = spark.read.format("binaryFile").load(str(tmp_path)).select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), F.lit("s").alias("sample_id"))
    got = rd.read_fragments(spark, [str(tmp_path / "b.tsv.gz")], listed)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert got.count() == 200


WIDE = {("b", "f1"): 1.0, ("b", "f5"): None, ("a", "f2"): 2.0, ("a", "f4"): 4.0, ("c", "f3"): 3.0, ("c", "f5"): 5.0}
WIDE_LINES = ["sample_id\tlabel\tf1\tf2\tf3\tf4\tf5", "b\tx\t1.0\t\t\t\t", "a\t\t\t2.0\t\t4.0\t", "c\t\t\t\t3.0\t\t5.0"]


@pytest.mark.parametrize("cells", [1, 2, 4, 8])
def test_no_row_of_a_wide_matrix_grows_with_its_width(spark, tmp_path, monkeypatch, cells):
    monkeypatch.setattr(matrix, "PIECE_FEATURES", cells)
    features = spark.createDataFrame([(*k, x) for k, x in WIDE.items()], "sample_id string, feature_name string, value double")
    metadata = spark.createDataFrame(
        [("a", None, False, 2), ("b", "x", False, 1), ("c", None, True, None), ("without", "y", False, 0)],
        "sample_id string, label string, unlisted boolean, sheet_line long")
    pieces = matrix.wide_pieces(features, metadata)
    rows = sorted(map(tuple, pieces.collect()))
    assert max(text.count("\t") for _, piece, text in rows if piece >= 0) <= cells
    assert ["".join(t for r, _, t in rows if r == row) for row in range(4)] == WIDE_LINES
    assert sorted(map(tuple, matrix.line_digests(pieces).collect())) == [
        (i, hashlib.md5(line.encode()).hexdigest(), len(line)) for i, line in enumerate(WIDE_LINES)]
    wr.write_wide_lines(pieces, f"file://{tmp_path}/wide")
    written = [line for f in (tmp_path / "wide").glob("part-*") for line in f.read_text().splitlines()]
    assert sorted(written) == sorted(WIDE_LINES)


@pytest.mark.parametrize("split_bytes", ["3", "7", "1m"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_wide_lines_are_read_by_cell(spark, tmp_path, split_bytes, end):
    for name, lines in (("p0", WIDE_LINES[2:]), ("p1", [*WIDE_LINES[:2], ""])):
        (tmp_path / name).write_bytes("".join(line + end for line in lines).encode())
    was = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        meta, long = rd.read_wide_lines(spark, str(tmp_path))
        assert len(meta.select("label").collect()) == 3
        names, *rows = [line.split("\t") for line in WIDE_LINES]
        want = [(row[0], name, value) for row in rows for name, value in zip(names[2:], row[2:])]
        assert sorted(map(tuple, long.collect())) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was[0])
        spark.conf.set("spark.sql.files.openCostInBytes", was[1])


def test_cells_find_their_line_by_number():
    """Two files: the second one opens a line with its first cell (8), others open behind a line end."""
    opens = pa.table({"at": [0, 7, 15, 16, 21], "name": ["sample_id", "b", "", "a", "c"]})
    cells = pa.record_batch([pa.array([0, 1, 3, 4, 7, 8, 9, 10, 11, 12]), pa.array(list("01347") + ["a", "9", "10", "11", "12"])],
                            names=["g", "value"])
    placed, = rd._cells_of_lines(type("Shared", (), {"value": opens}))(iter([cells]))
    assert list(zip(*(c.to_pylist() for c in placed.columns))) == [
        ("sample_id", 1, "1"), ("sample_id", 3, "3"), ("b", 1, "4"), ("b", 4, "7"),
        ("a", 1, "9"), ("a", 2, "10"), ("c", 1, "11"), ("c", 2, "12")]


def test_records_are_files_that_no_driver_lists(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    from fragloom.sources import record_files as rf
    monkeypatch.setattr(rf, "FOLDER_FILES", 10)
    monkeypatch.setattr(rf, "HELD_FILES", 7)
    path = str(tmp_path / "records")
    texts = spark.range(90).select(F.concat(F.lit('{"id":'), F.col("id").cast("string"), F.lit(',"sample":{"name":"ü"}}')).alias("json"))
    for _ in range(2):  # the second time over the first
        wr.write_metadata_json(texts, path)
    files = [f for f in (tmp_path / "records").rglob("*") if f.is_file()]
    assert len(files) == 90 and not any(f.name.endswith(".crc") for f in files)  # a checksum file beside each before
    assert max(sum(f.parent == d for f in files) for d in {f.parent for f in files}) <= 10
    got = rd.read_metadata_json(spark, path)
    assert not got.inputFiles() or not any(f.endswith(".txt") for f in got.inputFiles())  # its plan has no file of a record
    by_task = {r["path"]: (r["json"], r["id"], r["name"]) for r in got.select("path", "json", "record.id", "record.sample.name").collect()}
    plain = spark.read.text(f"{path}/*/*/*.txt", wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    assert {p: x[0] for p, x in by_task.items()} == {r["path"]: r["value"] for r in plain.collect()}
    assert sorted(x[1:] for x in by_task.values()) == [(i, "ü") for i in range(90)]
    by_pattern = rd.read_metadata_json(spark, f"{path}/*/*/*.txt")
    assert sorted(r["id"] for r in by_pattern.select("record.id").collect()) == list(range(90))
    with pytest.raises(Exception, match="no such path"):
        rd.read_metadata_json(spark, str(tmp_path / "none")).collect()


def test_metadata_files_of_odd_names_and_kinds(spark, tmp_path):
    import gzip
    folder = tmp_path / "a b" / "k=1"
    folder.mkdir(parents=True)
    (folder / "x%1#.json").write_text('{"id":1}')
    (folder / "y.json.gz").write_bytes(gzip.compress(b'{"id":2}'))
    (folder / "empty.json").write_text("")
    (folder / "_hidden.json").write_text('{"id":9}')
    rows = rd.read_metadata_json(spark, [str(tmp_path / "a b"), str(folder / "x%1#.json")]).select("path", "json", "record.id").collect()
    assert sorted(r["json"] for r in rows) == ['{"id":1}', '{"id":1}', '{"id":2}']
    spark_paths = {r[0] for r in spark.read.text(str(folder), wholetext=True).select("_metadata.file_path").collect()}
    assert {r["path"] for r in rows} == spark_paths
