"""Known small cases of fragment derivation, counting and validation."""

import pytest
from pyspark.sql import functions as F

from fragloom.functions import chrom, text as t
from fragloom.operators import coverage as cv, fragments as fr, regions as rg, samples as sm
from fragloom.params import Params

RAW = "sample_id string, chrom string, start bigint, `end` bigint, mapq bigint, strand string"


def values(df, column, *order):
    return [r[column] for r in df.orderBy(*order).collect()]


def test_ingest_filters_and_renames(spark):
    raw = spark.createDataFrame([
        ("s1", "1", 10000, 10168, 0, "+"), ("s1", "1", 10032, 10175, 23, "-"),
        ("s1", "1", 10033, 10215, 35, "-"), ("s1", "2", 20000, 20130, 60, "+")], RAW)
    bins = spark.createDataFrame([("chr1", 0, 100000), ("chr2", 0, 100000)], "chrom string, start bigint, `end` bigint")
    out = fr.ingest(raw, fr.infer_style(bins))
    assert out.columns == ["sample_id", "chrom", "start", "end", "mapq", "strand", "length", "is_short", "is_long"]
    assert values(out, "mapq", "mapq") == [35, 60]
    assert values(out, "length", "mapq") == [182, 130]
    assert values(out, "is_short", "mapq") == [False, True]
    assert values(out, "chrom", "mapq") == ["chr1", "chr2"]
    qc = fr.ingest_qc(raw).head()
    assert (qc["input_fragments"], qc["fragments_passing_mapq"], qc["fragments_passing_mapq_and_length"]) == (4, 2, 2)
    assert qc["median_length"] == 156.0 and qc["short_long_ratio"] == 1.0


def test_ingest_qc_of_nothing_is_zero(spark):
    raw = spark.createDataFrame([("s1", "1", 0, 10, 0, "+")], RAW)
    qc = fr.ingest_qc(raw).head()
    assert qc["mean_length"] == 0.0 and qc["median_length"] == 0.0 and qc["fraction_short_100_150"] == 0.0


@pytest.mark.parametrize("name, style, want", [
    ("1", "chr", "chr1"), ("MT", "chr", "chrM"), ("chr1", "no_chr", "1"), ("chrM", "no_chr", "MT"),
    ("chrX", "other", "chrX"), ("M", "chr", "chrM"), ("chrchr1", "no_chr", "chr1")])
def test_chrom_names(spark, name, style, want):
    df = spark.createDataFrame([(name,)], "c string")
    assert df.select(chrom.normalize_chrom(F.col("c"), style)).head()[0] == want


def test_autosomes(spark):
    names = ["1", "chr22", "chr023", "chr007", "0", "23", "X", "chrM", "chr1x", "1 "]
    df = spark.createDataFrame([(n,) for n in names], "c string")
    kept = [r[0] for r in df.filter(chrom.is_autosome(F.col("c"))).collect()]
    assert kept == ["1", "chr22", "chr007"]


def test_suffixes(spark):
    df = spark.createDataFrame([("sample.frag.tsv.bgz",), ("sample.bgz",), ("sample.bigWig",)], "p string")
    assert [r[0] for r in df.select(t.accepted_extension(F.col("p"))).collect()] == [True, True, False]


@pytest.mark.parametrize("bin_size", [100, None])
def test_boundary_overlaps(spark, fragments, bin_size):
    bins = cv.annotate_gc(spark.createDataFrame(
        [("chr1", 0, 100, "chr1:0-100"), ("chr1", 100, 200, "chr1:100-200"), ("chr2", 0, 100, "chr2:0-100")],
        "chrom string, start bigint, `end` bigint, bin_id string"))
    samples = spark.createDataFrame([("s1",), ("s2",)], "sample_id string")
    out = cv.dense_bin_counts(fragments, bins, samples, bin_size)
    mine = out.filter("sample_id = 's1'")
    assert values(mine, "n_total_fragments", "bin_id") == [2, 2, 1]
    assert values(mine, "n_short_100_150", "bin_id") == [0, 0, 1]
    assert values(mine, "median_fragment_length", "bin_id") == [30.0, 45.0, 135.0]
    empty = out.filter("sample_id = 's2'")
    assert values(empty, "n_total_fragments", "bin_id") == [0, 0, 0]
    assert values(empty, "median_fragment_length", "bin_id") == [0.0, 0.0, 0.0]


def test_last_partial_bin(spark):
    sizes = spark.createDataFrame([("chr1", 249250621), ("chr2", 7400000), ("chr3", 7500000), ("chrX", 9000000), ("chr4", 0)],
                                  "chrom string, size bigint")
    bins = cv.make_bins(sizes, 5_000_000)
    ids = {r["bin_id"] for r in bins.collect()}
    assert "chr1:245000000-249250621" in ids and "chr3:5000000-7500000" in ids
    assert not any(i.startswith(("chr2:5000000", "chrX", "chr4")) for i in ids)
    assert bins.filter("chrom = 'chr1'").count() == 50


def test_gc_of_bins(spark):
    ref = spark.createDataFrame([("c", 0, 4, "GGCCA"), ("c", 4, 8, "AaNN")], "chrom string, start bigint, `end` bigint, seq string")
    bins = spark.createDataFrame([("c", 0, 8, "a"), ("c", 2, 6, "b"), ("c", 6, 8, "n")],
                                 "chrom string, start bigint, `end` bigint, bin_id string")
    out = cv.annotate_gc(bins, ref)
    assert values(out, "gc_content", "bin_id") == [4 / 6, 0.5, 0.0]
    more = bins.union(spark.createDataFrame([("other", 0, 8, "z")], bins.schema))
    assert values(cv.annotate_gc(more, ref), "gc_content", "bin_id") == [0.5] * 4


def test_wps_by_hand(spark):
    rows = [("s1", "chr1", 0, 400, 60, "+"), ("s1", "chr1", 150, 300, 60, "+"), ("s1", "chr1", 140, 260, 60, "+")]
    frags = spark.createDataFrame(rows, RAW)
    regions = spark.createDataFrame([("chr1", 100, 300, "a"), ("chr1", 5000, 6000, "b")],
                                    "chrom string, start bigint, `end` bigint, name string")
    samples = spark.createDataFrame([("s1",)], "sample_id string")
    out = rg.wps(frags, regions, samples)
    # Window 140..260: one spans, one starts inside, one does both at the closed edges.
    assert {r["name"]: (r["start"], r["end"], r["wps"]) for r in out.collect()} == {
        "a": (140, 260, 2 - 2), "b": (5440, 5560, 0)}


def test_motifs_by_hand(spark):
    frags = spark.createDataFrame([("s1", "c", 0, 8, 60, "+"), ("s1", "c", 6, 9, 60, "+"), ("s1", "c", 7, 40, 60, "+")], RAW)
    ref = spark.createDataFrame([("c", 0, 0, 10, "ACGTTGCAAC")], "chrom string, chunk bigint, start bigint, `end` bigint, seq string")
    for bounded in (None, 50):
        out = rg.end_motif_counts(frags, ref, 64, 64, bounded)
        # The second fragment is 3 bases long, its left motif still has 4; the third runs
        # past the contig, where no sequence is.
        assert {r["feature_name"]: r["n"] for r in out.collect()} == {
            "left_4mer_ACGT": 1, "right_4mer_TGCA": 1, "combined_4mer_ACGT_TGCA": 1, "left_4mer_CAAC": 1}


def test_qc_limits(spark):
    qc = spark.createDataFrame([("a", 9_000_000, 167.0, 0.01), ("b", 10, 100.0, 0.5)],
                               "sample_id string, filtered_fragments bigint, median_fragment_length double, mito_fraction double")
    out = {r["sample_id"]: (r["qc_flags"], r["qc_pass"]) for r in fr.qc_flags(qc).collect()}
    assert out == {"a": ("", True), "b": ("low_fragment_count;low_median_length;high_mito_fraction", False)}


def test_manifest_sheet(spark, tmp_path):
    bgz = "/data/EE1.hg19.frag.tsv.bgz"
    sheet = spark.createDataFrame([(
        2, "control", "EE1", "P1", "Healthy", "blood plasma", "hg19",
        "http://host/data/entries/EE1/hg19/EE1.hg19.frag.tsv.bgz", bgz)],
        "line bigint, cohort string, finaledb_id string, sample_name string, disease string, tissue string, "
        "assembly string, fragment_url string, local_fragment string")
    row = sm.validate(sheet, "feature_extract", sm.FRAGMENT_INPUT).head()
    assert row["sample_id"] == "EE1" and row["label"] == "control" and row["finaledb_fragment"] == bgz
    assert row["finaledb_url"].endswith("/entries/EE1/hg19/EE1.hg19.frag.tsv.bgz")
    assert row["batch"] == ""


def test_metadata_key_skips_profiles(spark):
    key = "entries/EE85756/hg19/EE85756.hg19.frag.tsv.bgz"
    json = ('{"analysis": {"hg19": [{"desc": "fragment profile", "type": "tsv", "key": "entries/x/hg19/profile.tsv.bgz"},'
            '{"desc": "coverage", "type": "bigWig", "key": "entries/x/hg19/cov.bw"},'
            '{"desc": "fragment", "type": "tsv", "key": "%s"}]}}' % key)
    sheet = spark.createDataFrame([(2, "a", "m.json"), (3, "b", "gone.json")],
                                  "line bigint, sample_id string, metadata_json string")
    meta = spark.createDataFrame([("m.json", json)], "metadata_json string, json string")
    rows = {r["sample_id"]: r for r in sm.resolve_sources(sheet, meta, "hg19").collect()}
    assert rows["a"]["finaledb_fragment"] == key
    assert rows["a"]["finaledb_url"] == "http://finaledb.research.cchmc.org/data/" + key
    messages = [r["message"] for r in sm.validation_errors(
        sheet, input_type=sm.FRAGMENT_INPUT, metadata=meta, assembly="hg19").collect()]
    assert messages == ["line 3: could not parse metadata_json: no such file 'gone.json'"]


def test_errors_are_raised_together(spark):
    columns = "line bigint, sample_id string, fastq_1 string, fastq_2 string, bam string, cram string, label string, " \
              "cancer_type string, batch string, sex string, age string, smoking_status string"
    rows = [(2, "a", "r1", "", "", "", "x", "", "", "", "", ""), (3, "a", "", "", "b.bam", "", "", "", "", "", "", "")]
    sheet = spark.createDataFrame(rows, columns)
    with pytest.raises(ValueError) as error:
        sm.validate(sheet, mode="train")
    text = str(error.value)
    assert "line 2: provide exactly one input type" in text and "line 2: FASTQ input requires" in text
    assert "line 3: duplicate sample_id 'a'" in text and "line 3: label is required" in text
    with pytest.raises(ValueError, match="missing required columns"):
        sm.validate(sheet.drop("bam"))


def test_url_discovery_falls_back_to_strings(spark):
    json = r'{"id": 1, "a.frag.gz": 3, "x": ["q.FRAG.tsv.gz", "a.frag.bedgraph.gz", {"k": "say \"hi\".frag.\/b.gz"}, "q.FRAG.tsv.gz"]}'
    df = spark.createDataFrame([(json,)], "json string")
    assert df.select(sm.discover_fragment_urls(F.col("json"), "hg19")).head()[0] == [
        "http://finaledb.research.cchmc.org/data/q.FRAG.tsv.gz",
        'http://finaledb.research.cchmc.org/data/say "hi".frag./b.gz']


def test_params_change_results(spark, fragments):
    out = fr.with_size_class(fragments, Params(short_min=30, short_max=50))
    assert values(out, "is_short", "start", "chrom") == [False, True, False, False]


# Quality rules and what they judge


def quality_row(**changes):
    row = {"sample_id": "s", "filtered_fragments": 6_000_000, "mean_coverage": 0.2, "duplicate_rate": 0.1,
           "median_fragment_length": 167.0, "mito_fraction": 0.01, "fraction_proper_pair": 0.95}
    return {**row, **changes}


BROKEN = {
    "low_fragment_count": {"filtered_fragments": 4_999_999}, "low_coverage": {"mean_coverage": 0.09},
    "high_duplicate_rate": {"duplicate_rate": 0.36}, "low_median_length": {"median_fragment_length": 119.0},
    "high_median_length": {"median_fragment_length": 191.0}, "high_mito_fraction": {"mito_fraction": 0.21},
    "low_proper_pair": {"fraction_proper_pair": 0.79}}


def test_every_quality_rule_both_ways(spark):
    import pandas as pd
    from fragloom.operators import fragments as fr
    rows = [quality_row(sample_id=name, **change) for name, change in BROKEN.items()]
    edges = quality_row(sample_id="edges", filtered_fragments=5_000_000, mean_coverage=0.1, duplicate_rate=0.35,
                        median_fragment_length=120.0, mito_fraction=0.20, fraction_proper_pair=0.80)
    frame = pd.DataFrame([*rows, edges, quality_row(sample_id="fine")])
    got = {r.sample_id: (r.qc_flags, r.qc_pass) for r in fr.qc_flags(spark.createDataFrame(frame)).collect()}
    assert got == {**{name: (name, False) for name in BROKEN}, "edges": ("", True), "fine": ("", True)}


def test_coverage_and_pairs_behind_the_rules(spark):
    from fragloom import constants as C
    from fragloom.operators import fragments as fr
    frags = spark.createDataFrame(
        [("a", "chr1", 0, 100), ("a", "chr2", 10, 60), ("a", "chrX", 0, 999), ("b", "chrM", 0, 50)],
        "sample_id string, chrom string, start long, `end` long")
    sizes = spark.createDataFrame([("chr1", 1000), ("chr2", 500), ("chrX", 10), ("chrM", 10)], "chrom string, size long")
    assert dict(map(tuple, fr.autosomal_coverage(frags, sizes).collect())) == {"a": 150 / 1500, "b": 0.0}
    flags = [C.FLAG_PAIRED | C.FLAG_PROPER_PAIR, C.FLAG_PAIRED, C.FLAG_PAIRED | C.FLAG_PROPER_PAIR | C.FLAG_MATE_UNMAPPED,
             C.FLAG_PAIRED | C.FLAG_PROPER_PAIR | C.FLAG_SECONDARY, C.FLAG_PROPER_PAIR]
    reads = spark.createDataFrame([("a", f, 40) for f in flags] + [("a", flags[0], 3), ("b", 0, 60)], "sample_id string, flag int, mapq int")
    got = {r.sample_id: r for r in fr.alignment_qc(reads).collect()}
    assert (got["a"].alignments, got["a"].paired_alignments, got["a"].fraction_proper_pair) == (6, 4, 0.5)
    assert got["a"].kept_alignments == fr.filter_flags(reads).filter("sample_id = 'a'").count()
    assert got["b"].paired_alignments == 0 and not got["b"].fraction_proper_pair
