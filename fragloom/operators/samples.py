"""Sample-sheet validation, fragment-source choice and cohort manifests.

A sheet is a DataFrame of strings with a `line` column (file line, first row 2).
"""

import functools

from pyspark.sql import DataFrame, functions as F

from fragloom import constants as C
from fragloom.functions import measures as m, text as t
from fragloom.operators.joins import lookup_join
from fragloom.schemas import METADATA_RECORD

FRAGMENT_INPUT = "finaledb_fragments"


def missing_columns(sheet: DataFrame, input_type: str = "auto") -> list[str]:
    required = [] if input_type == FRAGMENT_INPUT else C.REQUIRED_COLUMNS
    return [c for c in required if c not in sheet.columns]


def _col(sheet, name):
    return F.col(name) if name in sheet.columns else F.lit(None).cast("string")


def apply_defaults(sheet: DataFrame) -> DataFrame:
    """Defaults of fragment sheets: id and label columns that are absent are filled from
    other columns (a present but blank cell stays); a blank cancer type takes the cohort
    unless that is blank or `control`."""
    out = sheet
    blank_to_null = lambda c: F.nullif(_col(sheet, c), F.lit(""))
    if "sample_id" not in sheet.columns:
        out = out.withColumn("sample_id", F.coalesce(
            blank_to_null("finaledb_id"), blank_to_null("sample_name"), F.lit("")))
    if "label" not in sheet.columns:
        out = out.withColumn("label", F.coalesce(
            blank_to_null("cohort"), blank_to_null("disease"), F.lit("")))
    cohort = t.trimmed(_col(sheet, "cohort"))
    use_cohort = (t.trimmed(_col(sheet, "cancer_type")) == "") & ~cohort.isin("", "control")
    return out.withColumn("cancer_type", F.when(use_cohort, _col(sheet, "cohort")).otherwise(
        _col(sheet, "cancer_type")))


def mark_repeats(sheet: DataFrame) -> DataFrame:
    """`is_duplicate` on every later line of a sample id.

    The first line per id comes from an aggregate with map-side combine; only lines of
    repeated ids can be duplicates, and each compares itself with that first line.
    """
    sid = t.trimmed(F.col("sample_id"))
    keyed = sheet.withColumn("_sid", sid)
    first = (
        keyed.groupBy("_sid").agg(F.min("line").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1).drop("_n")
    )
    return lookup_join(keyed, first, ["_sid"], "left").withColumn(
        "is_duplicate", F.coalesce(F.col("line") > F.col("_first"), F.lit(False))
    ).drop("_sid", "_first")


def choose_fragment_source(sheet: DataFrame) -> DataFrame:
    """`direct`: the first usable fragment column in fixed order, else an empty string."""
    picks = [t.present_or_null(F.col(c)) for c in C.FRAGMENT_SOURCE_COLUMNS if c in sheet.columns]
    return sheet.withColumn("direct", F.coalesce(*picks, F.lit("")))


def find_fragment_key(record, assembly: str):
    """Key of the first raw fragment table of an assembly in a metadata record."""
    items = F.try_element_at(record.getField("analysis"), F.lit(assembly))
    wanted = F.filter(items, lambda i: (
        (F.lower(F.trim(i["desc"])) == "fragment") & (F.lower(F.trim(i["type"])) == "tsv")
        & t.accepted_extension(i["key"])))
    return F.try_element_at(wanted, F.lit(1)).getField("key")


def resolve_sources(sheet: DataFrame, metadata: DataFrame | None = None, assembly: str = "hg38") -> DataFrame:
    """Source path, address and metadata key of each line of a fragment sheet.

    `metadata` holds (metadata_json, json): the path written in the sheet and the text
    of that record.
    """
    df = choose_fragment_source(sheet).withColumn("_path", t.trimmed(_col(sheet, "metadata_json")))
    df = df.withColumn("_path", F.when(t.present(F.col("_path")), F.col("_path")).otherwise(""))
    if metadata is not None:
        record = F.from_json("json", METADATA_RECORD)
        keys = metadata.select(
            F.col("metadata_json").alias("_key"), F.lit(True).alias("_found"),
            find_fragment_key(record, assembly).alias("metadata_key"))
        # Lines without a path get keys that no record has, spread evenly.
        none = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in sheet.columns]), F.lit(4096)).cast("string"))
        df = lookup_join(df.withColumn("_key", F.when(F.col("_path") == "", none).otherwise(F.col("_path"))), keys, ["_key"], "left").drop("_key")
    else:
        df = df.withColumn("_found", F.lit(None).cast("boolean")).withColumn(
            "metadata_key", F.lit(None).cast("string"))
    direct, key = F.col("direct"), F.col("metadata_key")
    url = t.trimmed(_col(sheet, "finaledb_url"))
    listed = t.trimmed(_col(sheet, "fragment_url"))
    address = (
        F.when(key.isNotNull(), t.build_download_url(key))
        .when(direct.startswith("entries/"), t.build_download_url(direct))
        .when((direct != "") & (url == "") & (listed != ""), listed)
        .otherwise(url)
    )
    found = F.coalesce(F.col("_found"), F.lit(False))
    source = F.when(direct != "", direct).when(key.isNotNull(), key).otherwise(
        t.trimmed(_col(sheet, "finaledb_fragment")))
    return df.withColumns({
        "finaledb_fragment": source,
        "finaledb_url": address,
        "metadata_path": F.col("_path"),
        "metadata_found": found,
    }).drop("_path", "_found")


def _messages(line, rules):
    prefix = F.concat(F.lit("line "), line.cast("string"), F.lit(": "))
    return F.array_compact(F.array(*[
        F.when(condition, F.concat(prefix, text if not isinstance(text, str) else F.lit(text)))
        for condition, text in rules
    ]))


def validation_errors(sheet: DataFrame, mode: str = "full", input_type: str = "auto",
                      fasta: bool = False, tissue_of_origin: bool = False,
                      metadata: DataFrame | None = None, assembly: str = "hg38") -> DataFrame:
    """All rule violations of all lines as (line, rule_no, message)."""
    df = mark_repeats(sheet)
    sid = t.trimmed(F.col("sample_id"))
    rules = [
        (sid == "", "sample_id is required"),
        (F.col("is_duplicate"), F.concat(F.lit("duplicate sample_id '"), sid, F.lit("'"))),
    ]
    if input_type == FRAGMENT_INPUT:
        df = resolve_sources(df, metadata, assembly)
        direct, path = F.col("direct"), F.col("metadata_path")
        rules += [
            ((direct != "") & ~t.is_web_address(direct) & ~t.accepted_extension(direct),
             F.concat(F.lit("unsupported fragment extension '"), direct, F.lit("'"))),
            (F.col("metadata_found") & F.col("metadata_key").isNull(),
             F.lit(f"could not parse metadata_json: no fragment table found under analysis.{assembly}")),
            ((path != "") & ~F.col("metadata_found") & (direct == ""),
             F.concat(F.lit("could not parse metadata_json: no such file '"), path, F.lit("'"))),
            ((path == "") & (direct == ""),
             "fragment input requires a fragment column or metadata_json"),
        ]
    else:
        one, two, bam, cram = (t.present(F.col(c)) for c in ("fastq_1", "fastq_2", "bam", "cram"))
        pair = one & two
        sources = pair.cast("int") + bam.cast("int") + cram.cast("int")
        rules += [
            (sources != 1, "provide exactly one input type: paired FASTQ, BAM, or CRAM"),
            ((one | two) & ~pair, "FASTQ input requires fastq_1 and fastq_2"),
            (cram & F.lit(not fasta), "CRAM input requires --fasta"),
        ]
    if mode == "train":
        rules.append((~t.present(F.col("label")), "label is required in train mode"))
    if tissue_of_origin:
        rules.append((~t.present(F.col("cancer_type")), "cancer_type is required for tissue-of-origin training"))
    return df.select("line", F.posexplode(_messages(F.col("line"), rules)).alias("rule_no", "message"))


def canonical_sheet(sheet: DataFrame) -> DataFrame:
    """Required columns plus the optional ones that occur, trimmed, missing as ''."""
    columns = C.REQUIRED_COLUMNS + [c for c in C.OPTIONAL_COLUMNS if c in sheet.columns]
    keep = ["line"] if "line" in sheet.columns else []
    return sheet.select(*keep, *[t.trimmed(_col(sheet, c)).alias(c) for c in columns])


def input_counts(sheet: DataFrame, input_type: str = "auto") -> DataFrame:
    """Sample count and counts per input type, one row."""
    zero = F.lit(0).cast("long")
    if input_type == FRAGMENT_INPUT:
        return sheet.agg(F.count(F.lit(1)).alias("sample_count"), zero.alias("fastq"), zero.alias("bam"),
                         zero.alias("cram"), F.count(F.lit(1)).alias("fragments"))
    one, two, bam, cram = (t.present(F.col(c)) for c in ("fastq_1", "fastq_2", "bam", "cram"))
    return sheet.agg(
        F.count(F.lit(1)).alias("sample_count"), m.count_where(one & two).alias("fastq"),
        m.count_where(bam).alias("bam"), m.count_where(cram).alias("cram"), zero.alias("fragments"))


class SheetErrors(ValueError):
    """A sheet that breaks rules; `errors` is a DataFrame with a row for each violation."""

    def __init__(self, message: str, errors: DataFrame):
        super().__init__(message)
        self.errors = errors


def validate(sheet: DataFrame, mode: str = "full", input_type: str = "auto", show: int = 100, **options):
    """Checked canonical sheet. All violations raise together as `SheetErrors`: the message lists
    the first `show` of them and the total number, `errors` is the table of all."""
    missing = missing_columns(sheet, input_type)
    if missing:
        raise ValueError(f"samplesheet missing required columns: {', '.join(missing)}")
    if not sheet.head(1):
        raise ValueError("samplesheet is empty")
    df = apply_defaults(sheet) if input_type == FRAGMENT_INPUT else sheet
    errors = validation_errors(df, mode, input_type, **options)
    first = errors.orderBy("line", "rule_no").limit(show + 1).collect()
    if first:
        text = "\n".join(r["message"] for r in first[:show])
        more = f"\n... {errors.count()} errors in all" if len(first) > show else ""
        raise SheetErrors(text + more, errors)
    if input_type == FRAGMENT_INPUT:
        keep = {k: v for k, v in options.items() if k in ("metadata", "assembly")}
        df = resolve_sources(df, **keep)
        if "local_fragment" in df.columns:
            use = (F.col("direct") != "") & (F.coalesce("local_fragment", F.lit("")) != "")
            df = df.withColumn("local_fragment", F.when(use, F.col("direct")).otherwise(F.col("local_fragment")))
    return canonical_sheet(df)


# --- archive metadata ------------------------------------------------------------


def discover_fragment_urls(json, assembly: str):
    """Fragment addresses in a metadata record (JSON text), in order, without repeats.

    Structured entries win; else every string value that looks like a fragment file.
    """
    record = F.from_json(json, METADATA_RECORD)
    analysis = record.getField("analysis")
    if assembly == "any":
        items = F.flatten(F.map_values(analysis))
    else:
        items = F.try_element_at(analysis, F.lit(assembly))
    structured = F.transform(
        F.filter(items, lambda i: (F.lower(F.trim(i["desc"])) == "fragment")
                 & F.lower(F.trim(i["type"])).isin("tsv", "bed") & (F.coalesce(i["key"], F.lit("")) != "")),
        lambda i: t.normalize_download_url(i["key"]))
    # A quoted string, with the colon when it is a key.
    strings = F.regexp_extract_all(json, F.lit(r'"(?:[^"\\]|\\.)*+"(?:\s*:)?'), F.lit(0))
    texts = F.transform(
        F.filter(strings, lambda s: ~s.endswith(":")),
        lambda s: F.get_json_object(F.concat(F.lit("["), s, F.lit("]")), "$[0]"))
    scanned = F.transform(
        F.filter(texts, lambda s: F.contains(F.lower(s), F.lit(".frag."))
                 & (F.lower(s).endswith(".gz") | F.lower(s).endswith(".bgz"))
                 & ~F.contains(F.lower(s), F.lit("bedgraph")) & ~F.contains(F.lower(s), F.lit("frag_profile"))),
        lambda s: t.normalize_download_url(s))
    structured = F.coalesce(structured, F.array().cast("array<string>"))
    return F.array_distinct(F.when(F.size(structured) > 0, structured).otherwise(
        F.coalesce(scanned, F.array().cast("array<string>"))))


def select_cohorts(records: DataFrame, cohorts: dict, tissue: str = "blood plasma",
                   frag_min: int = 5_000_000, frag_max: int = 100_000_000) -> DataFrame:
    """The first records per cohort, by id, that match disease, tissue and size.

    `cohorts` maps cohort names to (disease, limit); `records` holds (id, frag_num,
    sample struct, json).
    """
    parts = []
    for name, (disease, limit) in cohorts.items():
        match = (
            (F.col("sample.disease") == disease) & (F.col("sample.tissue") == tissue)
            & F.col("frag_num").between(frag_min, frag_max))
        # Top-k plan: every task keeps its first `limit` rows, no group is collected.
        parts.append(records.filter(match).orderBy("id").limit(limit).withColumn("cohort", F.lit(name)))
    return functools.reduce(DataFrame.unionByName, parts)


def cohort_manifest(selected: DataFrame, outdir: str, assembly: str = "hg19",
                    tissue: str = "blood plasma") -> DataFrame:
    """Manifest rows of the selected records that name a fragment file."""
    urls = discover_fragment_urls(F.col("json"), assembly)
    fid = F.coalesce(F.concat(F.lit("EE"), F.col("id").cast("string")), F.lit("unknown"))
    blank = lambda c: F.nullif(c, F.lit(""))
    rows = selected.withColumn("fragment_url", F.try_element_at(urls, F.lit(1))).filter(
        F.col("fragment_url").isNotNull()
    ).withColumn("finaledb_id", fid).withColumn(
        "sample_name", F.coalesce(blank(F.col("sample.name")), F.col("finaledb_id")))
    local = F.concat(
        F.lit(outdir.rstrip("/") + "/fragments/"), F.col("cohort"), F.lit("/"),
        t.safe_name(F.col("finaledb_id")), F.lit("_"), t.safe_name(F.col("sample_name")),
        F.lit(f"_{assembly}"), t.fragment_suffix(F.col("fragment_url")))
    raw = F.concat(F.lit(outdir.rstrip("/") + "/metadata_json/"), t.safe_name(F.col("finaledb_id")), F.lit(".json"))
    return rows.select(
        "cohort", "finaledb_id", "sample_name",
        F.col("sample.disease").alias("disease"),
        F.coalesce(blank(F.col("sample.tissue")), F.lit(tissue)).alias("tissue"),
        F.lit(assembly).alias("assembly"), "fragment_url", local.alias("local_fragment"),
        raw.alias("metadata_json"))


