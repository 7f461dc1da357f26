"""File formats, names and word lists that results depend on."""

# File suffixes accepted for fragment files.
ACCEPTED_SUFFIXES = [
    ".frag.tsv.bgz", ".frag.tsv.gz", ".tsv.bgz", ".tsv.gz",
    ".bed.bgz", ".bed.gz", ".bgz", ".gz",
]

# Sample-sheet cells that count as missing.
MISSING_TOKENS = ["", "NA", "na", "null", "None"]

# Sample-sheet columns.
REQUIRED_COLUMNS = [
    "sample_id", "fastq_1", "fastq_2", "bam", "cram", "label", "cancer_type",
    "batch", "sex", "age", "smoking_status",
]
OPTIONAL_COLUMNS = [
    "fragment", "fragments", "fragment_file", "finaledb_fragment", "metadata_json",
    "finaledb_url", "local_fragment", "fragment_url", "finaledb_id", "sample_name",
    "cohort", "disease", "tissue", "assembly",
]
FRAGMENT_SOURCE_COLUMNS = [
    "finaledb_fragment", "local_fragment", "fragment", "fragments", "fragment_file",
]
META_COLUMNS = [
    "sample_id", "label", "cancer_type", "batch", "sex", "age", "smoking_status",
]
MANIFEST_COLUMNS = [
    "cohort", "finaledb_id", "sample_name", "disease", "tissue", "assembly",
    "fragment_url", "local_fragment", "metadata_json",
]

# Fixed value: base address of the public fragment archive.
ARCHIVE_BASE_URL = "http://finaledb.research.cchmc.org"

# Labels that mean "not a case" (compared trimmed and lower-cased).
NEGATIVE_LABELS = [
    "0", "false", "control", "healthy", "normal", "negative", "no", "non_cancer",
    "non-cancer", "", "nan",
]
ELEVATED = "elevated_fragmentome_score"
LOWER = "lower_fragmentome_score"
MODEL_VERSION = "0.1.0"

# Mitochondrial contig names.
MITO_NAMES = ["chrM", "MT", "M", "chrMT"]

# SAM flag bits.
FLAG_PAIRED = 0x1
FLAG_PROPER_PAIR = 0x2
FLAG_UNMAPPED = 0x4
FLAG_MATE_UNMAPPED = 0x8
FLAG_REVERSE = 0x10
FLAG_READ1 = 0x40
FLAG_SECONDARY = 0x100
FLAG_QC_FAIL = 0x200
FLAG_DUPLICATE = 0x400
FLAG_SUPPLEMENTARY = 0x800

# Names and texts of the feature dictionary.
DICTIONARY_DESCRIPTION = "Transparent public-literature fragmentomics feature"
DICTIONARY_REGION = "bin_or_summary"
DICTIONARY_NORMALIZATION = "GC corrected and/or sample standardized where indicated"

# Interpretation notes of the evaluation report.
EVALUATION_WARNING = (
    "These metrics are computed on the supplied prediction file. If this is the same cohort used for training, "
    "ROC/PR curves are resubstitution-style diagnostics and can be strongly optimistic."
)
SCORE_WARNING = (
    "Prediction scores have very few unique values. ROC/PR curves may look deceptively clean because ranking "
    "collapses into a small number of score levels."
)
CLASSIFICATION_WARNING = (
    "All samples received the same classification. Inspect threshold_used and score ranking; "
    "this can happen when predicting on the training cohort or when many scores tie at the threshold."
)
