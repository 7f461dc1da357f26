"""Explicit schemas of the tables that jobs read and write."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_s, _l, _d, _b, _i = (
    T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.IntegerType(),
)

RAW_FRAGMENT = _struct(
    ("chrom", _s), ("start", _l), ("end", _l), ("mapq", _l), ("strand", _s),
)
FRAGMENT = _struct(
    ("sample_id", _s), ("chrom", _s), ("start", _l), ("end", _l), ("mapq", _l),
    ("strand", _s), ("length", _l), ("is_short", _b), ("is_long", _b),
)
ALIGNMENT = _struct(
    ("qname", _s), ("flag", _i), ("rname", _s), ("pos", _l), ("mapq", _i),
    ("rnext", _s), ("pnext", _l), ("tlen", _l),
)
CHROM_SIZES = _struct(("chrom", _s), ("size", _l))
BINS_GC = _struct(
    ("chrom", _s), ("start", _l), ("end", _l), ("bin_id", _s),
    ("gc_content", _d), ("effective_bin_size", _l),
)


def bed4(name):
    return _struct(("chrom", _s), ("start", _l), ("end", _l), (name, _s))


ANALYSIS_ITEM = _struct(("desc", _s), ("type", _s), ("key", _s))
METADATA_RECORD = _struct(
    ("id", _l),
    ("frag_num", _l),
    ("sample", _struct(("name", _s), ("disease", _s), ("tissue", _s))),
    ("analysis", T.MapType(_s, T.ArrayType(ANALYSIS_ITEM))),
)

FRAGMENT_COLUMNS = FRAGMENT.fieldNames()
BIN_COUNT_COLUMNS = [
    "sample_id", "chrom", "start", "end", "bin_id", "n_total_fragments",
    "n_short_100_150", "n_long_151_220", "short_long_ratio", "mean_fragment_length",
    "median_fragment_length", "coverage_total", "coverage_short", "coverage_long",
    "gc_content", "effective_bin_size",
]
