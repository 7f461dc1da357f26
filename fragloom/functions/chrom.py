"""Contig-name expressions."""

from pyspark.sql import Column, functions as F

from fragloom.constants import MITO_NAMES


def normalize_chrom(chrom: Column, style: str) -> Column:
    """Rename a contig to the `chr` or `no_chr` convention; other styles keep it."""
    bare = F.when(chrom.startswith("chr"), F.substring(chrom, F.lit(4), F.length(chrom))).otherwise(chrom)
    mito = bare.isin("M", "MT")
    if style == "chr":
        return F.when(mito, F.lit("chrM")).otherwise(F.concat(F.lit("chr"), bare))
    if style == "no_chr":
        return F.when(mito, F.lit("MT")).otherwise(bare)
    return chrom


def is_autosome(chrom: Column) -> Column:
    """Numbers 1 to 22, with or without `chr` and leading zeros."""
    return chrom.rlike("^(chr)?0*([1-9]|1[0-9]|2[0-2])$")


def is_mito(chrom: Column) -> Column:
    return chrom.isin(MITO_NAMES)
