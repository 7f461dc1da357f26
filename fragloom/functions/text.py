"""Sample-sheet, path and address expressions."""

import re

from pyspark.sql import Column, functions as F

from fragloom.constants import ACCEPTED_SUFFIXES, ARCHIVE_BASE_URL, MISSING_TOKENS


def present(value: Column) -> Column:
    """True when the cell holds something other than a missing-value token."""
    return F.coalesce(~F.trim(value).isin(MISSING_TOKENS), F.lit(False))


def present_or_null(value: Column) -> Column:
    return F.when(present(value), F.trim(value))


def trimmed(value: Column) -> Column:
    return F.trim(F.coalesce(value, F.lit("")))


def accepted_extension(path: Column) -> Column:
    suffixes = "|".join(re.escape(s) for s in ACCEPTED_SUFFIXES)
    return F.coalesce(path.rlike(f"({suffixes})$"), F.lit(False))


def is_web_address(path: Column) -> Column:
    return path.rlike("^https?://")


def safe_name(value: Column) -> Column:
    """Runs of characters outside letters, digits, `_`, `.`, `-` become one `_`."""
    return F.regexp_replace(F.regexp_replace(value, "[^A-Za-z0-9_.-]+", "_"), "^_+|_+$", "")


def build_download_url(key: Column, base: str = ARCHIVE_BASE_URL) -> Column:
    return F.concat(F.lit(base + "/data/"), key)


def normalize_download_url(value: Column, base: str = ARCHIVE_BASE_URL) -> Column:
    """Absolute address of a full address, a `/data/` path, or an archive key."""
    return (
        F.when(is_web_address(value), value)
        .when(value.startswith("/data/"), F.concat(F.lit(base), value))
        .when(value.startswith("data/"), F.concat(F.lit(base + "/"), value))
        .otherwise(build_download_url(F.regexp_replace(value, "^/+", ""), base))
    )


def fragment_suffix(url: Column) -> Column:
    """Suffix of the local copy of a fragment file."""
    return (
        F.when(url.endswith(".bed.gz"), ".bed.gz")
        .when(url.endswith(".frag.gz"), ".frag.gz")
        .when(url.endswith(".tsv.gz"), ".tsv.gz")
        .otherwise(".frag.tsv.gz")
    )
