"""Label and classification expressions."""

from pyspark.sql import Column, functions as F

from fragloom.constants import ELEVATED, LOWER, NEGATIVE_LABELS


def binary_label(label: Column) -> Column:
    """0 for control words and missing labels, 1 for every other word."""
    text = F.lower(F.trim(F.coalesce(label.cast("string"), F.lit(""))))
    return F.when(text.isin(NEGATIVE_LABELS), 0).otherwise(1)


def classify(score: Column, threshold: Column) -> Column:
    """Scores strictly above the threshold are elevated; a missing score has no class."""
    return F.when(score > threshold, ELEVATED).when(score <= threshold, LOWER)
