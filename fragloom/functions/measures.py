"""Fragment-length and ratio expressions."""

from pyspark.sql import Column, functions as F

from fragloom.params import Params


def long_div(value: Column, width: int) -> Column:
    """Floor division of a coordinate, also below zero."""
    return F.floor(value / F.lit(float(width))).cast("long")


def share(part: Column, whole: Column) -> Column:
    """part / whole as double, 0.0 for an empty whole."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def ratio(top: Column, bottom: Column) -> Column:
    """top / max(bottom, 1)."""
    return top.cast("double") / F.greatest(bottom, F.lit(1))


def is_short(length: Column, params: Params) -> Column:
    return length.between(params.short_min, params.short_max)


def is_long(length: Column, params: Params) -> Column:
    return length.between(params.long_min, params.long_max)


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def entropy_bits(count: Column, total: Column) -> Column:
    """Shannon entropy in bits as an aggregate over rows of counts."""
    p = count.cast("double") / total
    return -F.sum(p * F.log2(p))


def numeric(value: Column) -> Column:
    """Number read from text; NULL when the text is no finite or infinite number."""
    parsed = value.try_cast("double")
    return F.when(~F.isnan(parsed), parsed)
