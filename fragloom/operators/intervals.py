"""Overlap joins between two tables of genomic intervals."""

from pyspark.sql import DataFrame, functions as F

from fragloom.operators.joins import BROADCAST_BYTES, lookup_join

# Bucket widths. A left interval uses the smallest width that is not shorter than it;
# the last width covers every coordinate.
WIDTHS = (1 << 14, 1 << 20, 1 << 26, 1 << 32)
# For left intervals and right intervals of a few hundred bases.
NARROW_WIDTHS = (1 << 9, 1 << 14, 1 << 20, 1 << 26, 1 << 32)
#: Real bytes of a right row and its copies of one width, for each byte of the estimate.
UNSEEN = 64


def _width(length, widths):
    out = F.when(length <= widths[0], F.lit(widths[0]))
    for width in widths[1:-1]:
        out = out.when(length <= width, F.lit(width))
    return out.otherwise(F.lit(widths[-1])).cast("long")


def _bucket(position, width):
    return F.floor(position / width.cast("double")).cast("long")


def overlap_join(left: DataFrame, right: DataFrame, how="inner", keys=("chrom",),
                 left_span=("start", "end"), right_span=("r_start", "r_end"), widths=WIDTHS, **options):
    """Join rows whose half-open intervals overlap:
    left.start < right.end and left.end > right.start.

    Every left row keeps exactly one bucket, that of its start. A right row is
    repeated for each bucket in which an overlapping left row of that width can
    start. So left rows are never copied, pairs never repeat, interval lengths have
    no cap, and `left_anti` / `left_semi` work unchanged. The repeated right side is
    broadcast only where the right table is estimated at a small part of what may be sent: the
    estimate sees neither the copies nor how far its file is compressed. `widths` balances copies
    of the right side against candidates per bucket.
    """
    options.setdefault("max_bytes", BROADCAST_BYTES // (UNSEEN * len(widths)))
    ls, le = (F.col(f"`{c}`") for c in left_span)
    rs, re_ = (F.col(f"`{c}`") for c in right_span)
    left_b = (
        left.withColumn("_width", _width(le - ls, widths))
        .withColumn("_bucket", _bucket(ls, F.col("_width")))
    )
    right_b = (
        right.withColumn("_width", F.explode(F.array(*[F.lit(w).cast("long") for w in widths])))
        .withColumn("_first", _bucket(rs - F.col("_width") + 1, F.col("_width")))
        .withColumn("_last", _bucket(re_ - 1, F.col("_width")))
        .withColumn("_bucket", F.explode(F.sequence("_first", "_last")))
        .drop("_first", "_last")
    )

    residual = (ls < re_) & (le > rs)
    joined = lookup_join(left_b, right_b, [*keys, "_width", "_bucket"], how, residual, grows=True, **options)
    return joined.drop("_width", "_bucket")
