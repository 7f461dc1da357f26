"""Running totals, quantiles and ranks over a whole table without a one-task window."""

import functools

from pyspark.sql import DataFrame, Window, functions as F

PARTS = 64


def running_totals(levels: DataFrame, value: str, sums, groups=(), parts: int = PARTS) -> DataFrame:
    """Add `<c>_before` (sum over smaller values) and `<c>_total` for each c in `sums`.

    `levels` has one row per group and distinct value. Values are cut at approximate
    quantiles into `parts` ranges. Ranges are summed first (at most `parts` rows per
    group), so each task only accumulates inside one range and adds the sum of the
    ranges below. The cuts only balance the work; the totals are exact.
    """
    groups, sums = list(groups), list(sums)
    cuts = [i / parts for i in range(1, parts)]
    bounds = levels.agg(F.percentile_approx(value, cuts, F.lit(5000))).scalar()
    # First place of the value among the sorted cuts = number of smaller cuts.
    below = F.array_position(F.sort_array(F.array_append(bounds, F.col(value))), F.col(value)) - 1
    ranged = levels.withColumn("_range", below)
    order = Window.partitionBy(*groups).orderBy("_range")
    offsets = ranged.groupBy(*groups, "_range").agg(*[F.sum(c).alias(c) for c in sums]).select(
        *[F.col(g).alias(f"_g_{g}") for g in groups], F.col("_range").alias("_r"),
        *[F.coalesce(F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, -1)),
                     F.lit(0)).alias(f"_{c}_offset") for c in sums],
        *[F.sum(c).over(Window.partitionBy(*groups)).alias(f"{c}_total") for c in sums])
    match = functools.reduce(
        lambda a, b: a & b,
        [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups], F.col("_range") == F.col("_r"))
    inside = Window.partitionBy(*groups, "_range").orderBy(value).rowsBetween(
        Window.unboundedPreceding, -1)
    joined = ranged.join(offsets, match)
    for c in sums:
        joined = joined.withColumn(
            f"{c}_before", F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_{c}_offset"))
    return joined.drop("_range", "_r", *[f"_g_{g}" for g in groups], *[f"_{c}_offset" for c in sums])


def exact_quantiles(df: DataFrame, value: str, probs: dict, groups=(), parts: int = PARTS) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    `probs` maps output names to probabilities. Equal values are counted before any
    ordering, so a value that holds a third of the rows is one row here.
    """
    groups = list(groups)
    levels = (
        df.filter(F.col(value).isNotNull()).groupBy(*groups, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    placed = running_totals(levels, value, ["_n"], groups, parts)
    first, stop = F.col("_n_before"), F.col("_n_before") + F.col("_n")
    picks = []
    for name, prob in probs.items():
        position = (F.col("_n_total") - 1) * F.lit(float(prob))
        low, high = F.floor(position), F.ceil(position)
        picks += [
            F.max(F.when((first <= low) & (low < stop), F.col(value))).alias(f"_{name}_low"),
            F.max(F.when((first <= high) & (high < stop), F.col(value))).alias(f"_{name}_high"),
            F.max(position - low).alias(f"_{name}_weight"),
        ]
    found = placed.groupBy(*groups).agg(*picks)
    return found.select(*groups, *[
        (F.col(f"_{n}_low") + (F.col(f"_{n}_high") - F.col(f"_{n}_low")) * F.col(f"_{n}_weight")).alias(n)
        for n in probs
    ])


def hash_rank(df: DataFrame, groups, key, name: str, size_name: str | None = None) -> DataFrame:
    """Row numbers from 1 per group in the order of a hexadecimal hash column.

    A hash is uniform, so its first three characters cut every group into 4,096 even
    parts whose order is the order of the hash: parts are counted, offsets added, and
    only rows of one part are sorted together.
    """
    groups = list(groups)
    cut = df.withColumn("_cut", F.substring(key, 1, 3))
    order = Window.partitionBy(*groups).orderBy("_cut")
    parts = cut.groupBy(*groups, "_cut").agg(F.count(F.lit(1)).alias("_n")).select(
        *[F.col(g).alias(f"_g_{g}") for g in groups], F.col("_cut").alias("_c"),
        F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(*groups)).alias("_size"))
    match = functools.reduce(
        lambda a, b: a & b,
        [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups], F.col("_cut") == F.col("_c"))
    inside = Window.partitionBy(*groups, "_cut").orderBy(key)
    out = cut.join(parts, match).withColumn(name, F.row_number().over(inside) + F.col("_offset"))
    if size_name:
        out = out.withColumn(size_name, F.col("_size"))
    return out.drop("_cut", "_c", "_offset", "_size", *[f"_g_{g}" for g in groups])
