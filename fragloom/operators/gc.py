"""GC correction of bin coverage per sample."""

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F, types as T

from fragloom.functions import lowess as kernel, measures as m
from fragloom.functions.lowess import corrected
from fragloom.operators.ranking import exact_quantiles, running_totals
from fragloom.params import DEFAULTS, Params
from fragloom.session import shuffle_tasks, stage

# The kernel travels inside the task, executors need no copy of this package.
cloudpickle.register_pickle_by_value(kernel)

#: Bins of one block where a sample is fitted by several tasks, and robust passes.
BLOCK_POINTS, PASSES = 8_192, 3
#: Bins of a sample that one task may fit: about ten seconds if all have a gc value of their own.
SAMPLE_BINS = 65_536

METRICS = ["coverage_total", "coverage_short", "coverage_long"]
SUFFIX = "_gc_corrected"


def correct_gc(counts: DataFrame, params: Params = DEFAULTS, grid: float | None = None,
               tasks: int | None = None) -> DataFrame:
    """LOWESS correction: coverage - fit(gc) + median, for the three coverages.

    One task handles the bins of one sample, a number fixed by the genome and the bin
    size, not by sequencing depth. Only the key, gc and coverage columns enter Python.
    A sample is a few megabytes but seconds of work, so the samples are spread over a
    stated number of tasks (`tasks`, by default the configured shuffle tasks).
    """
    frac, metrics, suffix = params.lowess_frac, METRICS, SUFFIX
    schema = T.StructType(
        [T.StructField("sample_id", T.StringType()), T.StructField("chrom", T.StringType()),
         T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
         T.StructField("bin_id", T.StringType())]
        + [T.StructField(c, T.DoubleType()) for c in ("short_long_ratio", "mean_fragment_length", "gc_content")]
        + [T.StructField(c, T.DoubleType()) for c in METRICS]
        + [T.StructField(c + SUFFIX, T.DoubleType()) for c in METRICS]
    )

    def fit(pdf):
        values = corrected(pdf[metrics].to_numpy(), pdf["gc_content"].to_numpy(), frac, grid)
        for i, metric in enumerate(metrics):
            pdf[metric + suffix] = values[:, i]
        return pdf

    kept = [f for f in schema.fieldNames() if not f.endswith(SUFFIX)]
    tasks = tasks or shuffle_tasks(counts.sparkSession)
    spread = counts.select(*kept).repartition(tasks, "sample_id")
    return spread.groupBy("sample_id").applyInPandas(fit, schema)


def _fits_of_blocks(frac: float, columns: int):
    """Fits of one block of levels from the rows of the blocks it needs."""
    def fit(table):
        sample, block = table["sample_id"][0], table["_fit"][0].as_py()
        n, low, high = (table[c][0].as_py() for c in ("_total", "_low", "_high"))
        side = table["_side"].to_numpy()
        sums = table["_sums"].combine_chunks()
        near = table.filter(pa.array(side == 0)).sort_by("gc_content")
        x, size = near["gc_content"].to_numpy(), near["_n"].to_numpy()
        flat = near["_sums"].combine_chunks().flatten().to_numpy().reshape(len(x), 3 * columns)
        far = {}
        for s in (-1, 1):
            nodes = []
            for i in np.flatnonzero(side == s).tolist():
                values = sums[i].values.to_numpy()
                moments = values[2:].reshape(2, kernel.POWERS, columns)
                nodes.append(kernel.Node(values[0], values[1], *moments))
            far[s] = kernel.merged(nodes)
        own = near["_block"].to_numpy() == block
        fit_x = x[own]
        k = kernel.neighbours(n, frac)
        radius = kernel.window_radius(fit_x, x, near["_before"].to_numpy(), n, k, low, high)
        fits = kernel.fitted(
            fit_x, radius, x, flat[:, :columns], flat[:, columns: 2 * columns],
            flat[own, 2 * columns:] / size[own, None], far[-1], far[1])
        m = len(fit_x)
        return pa.table({
            "sample_id": pa.array([sample.as_py()] * m, pa.string()), "_block": pa.array([block] * m, pa.int64()),
            "gc_content": fit_x, **{f"_fit_{c}": fits[:, c] for c in range(columns)}})
    return fit


def _moments_of_blocks(columns: int):
    """One row for each block: the moments of its levels."""
    def moments(table):
        table = table.sort_by("gc_content")
        x = table["gc_content"].to_numpy()
        flat = table["_sums"].combine_chunks().flatten().to_numpy().reshape(len(x), 3 * columns)
        node = kernel.node(x, flat[:, :columns], flat[:, columns: 2 * columns])
        values = np.concatenate([[node.middle, node.half], node.r.ravel(), node.ry.ravel()])
        return pa.table({
            "sample_id": table["sample_id"].slice(0, 1).cast(pa.string()), "_block": table["_block"].slice(0, 1),
            "_sums": pa.array([values], pa.list_(pa.float64()))})
    return moments


def _plan_of_sample(frac: float):
    """Needed blocks of all blocks of one sample, from one row for each block."""
    def plan(table):
        table = table.sort_by("_block")
        block, total = table["_block"].to_numpy(), table["_total"][0].as_py()
        rows = kernel.block_plan(
            *(table[c].to_numpy() for c in ("_first", "_last", "_start")), total, frac)
        return pa.table({
            "sample_id": pa.array([table["sample_id"][0].as_py()] * len(rows), pa.string()),
            "_fit": block[rows[:, 0]], "_block": block[rows[:, 1]], "_side": rows[:, 2],
            "_low": rows[:, 3], "_high": rows[:, 4], "_total": np.full(len(rows), total)})
    return plan


def correct_gc_ranged(counts: DataFrame, params: Params = DEFAULTS, block: int = BLOCK_POINTS) -> DataFrame:
    """`correct_gc` for any number of bins in a sample: the same results, no task per sample.

    Bins with one gc value are one level. Levels are cut by running counts into blocks of about
    `block` bins. The fits of a block need the levels around it and at both edges of its
    neighbourhoods, which a plan over one row per block names, and only the moments of the blocks
    between them. Each robust pass sums the weights by level, fits the blocks, joins the fits back
    and takes the exact median of the residuals by ranges. Samples with fewer than 5 bins or one gc
    value get the median as their fit. Bins without gc are returned without a correction.
    """
    spark = counts.sparkSession
    names = ["sample_id", "chrom", "start", "end", "bin_id", "short_long_ratio", "mean_fragment_length", "gc_content", *METRICS]
    columns, key = len(METRICS), ["sample_id", "_block", "gc_content"]
    counts = stage(counts.select(*names), "lowess-bins")
    usable = counts.filter(F.col("gc_content").isNotNull())
    levels = usable.groupBy("sample_id", "gc_content").agg(F.count(F.lit(1)).alias("_n"))
    placed = stage(running_totals(levels, "gc_content", ["_n"], ["sample_id"]).select(
        "sample_id", "gc_content", F.col("_n_before").alias("_before"), F.col("_n_total").alias("_total"),
        m.long_div(F.col("_n_before"), block).alias("_block")), "lowess-levels")
    blocks = placed.groupBy("sample_id", "_block", "_total").agg(
        F.min("gc_content").alias("_first"), F.max("gc_content").alias("_last"), F.min("_before").alias("_start"))
    plan = stage(blocks.groupBy("sample_id").applyInArrow(
        _plan_of_sample(params.lowess_frac),
        "sample_id string, _fit long, _block long, _side long, _low long, _high long, _total long"), "lowess-plan")
    points = usable.join(placed, ["sample_id", "gc_content"])
    weights = {c: F.lit(1.0) for c in METRICS}
    fit_columns = [f"_fit_{c}" for c in range(columns)]
    for turn in range(PASSES + 1):
        terms = [*weights.values(), *[w * F.col(c) for c, w in weights.items()], *[F.col(c) for c in METRICS]]
        totals = points.repartition("sample_id", "_block").groupBy(*key).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_before").alias("_before"),
            F.array(*[F.sum(t) for t in terms]).alias("_sums"))
        totals = stage(totals, "lowess-sums")
        moments = totals.groupBy("sample_id", "_block").applyInArrow(
            _moments_of_blocks(columns), "sample_id string, _block long, _sums array<double>")
        needed = plan.filter("_side = 0").join(totals, ["sample_id", "_block"]).unionByName(
            plan.filter("_side <> 0").join(moments, ["sample_id", "_block"]), allowMissingColumns=True)
        schema = ", ".join(["sample_id string, _block long, gc_content double", *[f"{c} double" for c in fit_columns]])
        fits = needed.groupBy("sample_id", "_fit").applyInArrow(_fits_of_blocks(params.lowess_frac, columns), schema)
        points = stage(points.drop(*fit_columns).join(fits, key), "lowess-fits")
        if turn < PASSES:
            raw = {c: F.abs(F.col(c) - F.col(f)) for c, f in zip(METRICS, fit_columns)}
            points = points.drop(*[f"_most_{c}" for c in METRICS])
            points = points.join(points.groupBy("sample_id").agg(*[F.max(g).alias(f"_most_{c}") for c, g in raw.items()]), "sample_id")
            gaps = {c: F.when(g > F.col(f"_most_{c}") * kernel.NOISE, g).otherwise(0.0) for c, g in raw.items()}
            middle = _medians(points.select("sample_id", *[g.alias(c) for c, g in gaps.items()]), "_gap")
            points = points.drop(*[f"_gap_{c}" for c in METRICS]).join(middle, "sample_id")
            weights = {c: _bisquare(gaps[c], F.col(f"_gap_{c}")) for c in METRICS}
    middle = _medians(counts, "_middle")
    flat = points.groupBy("sample_id").agg(((F.max("_total") < 5) | (F.min("gc_content") == F.max("gc_content"))).alias("_flat"))
    out = points.select(*names, *fit_columns).unionByName(
        counts.filter(F.col("gc_content").isNull()), allowMissingColumns=True).join(middle, "sample_id").join(flat, "sample_id", "left")
    for c, f in zip(METRICS, fit_columns):
        fit = F.when(F.col("_flat"), F.col(f"_middle_{c}")).otherwise(F.col(f))
        out = out.withColumn(c + SUFFIX, F.col(c) - fit + F.col(f"_middle_{c}"))
    return out.select(*names, *[c + SUFFIX for c in METRICS])


def _medians(rows: DataFrame, prefix: str) -> DataFrame:
    """Exact medians of the metrics of each sample as columns, by ranges of values."""
    long = rows.select("sample_id", *METRICS).unpivot("sample_id", METRICS, "_metric", "_value")
    found = exact_quantiles(long, "_value", {"_middle": 0.5}, ["sample_id", "_metric"])
    return found.groupBy("sample_id").agg(*[
        F.max(F.when(F.col("_metric") == c, F.col("_middle"))).alias(f"{prefix}_{c}") for c in METRICS])


def _bisquare(gap, middle):
    """Robust weight of an absolute residual, given the median of its sample."""
    scale = middle * 6.0
    u = F.when(scale > 0, gap / scale).otherwise(F.when(gap > 0, 1.0).otherwise(0.0))
    u = F.when(u >= 0.999, 1.0).when(u <= 0.001, 0.0).otherwise(u)
    inner = 1.0 - u * u
    return inner * inner


def correct_gc_identity(counts: DataFrame) -> DataFrame:
    """The correction where gc carries no information: the fit is the sample median.

    Applies to samples with fewer than 5 bins or one gc value; other samples get NULL.
    """
    sample = Window.partitionBy("sample_id")
    flat = (F.count(F.lit(1)).over(sample) < 5) | (
        F.min("gc_content").over(sample) == F.max("gc_content").over(sample))
    out = counts
    for metric in METRICS:
        middle = F.median(metric).over(sample)
        out = out.withColumn(metric + SUFFIX, F.when(flat, F.col(metric) - middle + middle))
    return out


def correct_gc_linear(counts: DataFrame) -> DataFrame:
    """Straight-line fallback: least squares of coverage on gc per sample, as window
    aggregates over the bins of the sample. Flat samples get their median, as in LOWESS."""
    sample = Window.partitionBy("sample_id")
    flat = (F.count(F.lit(1)).over(sample) < 5) | (
        F.min("gc_content").over(sample) == F.max("gc_content").over(sample))
    out = counts
    for metric in METRICS:
        slope = F.regr_slope(metric, "gc_content").over(sample)
        shift = F.regr_intercept(metric, "gc_content").over(sample)
        middle = F.median(metric).over(sample)
        fit = F.when(flat, middle).otherwise(slope * F.col("gc_content") + shift)
        out = out.withColumn(metric + SUFFIX, F.col(metric) - fit + middle)
    return out


def correct(counts: DataFrame, bins: int, params: Params = DEFAULTS, method: str = "lowess") -> DataFrame:
    """Corrected coverages by `method`, lowess or linear.

    `bins` is the number of bins of one sample. Up to `SAMPLE_BINS` LOWESS handles a sample in one
    task; beyond it a sample is cut into ranges of gc. Both give the same values.
    """
    if method == "linear":
        return correct_gc_linear(counts)
    if method != "lowess":
        raise ValueError(f"unknown correction {method!r}")
    return correct_gc(counts, params) if bins <= SAMPLE_BINS else correct_gc_ranged(counts, params)
