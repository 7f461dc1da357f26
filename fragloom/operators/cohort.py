"""Labels, splits, imputation, class weights and feature selection on long features."""

import functools
import operator

from pyspark.sql import DataFrame, Window, functions as F

from fragloom.functions import labels as lab, measures as m
from fragloom.operators.joins import has_at_most, lookup_join, top_rows_per_group
from fragloom.operators.ranking import exact_quantiles, hash_rank, running_totals
from fragloom.params import DEFAULTS, Params

MEDIAN_COHORT_LIMIT = 100_000


def parse_labels(samples: DataFrame, label: str = "label") -> DataFrame:
    return samples.withColumn("y", lab.binary_label(F.col(label)))


def require_two_classes(labelled: DataFrame) -> None:
    counts = {r["y"]: r["n"] for r in labelled.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) != 2:
        raise ValueError(f"training needs two classes after label parsing, found {counts}")


def numeric_values(features: DataFrame) -> DataFrame:
    """Values as numbers; text that is no number becomes NULL."""
    return features.withColumn("value", m.numeric(F.col("value").cast("string")))


def usable_features(features: DataFrame) -> DataFrame:
    """Names with at least one value; constant features stay."""
    return features.groupBy("feature_name").agg(F.count("value").alias("n_values")).filter(
        F.col("n_values") > 0)


def class_weights(labelled: DataFrame) -> DataFrame:
    """Balanced weight n / (2 * n_class) per class."""
    counts = labelled.groupBy("y").agg(F.count(F.lit(1)).alias("n_class"))
    total = F.sum("n_class").over(Window.partitionBy(F.lit(0)))
    return counts.select("y", "n_class", (total.cast("double") / (F.col("n_class") * 2.0)).alias("weight"))


def _hashed(labelled, params):
    key = F.md5(F.concat(F.lit(f"{params.seed}|"), F.col("sample_id").cast("string")))
    return labelled.withColumn("_hash", key)


def _class_sizes(labelled):
    """Both class sizes from one scalar subquery."""
    both = labelled.agg(F.struct(*[
        m.count_where(F.col("y") == y).alias(f"n{y}") for y in (0, 1)])).scalar()
    return both.getField("n0"), both.getField("n1")


def stratified_split(labelled: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Column `partition` (train / test), with the class shares kept.

    Sizes follow the largest-remainder rule on n - ceil(test_size * n) training rows.
    The draw is the order of md5(seed|sample_id): repeatable and independent of row
    order and partitioning. Cohorts with fewer than 8 samples or a class below 2 are
    used for training only.
    """
    n0, n1 = _class_sizes(labelled)
    n = n0 + n1
    n_train = n - F.ceil(n * F.lit(params.test_size))
    share0, share1 = n0 * n_train / n, n1 * n_train / n
    left = n_train - F.floor(share0) - F.floor(share1)
    first = share0 - F.floor(share0) >= share1 - F.floor(share1)
    train0 = F.floor(share0) + F.when(first, left).otherwise(0)
    train1 = F.floor(share1) + F.when(first, 0).otherwise(left)
    possible = (F.least(n0, n1) >= 2) & (n >= 8) & F.lit(params.test_size > 0)
    test = F.when(F.col("y") == 0, n0 - train0).otherwise(n1 - train1)
    ranked = hash_rank(_hashed(labelled, params), ["y"], "_hash", "_rank")
    in_test = possible & (F.col("_rank") <= test)
    return ranked.withColumn("partition", F.when(in_test, "test").otherwise("train")).drop("_hash", "_rank")


def kfold(labelled: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Column `fold` (0-based) of a stratified k-fold with k = min(folds, smallest class);
    NULL when the smallest class has fewer than 2 samples."""
    smallest = F.least(*_class_sizes(labelled))
    k = F.least(F.lit(params.folds).cast("long"), smallest)
    ranked = hash_rank(_hashed(labelled, params), ["y"], "_hash", "_rank")
    fold = F.when(k >= 2, (F.col("_rank") - 1) % F.greatest(k, F.lit(2).cast("long")))
    return ranked.withColumn("fold", fold.cast("int")).drop("_hash", "_rank")


def small_cohort(class_sizes: DataFrame, limit: int = MEDIAN_COHORT_LIMIT) -> bool:
    """True when no group of (.., y, n_class) rows sums to more samples than `limit`,
    so that an aggregate may keep all values of one feature."""
    largest = class_sizes.agg(F.max("n_class")).head()[0]
    return 2 * (largest or 0) <= limit


def feature_medians(rows: DataFrame, groups=("feature_name",),
                    cohort_limit: int = MEDIAN_COHORT_LIMIT) -> DataFrame:
    """Exact median per feature (and fold) of the non-missing values.

    A feature has one value per sample. Up to a counted cohort size the aggregate
    keeps that many values; larger cohorts use the range-wise quantile instead.
    """
    groups = list(groups)
    cohort = rows.select("sample_id").distinct()
    if has_at_most(cohort, cohort_limit):
        return rows.filter(F.col("value").isNotNull()).groupBy(*groups).agg(F.median("value").alias("fill"))
    return exact_quantiles(rows, "value", {"fill": 0.5}, groups)


def impute(features: DataFrame, fills: DataFrame, names=("feature_name",)) -> DataFrame:
    """Missing values of existing rows take the fill of their feature."""
    return lookup_join(features, fills, list(names), "left").withColumn(
        "value", F.coalesce("value", "fill")).drop("fill")


def selection_stats(rows: DataFrame, labelled: DataFrame, groups=("feature_name",)) -> DataFrame:
    """Per feature: class sizes, means and squared deviations after median imputation.

    `rows` holds (groups..., sample_id, y, value) of the training samples. Missing
    values enter as `missing count x median` with the pairwise update of mean and
    squared deviation, so no completed matrix is built. `labelled` holds the sample
    counts (fold columns of `groups`..., y, n_class).
    """
    groups = list(groups)
    folds = [g for g in groups if g != "feature_name"]
    value = F.col("value")
    columns = [
        column for y in (0, 1) for column in (
            F.count(F.when(F.col("y") == y, value)).alias(f"n{y}"),
            F.avg(F.when(F.col("y") == y, value)).alias(f"mean{y}"),
            F.var_pop(F.when(F.col("y") == y, value)).alias(f"var{y}"))
    ]
    if small_cohort(labelled):
        stats = rows.groupBy(*groups).agg(*columns, F.median("value").alias("fill"))
        stats = stats.filter(F.col("fill").isNotNull())
    else:
        fills = exact_quantiles(rows, "value", {"fill": 0.5}, groups)
        stats = rows.groupBy(*groups).agg(*columns).join(fills, groups)
    sizes = labelled.groupBy(*folds).agg(*[
        F.max(F.when(F.col("y") == y, F.col("n_class"))).alias(f"size{y}") for y in (0, 1)])
    if folds:
        stats = lookup_join(stats, sizes, folds)
    else:
        stats = stats.withColumns({f"size{y}": sizes.select(f"size{y}").scalar() for y in (0, 1)})
    completed = {}
    for y in (0, 1):
        n, mean, var = F.col(f"n{y}"), F.coalesce(f"mean{y}", F.lit(0.0)), F.coalesce(f"var{y}", F.lit(0.0))
        completed |= _imputed(y, n, mean, n.cast("double") * var, F.col(f"size{y}"), F.col("fill"))
    return stats.withColumns(completed).select(*groups, "fill", "size0", "size1", "m0", "m1", "ss0", "ss1")


def _imputed(y, n, mean, squares, size, fill) -> dict:
    """Mean and squared deviations of a class when its missing values take the fill."""
    n, size = n.cast("double"), size.cast("double")
    missing = size - n
    gap = F.when(n > 0, fill - mean).otherwise(0.0)
    return {f"m{y}": F.when(n > 0, mean + gap * missing / size).otherwise(fill),
            f"ss{y}": squares + gap * gap * n * missing / size}


def fold_stats(rows: DataFrame, training: DataFrame, folds: int) -> DataFrame:
    """`selection_stats` of every cross-validation fit from one pass over the long table.

    `rows` holds (sample_id, feature_name, y, fold, value) of the training samples, `training`
    (sample_id, y, fold). Fit f leaves fold f out, fit `folds` leaves none out; with 0 folds there
    is only that one. A row enters once: each feature gets (count, mean, squared deviations) per
    class and fold, and those of a fit are merged from its folds. Its median is the value whose
    place among all values of the feature, less the places of the fold left out, is the middle.
    """
    parts = range(max(folds, 1))
    cells = [(y, g) for y in (0, 1) for g in parts]
    kept = {f: [g for g in parts if folds == 0 or g != f] for f in range(folds + 1)}
    rows = rows.filter(F.col("value").isNotNull()).withColumn("fold", F.coalesce("fold", F.lit(0)))
    moments = [F.count(F.lit(1)).cast("double").alias("n"), F.avg("value").alias("mean"), F.var_pop("value").alias("var")]
    middles = [f"{name}_{f}" for f in kept for name in ("low", "high")]
    if has_at_most(training, MEDIAN_COHORT_LIMIT):
        # A feature has one value per sample: its rows are shuffled and sorted once, everything follows.
        feature = Window.partitionBy("feature_name")
        before = feature.orderBy("value", "sample_id").rowsBetween(Window.unboundedPreceding, -1)
        placed = rows.withColumns({f"_{g}_n": (F.col("fold") == g).cast("long") for g in parts}).withColumns({
            **{f"_{g}_n_before": F.coalesce(F.sum(f"_{g}_n").over(before), F.lit(0)) for g in parts},
            **{f"_{g}_n_total": F.sum(f"_{g}_n").over(feature) for g in parts}})
        first = _with_middles(placed, kept).groupBy("feature_name", "y", "fold").agg(*moments, *[F.max(c).alias(c) for c in middles])
        stats = first.groupBy("feature_name").agg(*_by_cell(cells), *[F.max(c).alias(c) for c in middles])
    else:
        levels = rows.groupBy("feature_name", "value").agg(*[m.count_where(F.col("fold") == g).alias(f"_{g}_n") for g in parts])
        placed = running_totals(levels, "value", [f"_{g}_n" for g in parts], ["feature_name"])
        medians = _with_middles(placed, kept).groupBy("feature_name").agg(*[F.max(c).alias(c) for c in middles])
        first = rows.groupBy("feature_name", "y", "fold").agg(*moments)
        stats = first.groupBy("feature_name").agg(*_by_cell(cells)).join(medians, "feature_name")
    sizes = training.agg(F.struct(*[
        m.count_where((F.col("y") == y) & (F.coalesce("fold", F.lit(0)) == g)).alias(f"n{y}_{g}") for y, g in cells])).scalar()
    fits = F.explode(F.array(*[
        F.struct(F.lit(f).alias("fit_fold"), ((F.col(f"low_{f}") + F.col(f"high_{f}")) / 2).alias("fill")) for f in kept]))
    fit = stats.withColumn("fit", fits).select("*", "fit.fit_fold", "fit.fill").filter(F.col("fill").isNotNull())

    def over_folds(value, y):
        """Sum over the folds that the fit of a row is trained on."""
        return functools.reduce(operator.add, [
            F.when((F.col("fit_fold") != g) | F.lit(folds == 0), value(y, g)).otherwise(0.0) for g in parts])

    # Steps of their own: nothing that is used more than once is computed twice.
    fit = fit.withColumns({
        **{f"n{y}": over_folds(lambda y, g: F.col(f"n{y}_{g}"), y) for y in (0, 1)},
        **{f"total{y}": over_folds(lambda y, g: F.col(f"n{y}_{g}") * F.col(f"mean{y}_{g}"), y) for y in (0, 1)},
        **{f"size{y}": over_folds(lambda y, g: sizes.getField(f"n{y}_{g}"), y).cast("long") for y in (0, 1)}})
    fit = fit.withColumns({f"mean{y}": F.col(f"total{y}") / F.greatest(f"n{y}", F.lit(1.0)) for y in (0, 1)})
    fit = fit.withColumns({f"squares{y}": over_folds(
        lambda y, g: F.col(f"n{y}_{g}") * (F.col(f"var{y}_{g}") + F.pow(F.col(f"mean{y}_{g}") - F.col(f"mean{y}"), F.lit(2.0))), y) for y in (0, 1)})
    completed = {}
    for y in (0, 1):
        completed |= _imputed(y, F.col(f"n{y}"), F.col(f"mean{y}"), F.col(f"squares{y}"), F.col(f"size{y}"), F.col("fill"))
    return fit.withColumns(completed).select("fit_fold", "feature_name", "fill", "size0", "size1", "m0", "m1", "ss0", "ss1")


def _by_cell(cells):
    """Moments of each class and fold as columns; a cell without values counts 0."""
    return [
        F.coalesce(F.max(F.when((F.col("y") == y) & (F.col("fold") == g), F.col(name))), F.lit(0.0)).alias(f"{name}{y}_{g}")
        for y, g in cells for name in ("n", "mean", "var")]


def _with_middles(placed, kept):
    """The value of a row where it is one of the two middle ones of a fit, from running counts per fold."""
    for f, folds in kept.items():
        placed = placed.withColumns({f"_{f}{suffix}": functools.reduce(
            operator.add, [F.col(f"_{g}_n{suffix}") for g in folds]) for suffix in ("", "_before", "_total")})
    columns = {}
    for f in kept:
        n, before, total = (F.col(f"_{f}{suffix}") for suffix in ("", "_before", "_total"))
        for name, place in (("low", F.floor((total - 1) / 2)), ("high", F.ceil((total - 1) / 2))):
            columns[f"{name}_{f}"] = F.when((before <= place) & (place < before + n), F.col("value"))
    return placed.withColumns(columns)


def anova_f(stats: DataFrame) -> DataFrame:
    """One-way F statistic of two classes and the population sd per feature.

    F is infinite without spread inside the classes, NULL for a constant feature.
    """
    n0, n1 = F.col("size0").cast("double"), F.col("size1").cast("double")
    gap = F.col("m1") - F.col("m0")
    between = gap * gap * n0 * n1 / (n0 + n1)
    within = F.col("ss0") + F.col("ss1")
    f = (
        F.when(within > 0, between / (within / (n0 + n1 - 2.0)))
        .when(between > 0, F.lit(float("inf")))
    )
    sd = F.sqrt((between + within) / (n0 + n1))
    return stats.withColumns({"f_value": f, "sd": sd}).drop("m0", "m1", "ss0", "ss1", "size0", "size1")


def select_k_best(scored: DataFrame, k: int, groups=()) -> DataFrame:
    """The k features with the highest F; NULL ranks last, ties go to the later name. k = 0: all."""
    if k <= 0:
        return scored
    order = [F.col("f_value").desc_nulls_last(), F.col("feature_name").desc()]
    if groups:
        return top_rows_per_group(scored, list(groups), order, k)
    return scored.orderBy(*order).limit(k)


def class_counts(samples: DataFrame, partition: str = "partition") -> DataFrame:
    """Samples per class: total, train and test."""
    return samples.groupBy("y").agg(
        F.count(F.lit(1)).alias("total"),
        m.count_where(F.col(partition) == "train").alias("train"),
        m.count_where(F.col(partition) == "test").alias("test"))


def join_labels(features: DataFrame, labelled: DataFrame, *columns) -> DataFrame:
    """Feature rows of labelled samples with y (and further sample columns)."""
    keep = labelled.select("sample_id", "y", *columns)
    return lookup_join(features.select("sample_id", "feature_name", "value"), keep, ["sample_id"])


def fold_union(frames) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)
