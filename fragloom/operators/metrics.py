"""Threshold, ROC, precision-recall and score summaries.

All functions take one row per scored sample with a 0/1 truth column and a score.
`groups` computes the same per group (for example per partition or model) at once.
Scores are reduced to one row per distinct score first.
"""

from pyspark.sql import DataFrame, functions as F

from fragloom.constants import ELEVATED
from fragloom.functions import labels as lab, measures as m
from fragloom.operators.joins import lookup_join
from fragloom.operators.ranking import exact_quantiles, running_totals


def score_levels(df: DataFrame, truth: str, score: str, groups=()) -> DataFrame:
    """Per distinct score: positives and negatives at it, above it, and in total."""
    positive = F.col(truth) == 1
    levels = (
        df.filter(F.col(score).isNotNull()).groupBy(*groups, F.col(score).alias("score"))
        .agg(m.count_where(positive).alias("pos"), m.count_where(~positive).alias("neg"))
    )
    placed = running_totals(levels, "score", ["pos", "neg"], groups)
    return placed.withColumns({
        "pos_above": F.col("pos_total") - F.col("pos_before") - F.col("pos"),
        "neg_above": F.col("neg_total") - F.col("neg_before") - F.col("neg"),
    })


def areas(df: DataFrame, truth: str, score: str, groups=()) -> DataFrame:
    """roc_auc (ties count half) and pr_auc (average precision, step-wise) per group;
    NULL unless both classes occur."""
    levels = score_levels(df, truth, score, groups)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    above, total_pos = F.col("pos_above").cast("double"), F.col("pos_total").cast("double")
    tp = above + pos
    fp = (F.col("neg_above") + F.col("neg")).cast("double")
    both = (F.first("pos_total") > 0) & (F.first("neg_total") > 0)
    auc = F.sum(neg * (above + pos / 2.0)) / F.greatest(
        F.first(total_pos) * F.first("neg_total").cast("double"), F.lit(1.0))
    precision = tp / F.greatest(tp + fp, F.lit(1.0))
    ap = F.sum(pos * precision) / F.greatest(F.first(total_pos), F.lit(1.0))
    return levels.groupBy(*groups).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n_samples"),
        F.count(F.lit(1)).alias("unique_score_count"),
        F.when(both, auc).alias("roc_auc"), F.when(both, ap).alias("pr_auc"))


def roc_auc(df, truth, score, groups=()):
    return areas(df, truth, score, groups).select(*groups, "roc_auc")


def average_precision(df, truth, score, groups=()):
    return areas(df, truth, score, groups).select(*groups, "pr_auc")


def roc_curve(df: DataFrame, truth: str, score: str, groups=()) -> DataFrame:
    """(fpr, tpr, threshold) at each distinct score, with the origin at threshold infinity."""
    levels = score_levels(df, truth, score, groups)
    points = levels.select(
        *groups,
        m.ratio(F.col("neg_above") + F.col("neg"), F.col("neg_total")).alias("fpr"),
        m.ratio(F.col("pos_above") + F.col("pos"), F.col("pos_total")).alias("tpr"),
        F.col("score").alias("threshold"))
    zero = F.lit(0.0)
    origin = levels.select(*groups, zero.alias("fpr"), zero.alias("tpr"),
                           F.lit(float("inf")).alias("threshold")).distinct()
    return points.unionByName(origin)


def pr_curve(df: DataFrame, truth: str, score: str, groups=()) -> DataFrame:
    """(recall, precision, threshold) at each distinct score, and the end point
    (0, 1) that has no threshold."""
    levels = score_levels(df, truth, score, groups)
    tp = F.col("pos_above") + F.col("pos")
    points = levels.select(
        *groups,
        m.ratio(tp, F.col("pos_total")).alias("recall"),
        m.ratio(tp, tp + F.col("neg_above") + F.col("neg")).alias("precision"),
        F.col("score").alias("threshold"))
    end = levels.select(*groups, F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"),
                        F.lit(None).cast("double").alias("threshold")).distinct()
    return points.unionByName(end)


def thresholds_at_specificity(df: DataFrame, truth: str, score: str,
                              specificities=(0.95, 0.98, 0.99), groups=()) -> DataFrame:
    """Interpolated quantile of the control scores per specificity; 0.5 without controls."""
    groups = list(groups)
    controls = df.filter(F.col(truth) == 0)
    names = {f"s{i}": s for i, s in enumerate(specificities)}
    found = exact_quantiles(controls, score, names, groups)
    if groups:
        everyone = df.select(*groups).distinct()
        found = everyone.join(found, groups, "left")
    rows = F.array(*[
        F.struct(F.lit(float(s)).alias("specificity"), F.coalesce(n, F.lit(0.5)).alias("threshold"))
        for n, s in names.items()
    ])
    if not groups:
        # An aggregate without keys still yields one row when there are no controls.
        found = found.agg(*[F.max(n).alias(n) for n in names])
    return found.select(*groups, F.explode(rows).alias("r")).select(
        *groups, "r.specificity", "r.threshold")


def sensitivity_at_thresholds(df: DataFrame, thresholds: DataFrame, truth: str, score: str,
                              groups=()) -> DataFrame:
    """Share of positives with score >= threshold, NULL without positives.

    `thresholds` has a handful of rows per group (one per specificity).
    """
    groups = list(groups)
    limits = thresholds.groupBy(*groups).agg(
        F.sort_array(F.collect_list(F.struct("specificity", "threshold"))).alias("limits"))
    rows = df.filter(F.col(score).isNotNull())
    if groups:
        joined = lookup_join(rows, limits, groups)
    else:
        joined = rows.withColumn("limits", limits.select("limits").scalar())
    positive = F.col(truth) == 1
    hit = F.when(positive, (F.col(score) >= F.col("l.threshold")).cast("double"))
    return (
        joined.select(*groups, truth, score, F.explode("limits").alias("l"))
        .groupBy(*groups, F.col("l.specificity").alias("specificity"), F.col("l.threshold").alias("threshold"))
        .agg(F.avg(hit).alias("sensitivity"))
    )


def _confusion(called, truth: str):
    positive = F.col(truth) == 1
    return [
        m.count_where(positive & called).alias("tp"),
        m.count_where(~positive & ~called).alias("tn"),
        m.count_where(~positive & called).alias("fp"),
        m.count_where(positive & ~called).alias("fn"),
    ]


def _with_rates(counts: DataFrame) -> DataFrame:
    return counts.withColumns({
        "sensitivity": m.ratio(F.col("tp"), F.col("tp") + F.col("fn")),
        "specificity": m.ratio(F.col("tn"), F.col("tn") + F.col("fp")),
    })


def confusion_at_threshold(df: DataFrame, truth: str, score: str, threshold, groups=()) -> DataFrame:
    """Confusion counts and rates; a sample is called positive above the threshold."""
    threshold = threshold if not isinstance(threshold, (int, float)) else F.lit(float(threshold))
    called = F.coalesce(F.col(score) > threshold, F.lit(False))
    return _with_rates(df.groupBy(*groups).agg(*_confusion(called, truth)))


def confusion_of_classes(df: DataFrame, truth: str, classification: str, groups=()) -> DataFrame:
    """The same from stored class names."""
    called = F.coalesce(F.col(classification) == ELEVATED, F.lit(False))
    return _with_rates(df.groupBy(*groups).agg(*_confusion(called, truth)))


def score_summary(df: DataFrame, score: str) -> DataFrame:
    """Rows, scored rows, minimum, exact median, maximum and number of distinct scores."""
    counts = df.agg(F.count(F.lit(1)).alias("n_samples"), F.count(score).alias("n_predictions"),
                    F.min(score).alias("score_min"), F.max(score).alias("score_max"))
    distinct = df.filter(F.col(score).isNotNull()).select(score).distinct().agg(F.count(F.lit(1)))
    median = exact_quantiles(df, score, {"q": 0.5}).select("q")
    return counts.select(
        "n_samples", "n_predictions", "score_min", median.scalar().alias("score_median"),
        "score_max", distinct.scalar().alias("unique_score_count"))


def describe_scores(df: DataFrame, score: str, group: str) -> DataFrame:
    """count, mean, std, min, quartiles and max per group; NULL is a group of its own."""
    moments = df.groupBy(F.col(group).alias("_group")).agg(
        F.count(score).alias("count"), F.avg(score).alias("mean"),
        F.stddev_samp(score).alias("std"), F.min(score).alias("min"), F.max(score).alias("max"))
    quartiles = exact_quantiles(df, score, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, [group])
    return moments.join(quartiles, F.col("_group").eqNullSafe(F.col(group)), "left").select(
        F.col("_group").alias(group), "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def score_histogram(df: DataFrame, score: str, group: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over each group's own range; the last bin is closed.

    A group with one distinct score spans half a unit to both sides of it.
    """
    rows = df.filter(F.col(score).isNotNull())
    span = rows.groupBy(F.col(group).alias("_group")).agg(
        F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    flat = F.col("_hi") == F.col("_lo")
    span = span.select("_group", F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
                       F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    number = F.least(F.floor((F.col(score) - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    counted = (
        rows.groupBy(F.col(group), F.col(score)).agg(F.count(F.lit(1)).alias("_n"))
        .join(span, F.col(group).eqNullSafe(F.col("_group")))
        .groupBy("_group", "_lo", "_hi", number.alias("bin")).agg(F.sum("_n").alias("n_samples"))
    )
    return counted.select(
        F.col("_group").alias(group), "bin",
        (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"), "n_samples")


def score_boxplot(df: DataFrame, score: str, group: str) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 IQR, and outlier counts per group."""
    rows = df.filter(F.col(score).isNotNull() & F.col(group).isNotNull())
    quartiles = exact_quantiles(rows, score, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    levels = rows.groupBy(group, score).agg(F.count(F.lit(1)).alias("_n")).join(quartiles, group)
    inside = F.col(score).between(F.col("q1") - reach, F.col("q3") + reach)
    return levels.groupBy(group, "q1", "median", "q3").agg(
        F.least(F.min(F.when(inside, F.col(score))), "q1").alias("whisker_low"),
        F.greatest(F.max(F.when(inside, F.col(score))), "q3").alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("n_outliers"))


def with_truth(df: DataFrame, label: str = "label", name: str = "y_true") -> DataFrame:
    return df.withColumn(name, lab.binary_label(F.col(label)))
