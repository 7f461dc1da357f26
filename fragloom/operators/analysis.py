"""Tables of the evaluation report."""

from pyspark.sql import DataFrame, functions as F

from fragloom import constants as C
from fragloom.functions import labels as lab
from fragloom.operators import metrics
from fragloom.operators.joins import lookup_join
from fragloom.operators.ranking import running_totals

EVALUATION_COLUMNS = [c for c in C.META_COLUMNS if c != "sample_id"]


def predictions_with_labels(metadata: DataFrame, predictions: DataFrame) -> DataFrame:
    """All predictions with the metadata of their sample (right join)."""
    columns = [c for c in EVALUATION_COLUMNS if c in metadata.columns]
    return metadata.select("sample_id", *columns).join(predictions, "sample_id", "right")


def ranked_predictions(df: DataFrame, score: str = "cancer_probability") -> DataFrame:
    """Highest score first, ties by sample id, with the rank by score (ties share it).

    The rank counts the rows with a higher score through running totals over distinct
    scores, and the order is a range-partitioned sort: no task sees the whole table.
    """
    counts = df.filter(F.col(score).isNotNull()).groupBy(score).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_totals(counts, score, ["_n"])
    ranks = placed.select(score, (F.col("_n_total") - F.col("_n_before") - F.col("_n") + 1).alias("rank"))
    return lookup_join(df, ranks, [score], "left").orderBy(F.col(score).desc_nulls_last(), "sample_id")


def classification_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("classification").agg(F.count(F.lit(1)).alias("n_samples"))


def prediction_warnings(df: DataFrame, score: str = "cancer_probability") -> DataFrame:
    """Interpretation notes that apply, as (warning, message) rows."""
    classes = df.select(F.coalesce("classification", F.lit("\0")).alias("c")).distinct()
    facts = df.agg(F.count("label").alias("n_labels")).select(
        "n_labels",
        df.filter(F.col(score).isNotNull()).select(score).distinct().agg(F.count(F.lit(1))).scalar().alias("n_scores"),
        classes.agg(F.count(F.lit(1))).scalar().alias("n_classes"))

    def note(condition, name, message):
        return F.when(condition, F.struct(F.lit(name).alias("warning"), F.lit(message).alias("message")))

    notes = F.array_compact(F.array(
        note(F.col("n_labels") > 0, "evaluation_warning", C.EVALUATION_WARNING),
        note(F.col("n_scores") <= 2, "score_warning", C.SCORE_WARNING),
        note(F.col("n_classes") == 1, "classification_warning", C.CLASSIFICATION_WARNING)))
    return facts.select(F.explode(notes).alias("w")).select("w.warning", "w.message")


def prediction_confusion(df: DataFrame, score: str = "cancer_probability") -> DataFrame:
    """Confusion counts, rates and both areas against the parsed labels, one row."""
    labelled = df.withColumn("y_true", lab.binary_label(F.col("label")))
    counts = metrics.confusion_of_classes(labelled, "y_true", "classification")
    both = metrics.areas(labelled, "y_true", score)
    return counts.select("*", both.select("roc_auc").scalar().alias("roc_auc"),
                         both.select("pr_auc").scalar().alias("pr_auc"))


def partition_metrics(df: DataFrame, score: str, partition: str = "partition") -> DataFrame:
    """n, distinct scores and areas per partition, over rows that have a score."""
    return metrics.areas(df, "y_true", score, [partition])


def misclassifications(df: DataFrame, score: str = "test_probability",
                       classification: str = "test_classification") -> DataFrame:
    """False negatives and false positives, highest score first."""
    elevated = F.col(classification) == C.ELEVATED
    missed = (F.col("y_true") == 1) & ~elevated
    alarmed = (F.col("y_true") == 0) & elevated
    return (
        df.filter(missed | alarmed)
        .select("sample_id", "label",
                F.when(F.col("y_true") == 1, "False negative").otherwise("False positive").alias("error_type"),
                score, classification)
        .orderBy(F.col(score).desc(), "sample_id")
    )


def top_scores(df: DataFrame, k: int = 12, score: str = "cancer_probability") -> DataFrame:
    return df.select("sample_id", "label", score, "classification").orderBy(
        F.col(score).desc_nulls_last(), "sample_id").limit(k)


def sample_report(features: DataFrame, sample_id: str) -> DataFrame:
    """Feature names and values of one sample; the filter reaches the scan."""
    return features.filter(F.col("sample_id") == sample_id).select("feature_name", "value")
