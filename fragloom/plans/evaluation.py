"""Evaluation report of a prediction file: its tables, and the summary document."""

import json

from pyspark.sql import DataFrame, functions as F

from fragloom.functions import labels as lab
from fragloom.operators import analysis, metrics
from fragloom.sources import writers


def report_tables(metadata: DataFrame, predictions: DataFrame, cv: DataFrame | None = None,
                  test: DataFrame | None = None, score: str = "cancer_probability") -> dict[str, DataFrame]:
    """Every table of the report by name; without labels only those that need none."""
    labelled = "label" in metadata.columns or "label" in predictions.columns
    if not labelled:
        metadata = metadata.withColumn("label", F.lit(None).cast("string"))
    joined = analysis.predictions_with_labels(metadata, predictions)
    truth = joined.withColumn("y_true", lab.binary_label(F.col("label")))
    tables = {
        "predictions_with_labels": joined,
        "ranked_predictions": analysis.ranked_predictions(joined, score),
        "score_summary": metrics.score_summary(predictions, score),
        "classification_counts": analysis.classification_counts(predictions),
        "warnings": analysis.prediction_warnings(joined, score),
        "confusion": analysis.prediction_confusion(joined, score),
        "score_summary_by_label": metrics.describe_scores(joined, score, "label"),
        "score_histogram": metrics.score_histogram(joined, score, "label"),
        "score_boxplot": metrics.score_boxplot(joined, score, "label"),
        "roc_curve": metrics.roc_curve(truth, "y_true", score),
        "pr_curve": metrics.pr_curve(truth, "y_true", score),
        "top_scores": analysis.top_scores(joined, 12, score),
    }
    if not labelled:
        for name in ("confusion", "score_summary_by_label", "roc_curve", "pr_curve"):
            del tables[name]
    for name, df, column in (("cv", cv, "cv_probability"), ("test", test, "test_probability")):
        if df is None:
            continue
        scored = df.filter(F.col(column).isNotNull())
        tables[f"{name}_metrics"] = metrics.areas(scored, "y_true", column)
        tables[f"{name}_roc_curve"] = metrics.roc_curve(scored, "y_true", column)
        tables[f"{name}_pr_curve"] = metrics.pr_curve(scored, "y_true", column)
    if test is not None:
        tables["test_histogram"] = metrics.score_histogram(test, "test_probability", "label", 10)
        tables["misclassifications"] = analysis.misclassifications(test)
    return tables


def analysis_summary(metadata: DataFrame, predictions: DataFrame, cv: DataFrame | None = None, test: DataFrame | None = None,
                     model_metrics: dict | None = None, model_metadata: dict | None = None,
                     score: str = "cancer_probability") -> DataFrame:
    """The summary document of an evaluation as one row, for `writers.write_json_summary`.

    Counts, score range, class counts and the notes that apply; where a sample has a label also
    confusion counts, rates and, with both classes, the areas. `cv` and `test` add a block each where
    both classes have scores. The facts of a model are taken over as they are. Fields that do not
    apply are NULL and so do not appear in the JSON text.
    """
    if "label" not in metadata.columns:
        metadata = metadata.withColumn("label", F.lit(None).cast("string"))
    joined = analysis.predictions_with_labels(metadata, predictions)
    truth = joined.withColumn("y_true", lab.binary_label(F.col("label")))
    labelled = joined.agg(F.count("label") > 0).scalar()

    def counted(df, key, value="n"):
        entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct(
            F.coalesce(F.col(key).cast("string"), F.lit("null")), F.col(value)))))
        return df.agg(entries).scalar()

    def one(df, *columns):
        return df.select(F.struct(*columns or df.columns)).scalar()

    notes = analysis.prediction_warnings(joined, score)
    confusion = one(analysis.prediction_confusion(joined, score))
    fields = {
        "classification_counts": counted(analysis.classification_counts(predictions), "classification", "n_samples"),
        **{name: notes.filter(F.col("warning") == name).agg(F.max("message")).scalar()
           for name in ("evaluation_warning", "score_warning", "classification_warning")},
        "class_counts": F.when(labelled, counted(truth.groupBy("y_true").agg(F.count(F.lit(1)).alias("n")), "y_true")),
        "confusion_matrix": F.when(labelled, F.struct(*[confusion.getField(c).alias(c) for c in ("tp", "tn", "fp", "fn")])),
        **{c: F.when(labelled, confusion.getField(c)) for c in ("sensitivity", "specificity", "roc_auc", "pr_auc")},
    }
    for name, df, column in (("cross_validated_predictions", cv, "cv_probability"),
                             ("heldout_test_predictions", test, "test_probability")):
        if df is not None:
            block = one(metrics.areas(df.filter(F.col(column).isNotNull()), "y_true", column))
            fields[name] = F.when(block.getField("roc_auc").isNotNull(), block)
    for name, facts in (("model_metrics", model_metrics), ("model_metadata", model_metadata)):
        if facts is not None:
            fields[name] = F.parse_json(F.lit(json.dumps(facts)))
    summary = metrics.score_summary(predictions, score).withColumn(
        "n_samples", joined.agg(F.count(F.lit(1))).scalar())
    return summary.withColumns(fields)


def report_files(tables: dict[str, DataFrame], summary: DataFrame, folder: str) -> None:
    """Every table as tab-separated text and the summary as JSON, each under its name in `folder`."""
    for name, table in tables.items():
        writers.write_tsv(table, f"{folder}/{name}")
    writers.write_json_summary(summary, f"{folder}/prediction_analysis_summary")
