"""Metrics of scored samples and tables of the evaluation report."""

from pyspark.sql import functions as F

from fragloom.catalog import views as v
from fragloom.catalog.registry import query, rounded
from fragloom.functions import labels as lab
from fragloom.operators import analysis as an, metrics as me
from fragloom.plans.evaluation import analysis_summary as analysis_document
from fragloom.session import stage_path
from fragloom.sources.writers import write_json_summary

SCORE = "cancer_probability"


@query("WITH " + v.SCORED + """
SELECT specificity, round(q, 9) AS threshold FROM (
  SELECT 0.95::DOUBLE AS specificity, quantile_cont(cancer_probability, 0.95) AS q FROM scored WHERE y_true = 0
  UNION ALL SELECT 0.98, quantile_cont(cancer_probability, 0.98) FROM scored WHERE y_true = 0
  UNION ALL SELECT 0.99, quantile_cont(cancer_probability, 0.99) FROM scored WHERE y_true = 0)""")
def threshold_at_specificity(spark, sf):
    return rounded(me.thresholds_at_specificity(v.scored(spark, sf), "y_true", SCORE), "threshold")


@query("WITH " + v.SCORED + """,
t AS (SELECT "partition", 0.95::DOUBLE AS specificity, quantile_cont(cancer_probability, 0.95) AS threshold
      FROM scored WHERE y_true = 0 GROUP BY 1
      UNION ALL SELECT "partition", 0.98, quantile_cont(cancer_probability, 0.98) FROM scored WHERE y_true = 0 GROUP BY 1
      UNION ALL SELECT "partition", 0.99, quantile_cont(cancer_probability, 0.99) FROM scored WHERE y_true = 0 GROUP BY 1)
SELECT "partition", specificity, round(threshold, 9) AS threshold,
       round(avg(CAST(cancer_probability >= threshold AS INT)) FILTER (y_true = 1), 9) AS sensitivity
FROM scored JOIN t USING ("partition") GROUP BY "partition", specificity, threshold""")
def sensitivity_at_specificity(spark, sf):
    df = v.scored(spark, sf)
    limits = me.thresholds_at_specificity(df, "y_true", SCORE, groups=["partition"])
    found = me.sensitivity_at_thresholds(df, limits, "y_true", SCORE, ["partition"])
    return rounded(found, "threshold", "sensitivity")


AREA_SQL = v.SCORED + """,
lv AS (SELECT "partition", cancer_probability AS s, sum(y_true) AS pos, count(*) - sum(y_true) AS neg FROM scored GROUP BY ALL),
cu AS (SELECT *, sum(pos) OVER (PARTITION BY "partition") AS p, sum(neg) OVER (PARTITION BY "partition") AS n,
       sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM lv WINDOW w AS (PARTITION BY "partition" ORDER BY s DESC)),
areas AS (SELECT "partition", CAST(sum(pos + neg) AS BIGINT) AS n_samples, count(*) AS unique_score_count,
  round(sum(CAST(neg AS DOUBLE) * (tp - pos / 2)) / any_value(CAST(p AS DOUBLE) * n), 9) AS roc_auc,
  round(sum(pos / p * (tp / (tp + fp))), 9) AS pr_auc FROM cu GROUP BY 1)"""
WHOLE_SQL = v.SCORED + """,
lv AS (SELECT cancer_probability AS s, sum(y_true) AS pos, count(*) - sum(y_true) AS neg FROM scored GROUP BY ALL),
cu AS (SELECT *, sum(pos) OVER () AS p, sum(neg) OVER () AS n, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp
       FROM lv WINDOW w AS (ORDER BY s DESC)),
areas AS (SELECT round(sum(CAST(neg AS DOUBLE) * (tp - pos / 2)) / any_value(CAST(p AS DOUBLE) * n), 9) AS roc_auc,
  round(sum(pos / p * (tp / (tp + fp))), 9) AS pr_auc FROM cu)"""


@query("WITH " + WHOLE_SQL + " SELECT roc_auc FROM areas")
def roc_auc(spark, sf):
    return rounded(me.roc_auc(v.scored(spark, sf), "y_true", SCORE), "roc_auc")


@query("WITH " + WHOLE_SQL + " SELECT pr_auc FROM areas")
def average_precision(spark, sf):
    return rounded(me.average_precision(v.scored(spark, sf), "y_true", SCORE), "pr_auc")


@query("WITH " + AREA_SQL + " SELECT * FROM areas")
def partition_metrics(spark, sf):
    return rounded(an.partition_metrics(v.scored(spark, sf), SCORE), "roc_auc", "pr_auc")


def _rates(tp, tn, fp, fn):
    return f"""{tp} AS tp, {tn} AS tn, {fp} AS fp, {fn} AS fn,
  {tp} / greatest({tp} + {fn}, 1) AS sensitivity, {tn} / greatest({tn} + {fp}, 1) AS specificity"""


CONFUSION = _rates(*[f"count(*) FILTER (y_true = {y} AND {sign} cancer_probability > 0.7)"
                     for y, sign in ((1, ""), (0, "NOT"), (0, ""), (1, "NOT"))])


@query("WITH " + v.SCORED + f' SELECT "partition", {CONFUSION} FROM scored GROUP BY "partition"')
def confusion_at_threshold(spark, sf):
    return me.confusion_at_threshold(v.scored(spark, sf), "y_true", SCORE, 0.7, ["partition"])


@query("WITH " + AREA_SQL + """
SELECT "partition", fp / greatest(n, 1) AS fpr, tp / greatest(p, 1) AS tpr, s AS threshold FROM cu
UNION ALL SELECT DISTINCT "partition", 0.0, 0.0, 'Infinity'::DOUBLE FROM cu""")
def roc_curve(spark, sf):
    return me.roc_curve(v.scored(spark, sf), "y_true", SCORE, ["partition"])


@query("WITH " + AREA_SQL + """
SELECT "partition", tp / greatest(p, 1) AS recall, tp / greatest(tp + fp, 1) AS precision, s AS threshold FROM cu
UNION ALL SELECT DISTINCT "partition", 0.0, 1.0, NULL::DOUBLE FROM cu""")
def pr_curve(spark, sf):
    return me.pr_curve(v.scored(spark, sf), "y_true", SCORE, ["partition"])


# --- report tables ---------------------------------------------------------------------

PRED_SQL = v.SCORED + """,
pred AS (SELECT sample_id, cancer_probability, CASE WHEN cancer_probability > 0.7 THEN 'elevated_fragmentome_score'
           WHEN cancer_probability <= 0.7 THEN 'lower_fragmentome_score' END AS classification
         FROM (SELECT sample_id, CASE WHEN sample_id LIKE '%9' THEN NULL ELSE cancer_probability END AS cancer_probability FROM scored)),
meta AS (SELECT sample_id, label, "partition" AS batch FROM scored WHERE label IS NOT NULL),
j AS (SELECT p.sample_id, m.label, m.batch, p.cancer_probability, p.classification FROM pred p LEFT JOIN meta m USING (sample_id))"""


def predictions(spark, sf):
    score = F.when(~F.col("sample_id").endswith("9"), F.col(SCORE))
    df = v.scored(spark, sf).select("sample_id", score.alias(SCORE))
    return df.withColumn("classification", lab.classify(F.col(SCORE), F.lit(0.7)))


def metadata(spark, sf):
    return v.scored(spark, sf).filter(F.col("label").isNotNull()).select(
        "sample_id", "label", F.col("partition").alias("batch"))


def joined(spark, sf):
    return an.predictions_with_labels(metadata(spark, sf), predictions(spark, sf))


@query("WITH " + PRED_SQL + " SELECT * FROM j")
def predictions_with_labels(spark, sf):
    return joined(spark, sf)


@query("WITH " + PRED_SQL + """
SELECT *, CASE WHEN cancer_probability IS NOT NULL THEN rank() OVER (ORDER BY cancer_probability DESC NULLS LAST) END AS rank FROM j""")
def ranked_predictions(spark, sf):
    return an.ranked_predictions(joined(spark, sf))


@query("WITH " + PRED_SQL + """
SELECT count(*) AS n_samples, count(cancer_probability) AS n_predictions, min(cancer_probability) AS score_min,
  round(median(cancer_probability), 9) AS score_median, max(cancer_probability) AS score_max,
  count(DISTINCT cancer_probability) AS unique_score_count FROM pred""")
def score_summary(spark, sf):
    return rounded(me.score_summary(predictions(spark, sf), SCORE), "score_median")


@query("WITH " + PRED_SQL + " SELECT classification, count(*) AS n_samples FROM pred GROUP BY 1")
def classification_counts(spark, sf):
    return an.classification_counts(predictions(spark, sf))


WARN_SQL = PRED_SQL + """,
one AS (SELECT sample_id, label, 0.5 AS cancer_probability, 'lower_fragmentome_score' AS classification FROM j),
facts AS (SELECT count(label) AS n_labels, count(DISTINCT cancer_probability) AS n_scores,
                 count(DISTINCT classification) AS n_classes FROM one)"""


def _notes():
    from fragloom import constants as C
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    return f"""
SELECT 'evaluation_warning' AS warning, {quote(C.EVALUATION_WARNING)} AS message FROM facts WHERE n_labels > 0
UNION ALL SELECT 'score_warning', {quote(C.SCORE_WARNING)} FROM facts WHERE n_scores <= 2
UNION ALL SELECT 'classification_warning', {quote(C.CLASSIFICATION_WARNING)} FROM facts WHERE n_classes = 1"""


@query("WITH " + WARN_SQL + _notes())
def prediction_warnings(spark, sf):
    """Every score and class equal: all three notes apply."""
    same = joined(spark, sf).withColumn(SCORE, F.lit(0.5)).withColumn(
        "classification", F.lit("lower_fragmentome_score"))
    return an.prediction_warnings(same)


LABEL_SQL = PRED_SQL + """,
l AS (SELECT *, CASE WHEN lower(trim(coalesce(label, ''))) IN ('control', 'healthy', '') THEN 0 ELSE 1 END AS y_true,
             coalesce(classification = 'elevated_fragmentome_score', false) AS called FROM j),
lv AS (SELECT cancer_probability AS s, sum(y_true) AS pos, count(*) - sum(y_true) AS neg
       FROM l WHERE cancer_probability IS NOT NULL GROUP BY 1),
cu AS (SELECT *, sum(pos) OVER () AS p, sum(neg) OVER () AS n, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp
       FROM lv WINDOW w AS (ORDER BY s DESC))"""


@query("WITH " + LABEL_SQL + " SELECT " + _rates(*[
    f"count(*) FILTER (y_true = {y} AND {sign} called)" for y, sign in ((1, ""), (0, "NOT"), (0, ""), (1, "NOT"))]) + """,
  (SELECT round(sum(CAST(neg AS DOUBLE) * (tp - pos / 2)) / any_value(CAST(p AS DOUBLE) * n), 9) FROM cu) AS roc_auc,
  (SELECT round(sum(pos / p * (tp / (tp + fp))), 9) FROM cu) AS pr_auc FROM l""")
def prediction_confusion(spark, sf):
    return rounded(an.prediction_confusion(joined(spark, sf)), "roc_auc", "pr_auc")


@query("WITH " + PRED_SQL + """
SELECT label, count(cancer_probability) AS "count", round(avg(cancer_probability), 9) AS mean,
  round(stddev_samp(cancer_probability), 9) AS std, min(cancer_probability) AS min,
  round(quantile_cont(cancer_probability, 0.25), 9) AS q25, round(quantile_cont(cancer_probability, 0.5), 9) AS q50,
  round(quantile_cont(cancer_probability, 0.75), 9) AS q75, max(cancer_probability) AS max FROM j GROUP BY label""")
def score_summary_by_label(spark, sf):
    return rounded(me.describe_scores(joined(spark, sf), SCORE, "label"), "mean", "std", "q25", "q50", "q75")


@query("WITH " + PRED_SQL + """,
s AS (SELECT label, min(cancer_probability) AS lo, max(cancer_probability) AS hi FROM j
      WHERE cancer_probability IS NOT NULL GROUP BY label),
b AS (SELECT j.label, lo, (hi - lo) / CAST(20 AS DOUBLE) AS width,
        CAST(least(floor((cancer_probability - lo) / ((hi - lo) / CAST(20 AS DOUBLE))), 19) AS INT) AS bin
      FROM j JOIN s ON j.label IS NOT DISTINCT FROM s.label WHERE cancer_probability IS NOT NULL)
SELECT label, bin, round(lo + bin * width, 9) AS bin_start, round(lo + (bin + 1) * width, 9) AS bin_end, count(*) AS n_samples
FROM b GROUP BY ALL""")
def score_histogram(spark, sf):
    return rounded(me.score_histogram(joined(spark, sf), SCORE, "label"), "bin_start", "bin_end")


@query("WITH " + PRED_SQL + """,
k AS (SELECT label, quantile_cont(cancer_probability, 0.25) AS q1, quantile_cont(cancer_probability, 0.5) AS med,
             quantile_cont(cancer_probability, 0.75) AS q3 FROM j WHERE label IS NOT NULL GROUP BY 1),
x AS (SELECT j.label, cancer_probability AS v, q1, med, q3,
        cancer_probability BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside
      FROM j JOIN k USING (label) WHERE cancer_probability IS NOT NULL)
SELECT label, round(q1, 9) AS q1, round(med, 9) AS median, round(q3, 9) AS q3,
  least(min(v) FILTER (inside), q1) AS whisker_low, greatest(max(v) FILTER (inside), q3) AS whisker_high,
  count(*) FILTER (NOT inside) AS n_outliers FROM x GROUP BY label, q1, med, q3""")
def score_boxplot(spark, sf):
    return rounded(me.score_boxplot(joined(spark, sf), SCORE, "label"), "q1", "median", "q3")


@query("WITH " + v.SCORED + """,
t AS (SELECT sample_id, label, y_true, cancer_probability AS test_probability,
        CASE WHEN cancer_probability > 0.7 THEN 'elevated_fragmentome_score' ELSE 'lower_fragmentome_score' END AS test_classification
      FROM scored WHERE "partition" = 'test')
SELECT sample_id, label, CASE WHEN y_true = 1 THEN 'False negative' ELSE 'False positive' END AS error_type,
  test_probability, test_classification FROM t
WHERE (y_true = 1) <> (test_classification = 'elevated_fragmentome_score')""")
def misclassifications(spark, sf):
    test = v.scored(spark, sf).filter(F.col("partition") == "test").withColumnRenamed(SCORE, "test_probability")
    return an.misclassifications(test.withColumn(
        "test_classification", lab.classify(F.col("test_probability"), F.lit(0.7))))


@query("WITH " + PRED_SQL + """
SELECT sample_id, label, cancer_probability, classification FROM j
ORDER BY cancer_probability DESC NULLS LAST, sample_id LIMIT 12""")
def top_scores(spark, sf):
    return an.top_scores(joined(spark, sf))


def _fact(key, value):
    return f"SELECT '{key}' AS key, CAST(({value}) AS DOUBLE) AS value"


SUMMARY_SQL = "WITH " + LABEL_SQL + """,
either AS (SELECT 'cross_validated_predictions' AS block, cancer_probability AS s, y_true FROM scored WHERE "partition" = 'train'
  UNION ALL SELECT 'heldout_test_predictions', cancer_probability, y_true FROM scored WHERE "partition" = 'test'),
levels AS (SELECT block, s, sum(y_true) AS pos, count(*) - sum(y_true) AS neg FROM either GROUP BY ALL),
sums AS (SELECT *, sum(pos) OVER (PARTITION BY block) AS p, sum(neg) OVER (PARTITION BY block) AS n,
  sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM levels WINDOW w AS (PARTITION BY block ORDER BY s DESC)),
blocks AS (SELECT block, sum(pos + neg) AS n_samples, count(*) AS unique_score_count,
  round(sum(CAST(neg AS DOUBLE) * (tp - pos / 2)) / any_value(CAST(p AS DOUBLE) * n), 9) AS roc_auc,
  round(sum(pos / p * (tp / (tp + fp))), 9) AS pr_auc FROM sums GROUP BY block)
""" + " UNION ALL ".join([
    _fact("n_samples", "SELECT count(*) FROM j"), _fact("n_predictions", "SELECT count(cancer_probability) FROM pred"),
    _fact("score_min", "SELECT min(cancer_probability) FROM pred"), _fact("score_max", "SELECT max(cancer_probability) FROM pred"),
    _fact("score_median", "SELECT round(median(cancer_probability), 9) FROM pred"),
    _fact("unique_score_count", "SELECT count(DISTINCT cancer_probability) FROM pred"),
    "SELECT 'classification_counts.' || coalesce(classification, 'null'), CAST(count(*) AS DOUBLE) FROM pred GROUP BY classification",
    "SELECT 'class_counts.' || y_true, CAST(count(*) AS DOUBLE) FROM l GROUP BY y_true",
    *[_fact(f"confusion_matrix.{name}", f"SELECT count(*) FROM l WHERE y_true = {y} AND {sign} called")
      for name, y, sign in (("tp", 1, ""), ("tn", 0, "NOT"), ("fp", 0, ""), ("fn", 1, "NOT"))],
    _fact("sensitivity", "SELECT round(count(*) FILTER (called) / greatest(count(*), 1), 9) FROM l WHERE y_true = 1"),
    _fact("specificity", "SELECT round(count(*) FILTER (NOT called) / greatest(count(*), 1), 9) FROM l WHERE y_true = 0"),
    _fact("roc_auc", "SELECT round(sum(CAST(neg AS DOUBLE) * (tp - pos / 2)) / any_value(CAST(p AS DOUBLE) * n), 9) FROM cu"),
    _fact("pr_auc", "SELECT round(sum(pos / p * (tp / (tp + fp))), 9) FROM cu"),
    *[f"SELECT block || '.{c}', CAST({c} AS DOUBLE) FROM blocks" for c in ("n_samples", "unique_score_count", "roc_auc", "pr_auc")],
    _fact("model_metadata.max_features", "5000"), _fact("evaluation_warning", "1")])


@query(SUMMARY_SQL)
def analysis_summary(spark, sf):
    """The document as written, read back and taken apart into its numbers (a note counts 1)."""
    scored = v.scored(spark, sf)
    cv, test = (scored.filter(F.col("partition") == part).withColumnRenamed(SCORE, column)
                for part, column in (("train", "cv_probability"), ("test", "test_probability")))
    document = analysis_document(metadata(spark, sf), predictions(spark, sf), cv, test, model_metadata={"max_features": 5000})
    path = stage_path(spark, "summary")
    write_json_summary(document, path)
    numbers = ["n_samples", "n_predictions", "score_min", "score_median", "score_max", "unique_score_count",
               "sensitivity", "specificity", "roc_auc", "pr_auc"]
    notes = ["evaluation_warning", "score_warning", "classification_warning"]
    schema = ", ".join([
        *[f"{c} double" for c in numbers], *[f"{c} string" for c in notes],
        *[f"{c} map<string, double>" for c in ("classification_counts", "class_counts", "confusion_matrix",
                                               "cross_validated_predictions", "heldout_test_predictions", "model_metadata")]])

    def prefixed(name):
        return F.transform_keys(name, lambda k, _: F.concat(F.lit(f"{name}."), k))

    read = spark.read.text(path).select(F.from_json("value", schema).alias("d")).select("d.*")
    parts = [F.create_map(F.lit(c), F.col(c)) for c in numbers]
    parts += [F.create_map(F.lit(c), F.when(F.col(c).isNotNull(), 1.0)) for c in notes]
    parts += [prefixed(c) for c, kind in read.dtypes if kind.startswith("map")]
    facts = read.select(F.explode(F.map_concat(*parts)).alias("key", "value")).filter(F.col("value").isNotNull())
    return rounded(facts, "value")
