"""Baseline classifiers with selection inside the folds, thresholds and predictions."""

from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame, Window, functions as F

from fragloom import constants as C
from fragloom.functions import labels as lab
from fragloom.operators import cohort, metrics
from fragloom.operators.forest import Forest, fit_forest
from fragloom.operators.matrix import model_vectors
from fragloom.params import DEFAULTS, Params
from fragloom.session import collected, stage
from fragloom.sources import writers

# Order decides between equal scores.
CANDIDATES = ["logistic_l2", "random_forest", "gradient_boosting"]
LOADERS = {
    "logistic_l2": LogisticRegressionModel,
    "random_forest": Forest,
    "gradient_boosting": GBTClassificationModel,
}
SPECIFICITIES = (0.95, 0.98, 0.99)
#: Bytes of vectors that make a task of boosting worth its start, and that it holds at most.
TASK_BYTES, HELD_BYTES = 4 << 20, 64 << 20


@dataclass(frozen=True)
class Learner:
    """Sizes of the tree models."""
    trees: int = 200
    tree_depth: int = 30
    rounds: int = 100
    boosting_depth: int = 3
    step: float = 0.1


@dataclass
class Model:
    name: str
    classifier: object
    index: DataFrame  # idx, feature_name, fill, scale
    threshold: float = 0.5
    info: dict = field(default_factory=dict)


def _classifier(name: str, n: int, seed: int, size: Learner):
    common = {"labelCol": "y", "featuresCol": "features"}
    if name == "logistic_l2":
        # Balanced weights sum to n, so 1/n is the penalty of C = 1.
        return LogisticRegression(maxIter=1000, regParam=1.0 / n, elasticNetParam=0.0,
                                  standardization=False, weightCol="weight", **common)
    return GBTClassifier(maxIter=size.rounds, maxDepth=size.boosting_depth, stepSize=size.step,
                         seed=seed, **common)


def feature_indexes(features: DataFrame, training: DataFrame, folds: int, params: Params = DEFAULTS) -> DataFrame:
    """Selected features of every fit: (fit_fold, idx, feature_name, fill, scale).

    `training` holds (sample_id, y, fold). Medians, F values and the top k of all fits come
    from one pass over the long table, see `cohort.fold_stats`; fit `folds` is the final one.
    The scale is the population sd; trees do not depend on it, so all models share it.
    """
    rows = cohort.join_labels(features, training, "fold")
    stats = cohort.fold_stats(rows, training, folds)
    best = cohort.select_k_best(cohort.anova_f(stats), params.max_features, ["fit_fold"])
    # At most max_features rows per fit are numbered.
    idx = F.row_number().over(Window.partitionBy("fit_fold").orderBy("feature_name")) - 1
    scale = F.when(F.col("sd") > 0, F.col("sd")).otherwise(1.0)
    return best.select("fit_fold", idx.alias("idx"), "feature_name", "fill", scale.alias("scale"))


def fold_vectors(features: DataFrame, indexes: DataFrame, samples: DataFrame) -> DataFrame:
    """Vectors of all samples for all fits, built once for all candidates:
    (fit_fold, features) beside the sample columns."""
    return model_vectors(features, indexes, samples, ["fit_fold"], keep=[c for c in samples.columns if c != "sample_id"])


def training_tasks(cells: int, cores: int) -> int:
    """Tasks that pass over so many cells of vectors again and again: no more than the cores, unless a
    task would hold over 64 MB, and fewer for small tables, whose passes would only start tasks."""
    size = 8 * cells
    return max(1, min(cores, size // TASK_BYTES), -(-size // HELD_BYTES))


def fit(name: str, vectors: DataFrame, params: Params = DEFAULTS, size: Learner = Learner()):
    """One classifier on the rows (y, features)."""
    classes = cohort.class_weights(vectors).select("y", "n_class", "weight").collect()
    n = sum(r["n_class"] for r in classes)
    if name == "random_forest":
        return fit_forest(vectors, {r["y"]: r["weight"] for r in classes}, n, size.trees, size.tree_depth, params.seed)
    first = vectors.select("features").head()
    width = len(first[0]) if first else 0
    weight = F.lit(None).cast("double")
    for r in classes:
        weight = F.when(F.col("y") == r["y"], r["weight"]).otherwise(weight)
    # Boosting makes hundreds of passes: each starts all tasks, so their number follows the bytes, not the files.
    tasks = training_tasks(n * width, vectors.sparkSession.sparkContext.defaultParallelism)
    rows = vectors.filter(F.col("y").isNotNull()).repartition(tasks, "sample_id")
    train = rows.select("y", "features", weight.alias("weight")).persist()
    try:
        return _classifier(name, max(n, 1), params.seed, size).fit(train)
    finally:
        train.unpersist()


def score(classifier, vectors: DataFrame, *columns) -> DataFrame:
    """(sample_id, columns..., probability of class 1)."""
    scored = classifier.transform(vectors)
    return scored.select("sample_id", *columns, vector_to_array("probability")[1].alias("probability"))


def cross_validate(name: str, vectors: DataFrame, folds: int, params: Params = DEFAULTS,
                   size: Learner = Learner()) -> DataFrame:
    """Out-of-fold (sample_id, y, probability) of the training samples in `fold_vectors`;
    without folds the training fit scores itself."""
    if folds == 0:
        own = vectors.filter(F.col("fit_fold") == 0)
        return score(fit(name, own, params, size), own, "y")

    def one(fold):
        of_fit = vectors.filter(F.col("fit_fold") == fold)
        classifier = fit(name, of_fit.filter(F.col("fold") != fold), params, size)
        return score(classifier, of_fit.filter(F.col("fold") == fold), "y")

    # The folds are independent small jobs; driver threads only submit them together.
    with collected(vectors.sparkSession), ThreadPool(folds) as pool:
        return cohort.fold_union(pool.map(inheritable_thread_target(vectors.sparkSession)(one), range(folds)))


def evaluate(scored: DataFrame, scope: str) -> dict:
    """Areas, thresholds and sensitivities of one score table as driver-side facts."""
    area = metrics.areas(scored, "y", "probability").head()
    limits = metrics.thresholds_at_specificity(scored, "y", "probability", SPECIFICITIES)
    found = metrics.sensitivity_at_thresholds(scored, limits, "y", "probability").collect()
    fixed = {str(r["specificity"]): {"threshold": r["threshold"], "sensitivity": r["sensitivity"]} for r in found}
    return {"roc_auc": area["roc_auc"], "pr_auc": area["pr_auc"], "fixed_specificity": fixed,
            "evaluation_scope": scope}


@dataclass
class Training:
    model: Model
    metrics: dict
    metadata: dict
    cv_predictions: DataFrame
    test_predictions: DataFrame


def train(features: DataFrame, labelled: DataFrame, params: Params = DEFAULTS, size: Learner = Learner(),
          candidates=tuple(CANDIDATES)) -> Training:
    """Split, cross-validate the candidates on the training part, refit the best by ROC
    AUC, take its threshold at 95 % specificity and score the held-out part.

    `labelled` holds (sample_id, label). Only one row per candidate and specificity
    reaches the driver.
    """
    with collected(features.sparkSession):
        return _train(features, labelled, params, size, candidates)


def _train(features: DataFrame, labelled: DataFrame, params: Params, size: Learner, candidates) -> Training:
    parsed = cohort.parse_labels(labelled.select("sample_id", "label"))
    cohort.require_two_classes(parsed)
    values = stage(cohort.numeric_values(features), "values")
    split = stage(cohort.stratified_split(parsed, params), "split")
    training = stage(cohort.kfold(split.filter(F.col("partition") == "train"), params), "folds")
    folds = (training.agg(F.max("fold")).head()[0] or -1) + 1
    indexes = stage(feature_indexes(values, training, folds, params), "features")
    if not indexes.head(1):
        raise ValueError("no usable numeric features for training")
    samples = split.join(training.select("sample_id", "fold"), "sample_id", "left")
    vectors = stage(fold_vectors(values, indexes, samples), "vectors", ["fit_fold"])  # a fit reads its own
    train_part = vectors.filter(F.col("partition") == "train")

    scope = "cross_validated_training_partition" if folds else "resubstituted_training_partition"
    blocks, scores, best, best_auc = {}, {}, None, -1.0
    for name in candidates:
        try:
            scored = stage(cross_validate(name, train_part, folds, params, size), f"cv-{name}")
            blocks[name] = evaluate(scored, scope)
        except (ValueError, IllegalArgumentException) as failure:  # cannot be trained: recorded and skipped
            blocks[name] = {"error": str(failure)}
            continue
        scores[name] = scored
        auc = blocks[name]["roc_auc"]
        if auc is not None and auc > best_auc:
            best, best_auc = name, auc
    if best is None:
        raise RuntimeError(f"no model trained successfully: {blocks}")
    final = F.col("fit_fold") == folds
    index = indexes.filter(final).drop("fit_fold")
    threshold = blocks[best]["fixed_specificity"]["0.95"]["threshold"]
    model = Model(best, fit(best, train_part.filter(final), params, size), index, threshold)
    test = vectors.filter(final & (F.col("partition") == "test"))
    tested = stage(test_predictions(model, test), "tested")
    if tested.head(1):
        confusion = metrics.confusion_at_threshold(tested, "y_true", "test_probability", model.threshold).head()
        area = metrics.areas(tested, "y_true", "test_probability").head()
        blocks[best]["heldout_test"] = {
            **({"roc_auc": area["roc_auc"], "pr_auc": area["pr_auc"]} if area["roc_auc"] is not None else {}),
            **confusion.asDict()}
    counts = cohort.class_counts(split).collect()
    metadata = {
        "model_name": best, "model_version": C.MODEL_VERSION,
        "input_feature_count": cohort.usable_features(values).count(),
        "max_features": params.max_features,
        **{key: {str(r["y"]): r[column] for r in counts} for key, column in (
            ("class_counts", "total"), ("train_class_counts", "train"), ("test_class_counts", "test"))},
        "test_size": params.test_size if any(r["test"] for r in counts) else 0, "split_id_column": "sample_id",
        "random_state": params.seed, "split_order": "md5_of_seed_and_sample_id",
        "threshold_95_specificity": model.threshold, "threshold_source": scope,
        "training_scope": "train_partition_only",
    }
    model.info = metadata
    return Training(model, blocks, metadata, cv_predictions(split, scores[best], model), tested)


def cv_predictions(split: DataFrame, scored: DataFrame, model: Model) -> DataFrame:
    """Every sample with its partition; test samples have no cross-validated score."""
    joined = split.join(scored.select("sample_id", F.col("probability").alias("cv_probability")), "sample_id", "left")
    threshold = F.lit(float(model.threshold))
    return joined.select(
        "sample_id", "label", "partition", F.col("y").alias("y_true"), "cv_probability",
        lab.classify(F.col("cv_probability"), threshold).alias("cv_classification"),
        threshold.alias("threshold_used"), F.lit(model.name).alias("model_name"))


def test_predictions(model: Model, test: DataFrame) -> DataFrame:
    """Held-out scores from vectors of test samples; empty when nothing was held out."""
    threshold = F.lit(float(model.threshold))
    scored = score(model.classifier, test, "label", "y")
    return scored.select(
        "sample_id", "label", F.col("y").alias("y_true"), F.col("probability").alias("test_probability"),
        lab.classify(F.col("probability"), threshold).alias("test_classification"),
        threshold.alias("threshold_used"), F.lit(model.name).alias("model_name"))


def predict(model: Model, features: DataFrame, samples: DataFrame) -> DataFrame:
    """Scores and classes of new samples; features the model does not know are ignored."""
    vectors = model_vectors(cohort.numeric_values(features), model.index, samples)
    threshold = F.lit(float(model.threshold))
    return score(model.classifier, vectors).select(
        "sample_id", F.col("probability").alias("cancer_probability"),
        lab.classify(F.col("probability"), threshold).alias("classification"),
        threshold.alias("threshold_used"), F.lit(C.MODEL_VERSION).alias("model_version"),
        F.lit(True).alias("qc_pass"), F.lit("").alias("qc_flags"),
        F.lit("").alias("top_contributing_features"))


def save(model: Model, path: str) -> None:
    """Classifier, feature index and a one-line JSON with name, threshold and metadata."""
    spark = model.index.sparkSession
    if isinstance(model.classifier, Forest):
        model.classifier.save(f"{path}/classifier")
    else:
        model.classifier.write().overwrite().save(f"{path}/classifier")
    model.index.write.mode("overwrite").parquet(f"{path}/features")
    writers.write_json_metadata(
        spark, {"name": model.name, "threshold": model.threshold, "info": model.info}, f"{path}/metadata")


def load(spark, path: str) -> Model:
    facts = writers.read_json_metadata(spark, f"{path}/metadata")
    classifier = LOADERS[facts["name"]].load(f"{path}/classifier")
    return Model(facts["name"], classifier, spark.read.parquet(f"{path}/features"),
                 facts["threshold"], facts["info"])
