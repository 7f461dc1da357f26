"""Bounded samples of labelled texts, and the calibration of scores."""

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % folds, F.lit(0).cast("long"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int):
    """Texts, labels and languages of at most `rows` labelled documents outside the held-out fold.

    The sample follows a hash of the ids; a classifier's fit is the one thing that may be bounded.
    Null labels and labels other than 0 and 1 are left out; of repeated ids one row counts.
    """
    ids = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
        .groupBy("doc_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.col("lang").cast("string").alias("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang"))
    found = texts.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "text", "lang", "y").toArrow()
    order = np.argsort(found["doc_id"].to_numpy(), kind="stable")
    # Ids give the order of the fit only, spread by a fixed permutation.
    order = np.random.default_rng(7).permutation(order)
    found = found.take(order)
    return found["text"].combine_chunks(), found["y"].to_numpy().astype(np.int64), found["lang"].to_pylist()


def logistic(x, y, ridge: float = 1e-3, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve through scores x, by Newton steps."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        return 0.0, float(np.log(share / (1 - share)))
    scale = float(np.std(x)) or 1.0
    z = np.stack([x / scale, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + ridge * len(y) * np.array([w[0], 0]) * 1e-2
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag([ridge * len(y) * 1e-2 + 1e-9, 1e-9])
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])
