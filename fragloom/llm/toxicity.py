"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy.

A word is a run of letters, digits and characters beyond ASCII, A-Z as a-z. Its vector is the sum of
three rows of one table: two independent hashes of the word, so that two words rarely share both,
and a hash of its first bytes, so that unseen endings are known by their stem. Filters of several
widths slide over the whole text; the largest response of each filter goes to a logistic unit.
Gradients flow through the places of the largest responses only. The score is calibrated on labelled
texts that took no part in training; thresholds by language are found on the same texts.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .labelled import fold, labelled_sample, logistic
from .words import IS_SIGN, mix, pieces, small_batches, utf8, word_hashes, word_spans

#: Labelled rows that the classifier is trained and calibrated on, at most.
SAMPLE_ROWS = 10_000
TABLE_ROWS = 1 << 18
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 6
STEM_BYTES = 4
#: Passes over the training texts: at least, at most, and the texts seen that are aimed at.
EPOCHS = (6, 60, 20_000)
BATCH_TEXTS = 32


def word_rows(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all words, three each, and each text's bounds in them."""
    starts, ends, of = word_spans(data, bounds, IS_SIGN)
    whole, stem = word_hashes(data, starts, ends), word_hashes(data, starts, ends, STEM_BYTES)
    last = np.uint64(TABLE_ROWS - 1)
    rows = np.stack([whole & last, whole >> np.uint64(40) & last, mix(stem + np.uint64(1)) & last], 1)
    return rows.astype(np.int32), of


class Network:
    """Table, filters by width, and the logistic unit over their largest responses."""

    def __init__(self, seed: int = 1):
        random = np.random.default_rng(seed)
        self.table = random.normal(0, 0.05, (TABLE_ROWS, DIMENSIONS)).astype(np.float32)
        self.filters = [random.normal(0, 0.5, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = random.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.offset = np.zeros(1, np.float32)

    def responses(self, rows: np.ndarray):
        """Responses of all filters at all words; behind a text's last word stand zeros."""
        x = self.table[rows[:, 0]]
        x += self.table[rows[:, 1]]
        x += self.table[rows[:, 2]]
        return x

    def pooled(self, x: np.ndarray, of: np.ndarray, places: bool = False):
        """Largest responses of each text, at least 0, and where they are (-1: nowhere)."""
        n = len(of) - 1
        best = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        where = np.full(best.shape, -1, np.int64) if places else None
        some = np.flatnonzero(of[1:] > of[:-1])
        if not len(some):
            return best, where
        left = np.repeat(of[1:], np.diff(of)) - np.arange(of[0], of[-1])  # words up to the text's end
        for k, (width, filters, bias) in enumerate(zip(WIDTHS, self.filters, self.bias)):
            out = x @ filters[0] + bias
            for j in range(1, width):
                later = x[j:] @ filters[j]
                later[left[:-j] <= j] = 0
                out[:-j] += later
            columns = slice(k * FILTERS, (k + 1) * FILTERS)
            if places:
                for i in some.tolist():
                    part = out[of[i]: of[i + 1]]
                    at = part.argmax(0)
                    value = part[at, np.arange(FILTERS)]
                    best[i, columns] = np.maximum(value, 0)
                    where[i, columns] = np.where(value > 0, of[i] + at, -1)
            else:
                best[some, columns] = np.maximum(np.maximum.reduceat(out, of[some], axis=0), 0)
        return best, where

    def logits(self, rows: np.ndarray, of: np.ndarray) -> np.ndarray:
        return self.pooled(self.responses(rows), of)[0] @ self.out + self.offset[0]

    def train(self, rows: np.ndarray, of: np.ndarray, y: np.ndarray, seed: int = 2, rate: float = 0.05):
        random = np.random.default_rng(seed)
        least, most, aim = EPOCHS
        epochs = min(most, max(least, aim // len(y)))
        sums = {id(a): np.full(a.shape, 1e-6, np.float32) for a in [self.table, *self.filters, *self.bias, self.out, self.offset]}

        def move(array, gradient):
            held = sums[id(array)]
            held += gradient * gradient
            array -= rate * gradient / np.sqrt(held)

        for _ in range(epochs):
            order = random.permutation(len(y))
            for first in range(0, len(order), BATCH_TEXTS):
                texts = order[first: first + BATCH_TEXTS]
                part = np.concatenate([np.arange(of[t], of[t + 1]) for t in texts])
                inner = np.append(0, np.cumsum(of[texts + 1] - of[texts]))
                own = rows[part]
                x = self.responses(own)
                best, where = self.pooled(x, inner, True)
                p = 1 / (1 + np.exp(-np.clip(best @ self.out + self.offset[0], -30, 30)))
                error = ((p - y[texts]) / len(texts)).astype(np.float32)
                back = error[:, None] * self.out[None, :]
                gradient_rows, gradient_values = [], []
                for k, (width, filters, bias) in enumerate(zip(WIDTHS, self.filters, self.bias)):
                    place = where[:, k * FILTERS: (k + 1) * FILTERS]
                    text, unit = np.nonzero(place >= 0)
                    at, g = place[text, unit], back[text, k * FILTERS + unit]
                    change = np.zeros_like(filters)
                    for j in range(width):
                        inside = at + j < inner[text + 1]
                        a, u, v = at[inside] + j, unit[inside], g[inside]
                        np.add.at(change[j].T, u, v[:, None] * x[a])
                        gradient_rows.append(own[a])
                        gradient_values.append(v[:, None] * filters[j].T[u])
                    move(filters, change)
                    move(bias, np.bincount(unit, g, FILTERS).astype(np.float32))
                move(self.out, best.T @ error)
                move(self.offset, np.array([error.sum()], np.float32))
                touched, values = np.concatenate(gradient_rows), np.concatenate(gradient_values)
                names, at = np.unique(touched, return_inverse=True)
                gradient = np.zeros((len(names), DIMENSIONS), np.float32)
                np.add.at(gradient, at.reshape(-1), np.repeat(values, touched.shape[1], axis=0))
                held = sums[id(self.table)]
                held[names] += gradient * gradient
                self.table[names] -= rate * gradient / np.sqrt(held[names])


def logits(network: Network, texts: pa.Array) -> np.ndarray:
    data, bounds = utf8(texts)
    out = [network.logits(*word_rows(data[bounds[a]: bounds[b]], bounds[a: b + 1] - bounds[a])) for a, b in pieces(bounds, 1 << 20)]
    return np.concatenate([*out, np.zeros(0, np.float32)]).astype(float)


def all_word_rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of the words of all texts, made piece by piece."""
    data, bounds = utf8(texts)
    parts = [word_rows(data[bounds[a]: bounds[b]], bounds[a: b + 1] - bounds[a]) for a, b in pieces(bounds, 1 << 20)]
    rows = np.concatenate([np.zeros((0, 3), np.int32), *(r for r, _ in parts)])
    return rows, np.append(0, np.cumsum(np.concatenate([np.zeros(0, np.int64), *(np.diff(of) for _, of in parts)])))


def best_threshold(score: np.ndarray, y: np.ndarray) -> float:
    """The score that divides the labels with the best F1, halfway to the next one below."""
    order = np.argsort(-score, kind="stable")
    s, hit = score[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + y.sum())
    k = int(f1.argmax())
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k])


def fit(texts: pa.Array, y: np.ndarray, langs: list):
    """Network, slope, offset, and thresholds by language (None: all languages)."""
    cut = len(y) * 4 // 5
    network = Network()
    if cut and y[:cut].min() < y[:cut].max():
        network.train(*all_word_rows(texts.slice(0, cut)), y[:cut])
    x = logits(network, texts.slice(cut))
    slope, offset = logistic(x, y[cut:])
    score = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
    thresholds = {None: best_threshold(score, y[cut:]) if y[cut:].any() else 0.5}
    names = np.array([lang or "" for lang in langs[cut:]])
    for lang in sorted(set(names.tolist()) - {""}):
        own = names == lang
        if 5 <= y[cut:][own].sum() < own.sum():
            thresholds[lang] = best_threshold(score[own], y[cut:][own])
    return network, slope, offset, thresholds


def _score(shared):
    def score(batches):
        network, slope, offset = shared.value
        for batch in batches:
            x = logits(network, batch.column(batch.num_columns - 1))
            p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
            yield pa.record_batch([*batch.columns[:-1], pa.array(p)], names=[*batch.schema.names[:-1], "score"])
    return score


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, lang_threshold, flagged for every row of `docs`.

    score is the calibrated probability that a whole text is toxic, from its words alone; null and
    empty texts have no words and get the score of no response. predicted is 1 from `threshold` on;
    flagged tells if the score reaches the threshold found for the row's language. Labels of the
    fold `held_out` are never learned from. Null ids and repeated rows are scored like others.
    """
    small_batches(docs.sparkSession)
    texts, y, langs = labelled_sample(docs, labels, "toxic", folds, held_out, SAMPLE_ROWS)
    network, slope, offset, thresholds = fit(texts, y, langs)
    shared = docs.sparkSession.sparkContext.broadcast((network, slope, offset))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), "text").mapInArrow(
        _score(shared), "doc_id long, lang string, score double")
    limit = F.lit(thresholds[None])
    for name, value in thresholds.items():
        if name is not None:
            limit = F.when(F.col("lang") == name, value).otherwise(limit)
    return rows.select(
        "doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), limit.alias("lang_threshold"),
        (F.col("score") >= limit).alias("flagged"))
