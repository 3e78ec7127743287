"""Quality classifier: naive Bayes support vectors.

Features are n-gram indicators: words, word pairs, and triples of word classes
(capitals, repeats of the word before, marks, ...), hashed to a fixed width.
Each indicator is scaled by its log-count ratio between the two classes, rows are
brought to unit length, and a linear hinge-loss model is fitted by dual
coordinate descent.  Margins of rows kept back from the fit give the logistic
scale of the score.

The fit uses a sample of labelled rows bounded by ``max_train`` (those with the
smallest hash of their id), of which only feature numbers reach the driver.
Scoring reads whole texts.  Null and empty texts have no features and get the
score of a zero margin's bias.  Rows with a null id are scored and not held out;
labels that are null or of unknown documents are not used; several labels of one
document count as their smallest.  Without labels of both classes all rows get
the share of label 1 among the labels, or 1 without labels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwise.llm.common import add_columns, hashed_fold, table, utf8
from tripwise.llm.words import Splitter, distinct, fold_table, shingles

FOLDS = 5
THRESHOLD = 0.3
#: labelled rows that the fit may use, the bound of what reaches the driver
MAX_TRAIN = 4000
#: feature numbers
WIDTH = 1 << 18
ROUNDS = 10

# word classes: lower case, capitalised, capitals, digits, marks, one mark; + 8 for a repeat of the word before
_LOWER, _TITLE, _UPPER, _DIGITS, _MARK, _MARKS = range(6)
_CLASSES = 16
# the feature numbers: words, word pairs, triples of classes
_TRIPLES = _CLASSES ** 3
_WORDS = WIDTH // 2
_PAIRS = WIDTH - _WORDS - _TRIPLES


def _kinds() -> np.ndarray:
    """0 for white space, 1 for letters, digits and bytes of non-ASCII characters, 2 for marks."""
    kind = np.full(256, 2, np.uint8)
    kind[[9, 10, 11, 12, 13, 32]] = 0
    kind[48:58] = kind[65:91] = kind[97:123] = kind[128:] = 1
    return kind


class Features:
    """Feature numbers of texts."""

    def __init__(self):
        kind = _kinds()
        self.split = Splitter(kind, fold_table())
        self.first = np.full(256, _LOWER, np.int32)  # the class that a word's first byte suggests
        self.first[kind == 2] = _MARK
        self.first[48:58] = _DIGITS
        self.first[65:91] = _TITLE

    def __call__(self, text: bytes | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        word, begin, end = self.split(text)
        if not len(word):
            return np.empty(0, np.int32)
        data = np.frombuffer(text, np.uint8)
        size = end - begin
        kind = self.first[data[begin]]
        kind[(kind == _MARK) & (size > 1)] = _MARKS
        capitals = np.zeros(len(data) + 1, np.int32)
        np.cumsum((data >= 65) & (data <= 90), out=capitals[1:])
        kind[(capitals[end] - capitals[begin] == size) & (size > 1)] = _UPPER
        kind[1:] += 8 * (word[1:] == word[:-1])
        pair = shingles(word, 2) if len(word) > 1 else word[:0]
        triple = (kind[:-2] * _CLASSES + kind[1:-1]) * _CLASSES + kind[2:]
        return distinct(np.concatenate(((word % np.uint64(_WORDS)).astype(np.int32),
                                         (pair % np.uint64(_PAIRS)).astype(np.int32) + _WORDS,
                                         triple + (_WORDS + _PAIRS))))


class NaiveBayesSvm:
    """Weights of the scaled indicators, and the logistic scale of the margin."""

    def __init__(self, ratio: np.ndarray, weight: np.ndarray, bias: float, scale: tuple[float, float]):
        self.ratio, self.scale, self.bias = ratio, scale, bias
        self.gain, self.square = (ratio * weight).astype(np.float64), (ratio * ratio).astype(np.float64)

    def margin(self, features: np.ndarray) -> float:
        norm = self.square[features].sum() if len(features) else 0.0
        return self.bias + (self.gain[features].sum() / norm ** 0.5 if norm > 0 else 0.0)

    def score(self, features: np.ndarray) -> float:
        a, b = self.scale
        return float(1 / (1 + np.exp(-np.clip(a * self.margin(features) + b, -500, 500))))


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    counts = [np.full(WIDTH, smoothing), np.full(WIDTH, smoothing)]
    for features, label in zip(rows, labels):
        counts[label][features] += 1
    one, zero = counts[1] / (labels.sum() + 2 * smoothing), counts[0] / ((1 - labels).sum() + 2 * smoothing)
    return np.log(one / zero)


def dual_coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float = 1.0,
                            rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|^2/2 + sum of C_i * hinge(y_i (w x_i + b)); classes weigh alike."""
    values = [ratio[f] / max(1e-12, float(np.sqrt((ratio[f] ** 2).sum()))) if len(f) else ratio[f] for f in rows]
    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum())) * len(labels)
    limit, alpha = cost * share, np.zeros(len(rows))
    weight, bias = np.zeros(WIDTH), 0.0
    square = np.array([v @ v + 1.0 for v in values])  # the bias is a feature of value 1
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            f, v, y = rows[i], values[i], signs[i]
            gradient = y * (weight[f] @ v + bias) - 1
            step = min(max(alpha[i] - gradient / square[i], 0.0), limit[i]) - alpha[i]
            if step:
                alpha[i] += step
                weight[f] += step * y * v
                bias += step * y
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weight, bias


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the log odds by Newton's method, with softened targets."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - target) * margins).sum() + 1e-3 * a, (p - target).sum()])
        h = np.array([[(w * margins * margins).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        da, db = np.linalg.solve(h, g)
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-8:
            break
    return max(a, 1e-3), b


def fit(rows: list[np.ndarray], labels: np.ndarray, smoothing: float = 1.0) -> NaiveBayesSvm:
    """The model of all rows; its logistic scale comes from a third that another fit leaves out."""
    if not len(labels) or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 1.0
        odds = np.log((share + 1e-6) / (1 - share + 1e-6))
        return NaiveBayesSvm(np.zeros(WIDTH), np.zeros(WIDTH), 0.0, (1.0, float(odds)))
    kept_back = np.arange(len(labels)) % 3 == 0
    inside, outside = np.flatnonzero(~kept_back), np.flatnonzero(kept_back)
    scale = (4.0, 0.0)  # where the rows kept back lack a class
    if len(set(labels[inside].tolist())) == len(set(labels[outside].tolist())) == 2:
        own = [rows[i] for i in inside]
        ratio = log_count_ratio(own, labels[inside], smoothing)
        model = NaiveBayesSvm(ratio, *dual_coordinate_descent(own, labels[inside], ratio), (1.0, 0.0))
        scale = _logistic(np.array([model.margin(rows[i]) for i in outside]), labels[outside])
    ratio = log_count_ratio(rows, labels, smoothing)
    return NaiveBayesSvm(ratio, *dual_coordinate_descent(rows, labels, ratio), scale)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          max_train: int = MAX_TRAIN) -> NaiveBayesSvm:
    """Fit on the labelled documents outside the held-out fold."""
    marked = (labels.where(F.col(label).isin(0, 1) & (hashed_fold(doc_id, FOLDS) != 0))
              .groupBy(F.col(doc_id).alias("tw_id")).agg(F.min(label).cast("int").alias("tw_label"))
              .orderBy(F.xxhash64("tw_id"), "tw_id").limit(max_train))
    chosen = (docs.select(F.col(doc_id).alias("tw_id"), F.col(text).alias("tw_text")).join(marked, "tw_id")
              .select("tw_id", "tw_label", "tw_text"))

    def make():
        features = Features()
        return lambda batch: [pa.array([features(v).astype(np.int32).tobytes() for v in utf8(batch.column("tw_text"))], pa.binary())]

    # a labelled id counts once, however many rows have it, so at most max_train rows are collected
    found = (add_columns(chosen, [T.StructField("tw_features", T.BinaryType())], make, drop=("tw_text",))
             .groupBy("tw_id").agg(F.first("tw_label").alias("tw_label"), F.min("tw_features").alias("tw_features"))
             .orderBy(F.crc32(F.col("tw_id").cast("string").cast("binary")), "tw_id").collect())
    return fit([np.frombuffer(r.tw_features, np.int32) for r in found], np.array([r.tw_label for r in found], dtype=np.int64))


def score(docs: DataFrame, model: NaiveBayesSvm, text: str = "text", with_text: bool = True, name: str = "qc_score") -> DataFrame:
    """Every row with its score, from the whole text alone, in a new column ``name``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        features, fitted = Features(), shared.value
        return lambda batch: [pa.array([fitted.score(features(v)) for v in utf8(batch.column(text))], pa.float64())]

    return add_columns(docs, [T.StructField(name, T.DoubleType())], make, drop=() if with_text else (text,))


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """Per document: whether it is held out, its score and the class at the threshold."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return score(docs, model, with_text=False).select(
        "doc_id", F.coalesce(hashed_fold("doc_id", FOLDS) == 0, F.lit(False)).alias("held_out"),
        F.col("qc_score").alias("score"), (F.col("qc_score") >= THRESHOLD).cast("int").alias("predicted"))
