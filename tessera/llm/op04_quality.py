"""Quality classifier: Naive Bayes support vectors.

Indicators of hashed byte 3-grams and of echoed words are scaled by the log ratio of their smoothed
counts in good and bad documents; a linear hinge-loss model on the scaled,
length-normalised rows is fitted by dual coordinate descent.  It is fitted in one
task on a bounded sample (``per_class`` documents of each class); scoring is a
map over all documents with the weight vector (a fixed number of buckets) sent
along.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import columns, id_bucket
from tessera.llm.labelled import labelled_sample

BITS = 18
FIRST_ECHO = 1 << BITS
PER_CLASS = 6000
ECHOES = (0.0, 0.01, 0.03, 0.06, 0.1, 0.2, 0.3, 0.45, 0.6, 0.8)
FEATURES = FIRST_ECHO + len(ECHOES)


def buckets(text: str | None) -> np.ndarray:
    """Distinct feature numbers: hash buckets of the text's byte 3-grams, blanks
    around it, and indicators of the word bigram "x x" (the same word twice),
    one for each share of the bigrams in ECHOES that it passes."""
    text = text or ""
    b = np.frombuffer(b"  " + text.encode() + b"  ", np.uint8).astype(np.uint32)
    code = b[:-2] | b[1:-1] << 8 | b[2:] << 16
    grams = np.unique(code * np.uint32(2654435761) >> np.uint32(32 - BITS)).astype(np.int32)
    words = text.split()
    share = sum(map(eq, words, words[1:])) / max(1, len(words) - 1)
    return np.concatenate((grams, np.arange(FIRST_ECHO, FIRST_ECHO + sum(share > e for e in ECHOES), dtype=np.int32)))


def log_ratio(rows: list[np.ndarray], y: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """log of the classes' smoothed, normalised indicator counts, per bucket."""
    counts = []
    for c in (1, 0):
        own = [r for r, t in zip(rows, y) if t == c]
        n = smooth + np.bincount(np.concatenate(own) if own else np.zeros(0, np.int64), minlength=FEATURES)
        counts.append(np.log(n / n.sum()))
    return counts[0] - counts[1]


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, c: float = 1.0,
                            epochs: int = 10, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights on scaled unit rows and a bias, minimising
    |w|^2 / 2 + c * sum(hinge): each step solves one dual variable exactly."""
    values = []
    for r in rows:
        v = scale[r]
        norm = np.sqrt(v @ v)
        values.append(v / norm if norm else v)
    w, bias = np.zeros(FEATURES), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([v @ v for v in values]) + 1.0  # the bias is a constant feature
    sign = np.where(y == 1, 1.0, -1.0)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            r, v = rows[i], values[i]
            gradient = sign[i] * (w[r] @ v + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), c)
            step = (new - alpha[i]) * sign[i]
            if step:
                alpha[i] = new
                w[r] += step * v
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w * scale, bias


def fit(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """(scale, weights, bias) from (text, y) rows; zeros if a class is missing."""
    def extract(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([buckets(t.as_py()).tobytes() for t in b.column(1)], pa.binary()), b.column(2)],
                names=["doc_id", "f", "y"])

    def train(batches):
        import pyarrow as pa
        got = sorted(r for b in batches for r in zip(*(b.column(i).to_pylist() for i in (0, 1, 2))))
        rows, y = [np.frombuffer(f, np.int32) for _, f, _ in got], np.array([t for _, _, t in got])
        scale, w, bias = np.zeros(FEATURES), np.zeros(FEATURES), 0.0
        if len(set(y.tolist())) == 2:
            scale = log_ratio(rows, y)
            w, bias = dual_coordinate_descent(rows, scale, y)
        yield pa.RecordBatch.from_pylist([{"scale": scale.astype("<f4").tobytes(), "w": w.astype("<f4").tobytes(),
                                           "bias": float(bias)}])

    features = sample.select("doc_id", "text", "y").mapInArrow(extract, "doc_id long, f binary, y int")
    r = features.repartition(1).mapInArrow(train, "scale binary, w binary, bias double").first()
    if r is None:
        return np.zeros(FEATURES, "f4"), np.zeros(FEATURES, "f4"), 0.0
    return np.frombuffer(r.scale, "<f4"), np.frombuffer(r.w, "<f4"), r.bias


def score_text(text: str | None, scale: np.ndarray, w: np.ndarray, bias: float) -> float:
    r = buckets(text)
    norm = float(np.sqrt(np.square(scale[r], dtype=np.float64).sum()))
    margin = (float(w[r].sum(dtype=np.float64)) / norm if norm else 0.0) + bias
    return float(1 / (1 + np.exp(-np.clip(2 * margin, -30, 30))))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
             mod: int = 3, held_out: int = 1, per_class: int = PER_CLASS) -> DataFrame:
    """One row per input row: doc_id, held_out (its id's CRC-32 bucket, never
    trained on), score (0 to 1, higher: label 1 likelier), predicted (score >= 0.5).

    A null text scores as the empty one; a null id belongs to the bucket of ''.
    Repeated rows score alike.  Without labels of both classes every score is
    0.5; an empty table gives no rows.
    """
    scored = score_column(docs, labels, label, doc_id, text, mod, held_out, per_class)
    return (columns(docs, doc_id=doc_id, text=text)
            .select("doc_id", (id_bucket("doc_id", mod) == held_out).alias("held_out"), scored("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def score_column(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id",
                 text: str = "text", mod: int = 3, held_out: int = 1, per_class: int = PER_CLASS):
    """Fit the model and return it as a function of a text column."""
    sample = labelled_sample(docs, labels, label, mod, held_out, per_class, doc_id, text)
    scale, w, bias = fit(sample)
    sc = docs.sparkSession.sparkContext
    model = sc.broadcast((scale, w, bias))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([score_text(t, *model.value) for t in texts], dtype="float64")

    return score
