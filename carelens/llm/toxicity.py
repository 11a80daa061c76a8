"""Operator 3: a character n-gram linear classifier whose features are scaled by naive Bayes log-count ratios.

Features are the distinct byte n-grams (n of ORDERS) of the lower-cased UTF-8 text with a blank at either end, hashed to
2**BITS places. From a sample of labelled documents (at most `per_class` of either class and `sample_chars` characters
in all; both are parameters) the log ratio of each feature's smoothed frequency in the classes is taken, and a logistic
regression is fitted to the features times their ratios. The sample has other class shares than the labels where it is
bounded, so the intercept is moved by the log odds of all labels less those of the fitted rows. The product of ratio and weight is one number per place, 4 MB
in all whatever the input, so scoring is one pass over the documents without a shuffle.

Null and empty texts have the score of the intercept and the blank's features. Without labels of both classes every
score is the share of label 1 among the labels (0.5 without any). Repeated rows get equal scores; an empty table gives
no rows; further columns are ignored whatever their names. Texts of any length are scored whole; one that doesn't fit into
what is left of `sample_chars` is not fitted on.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import blank_null, pieces, text_bytes
from carelens.llm.labelled import bounded_rows, class_counts, labelled_sample, sigmoid

ORDERS, BITS = (3, 4, 5), 20
#: A to Z to a to z, and other white space to a blank.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER[9:14] = 32


def places(text: np.ndarray) -> np.ndarray:
    """The hashed place of every n-gram of a text's bytes, repeats included."""
    data = np.empty(len(text) + 2, np.uint64)
    data[0] = data[-1] = 32
    data[1:-1] = LOWER[text]
    out, code = [], data
    for n in range(2, max(ORDERS) + 1):
        if len(code) < 2:
            break
        code = (code[:-1] << np.uint64(8)) | data[n - 1 :]
        if n in ORDERS:
            with np.errstate(over="ignore"):
                out.append((((code + np.uint64(n << 56)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


class Distinct:
    """One index of each distinct place, by writing and reading back a table that is never cleared."""

    def __init__(self):
        self.last = np.zeros(1 << BITS, np.int32)

    def __call__(self, place: np.ndarray) -> np.ndarray:
        number = np.arange(len(place), dtype=np.int32)
        self.last[place] = number
        return place[self.last[place] == number]


def fit(texts: list[str], labels: list[int], rounds: int = 150, l2: float = 1.0) -> tuple[np.ndarray, float]:
    """Weight of each place, and the intercept."""
    y = np.array(labels, np.float64)
    weight = np.zeros(1 << BITS, np.float32)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return weight, float(np.log(share / (1 - share)))
    distinct = Distinct()
    rows = [distinct(places(np.frombuffer(t.encode(), np.uint8))) for t in texts]
    flat = np.concatenate(rows)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    total = np.bincount(flat, minlength=1 << BITS)
    keep = total[flat] >= 3  # what one or two documents have says nothing about others
    flat, doc = flat[keep], doc[keep]
    used, col = np.unique(flat, return_inverse=True)
    pos = np.bincount(col, weights=y[doc], minlength=len(used))
    neg = np.bincount(col, minlength=len(used)) - pos
    ratio = np.log((pos + 1) / (y.sum() + 2)) - np.log((neg + 1) / ((1 - y).sum() + 2))
    n_docs = len(rows)
    value = ratio[col]
    w, step = np.zeros(len(used)), np.zeros(len(used))
    bias = float(np.log(y.mean() / (1 - y.mean())))
    speed_w, speed_b = np.zeros(len(used)), 0.0
    for i in range(rounds):  # Adam on the whole sample
        z = np.bincount(doc, weights=value * w[col], minlength=n_docs) + bias
        miss = sigmoid(z) - y
        grad = np.bincount(col, weights=value * miss[doc], minlength=len(used)) + l2 * w
        step = 0.9 * step + 0.1 * grad
        speed_w = 0.99 * speed_w + 0.01 * grad * grad
        speed_b = 0.9 * speed_b + 0.1 * miss.sum()
        w -= 0.02 * (step / (1 - 0.9 ** (i + 1))) / (np.sqrt(speed_w / (1 - 0.99 ** (i + 1))) + 1e-8)
        bias -= 0.02 * np.sign(speed_b) * min(1.0, abs(speed_b) / n_docs * 20)
    weight[used] = (ratio * w).astype(np.float32)
    return weight, bias


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 1500,
          sample_chars: int = 24_000_000, folds: int = 5, held_out: int = 0) -> tuple[np.ndarray, float]:
    """Fit in one task on the bounded sample; only the weights come back. The prior odds are those of all labels."""
    sample = labelled_sample(docs, labels, label, per_class, folds, held_out).repartition(1)

    def run(frames):
        texts, y = bounded_rows(frames, sample_chars)
        weight, bias = fit(texts, y)
        yield pd.DataFrame({"weight": [weight.tobytes()], "bias": [bias], "n0": [len(y) - sum(y)], "n1": [sum(y)]})

    row = sample.mapInPandas(run, "weight binary, bias double, n0 long, n1 long").first()
    if row is None:
        return fit([], [])
    bias = row["bias"]
    if row["n0"] and row["n1"]:
        n0, n1 = class_counts(labels, label, folds, held_out)
        bias += math.log(n1 / n0) - math.log(row["n1"] / row["n0"])
    return np.frombuffer(bytes(row["weight"]), np.float32), bias


def score(docs: DataFrame, model: tuple[np.ndarray, float], keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` and `score`, from 0 to 1, of every whole text."""
    weight, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(weight)
    base = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], blank_null(text_col).alias("t"))
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "score double"])

    def run(batches):
        distinct, w = Distinct(), shared.value
        for batch in pieces(batches, "t"):
            off, data = text_bytes(batch.column("t"))
            z = np.array([w[distinct(places(data[a:b]))].sum(dtype=np.float64) for a, b in zip(off[:-1], off[1:], strict=True)])
            yield pa.RecordBatch.from_arrays([*(batch.column(f"k{i}") for i in range(len(keep))),
                                              pa.array(sigmoid(z + bias), pa.float64())], names=[*keep, "score"])

    return base.mapInArrow(run, schema)
