"""Operator 8: a regularised quadratic discriminant over transformed document statistics.

Each whole text gives STATISTICS: shares of character classes, word and line statistics, and logarithms of sizes. From a
sample of labelled documents (at most `per_class` of either class and `sample_chars` characters in all; both are
parameters) each class gets its mean and a covariance shrunk towards the pooled covariance and its diagonal. The
Cholesky factors are computed once and travel with the code; a score is the logistic function of the difference of the
two Mahalanobis log densities plus the log prior odds. The model has a fixed size; scoring is one pass without a
shuffle.

Null and empty texts have the statistics of no characters and get the score those have. Without labels of both classes
every score is the share of label 1 among the labels (0.5 without any). Repeated rows get equal scores; an empty table
gives no rows; further columns are ignored whatever their names. Texts of any length are scored whole; one that doesn't fit
into what is left of `sample_chars` is not fitted on.
"""

from __future__ import annotations

import json
import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import blank_null, pieces, text_bytes
from carelens.llm.labelled import bounded_rows, class_counts, labelled_sample, sigmoid

#: Byte classes: lower case, upper case, digit, blank, line end, sentence end, comma and the like, other ASCII, not ASCII.
CLASSES = 9
CLASS = np.full(256, 8, np.uint8)
CLASS[:128] = 7
CLASS[ord("a") : ord("z") + 1] = 0
CLASS[ord("A") : ord("Z") + 1] = 1
CLASS[ord("0") : ord("9") + 1] = 2
CLASS[[9, 11, 12, 32]] = 3
CLASS[[10, 13]] = 4
CLASS[[ord(c) for c in ".!?"]] = 5
CLASS[[ord(c) for c in ",;:'\"()-"]] = 6
STATISTICS = ("log_bytes", "log_words", "log_lines", "word_length", "word_spread", "lower", "upper", "digits",
              "blanks", "sentence_ends", "commas", "symbols", "other_script", "distinct_words", "top_word",
              "distinct_lines", "line_spread", "short_words", "long_words", "words_a_sentence")
#: With so many words, a text's statistics count half.
FEW_WORDS = 10.0


def statistics(texts: list[str], off: np.ndarray, data: np.ndarray) -> np.ndarray:
    """A row of STATISTICS per text. off and data: the texts' UTF-8 bytes."""
    n = len(texts)
    out = np.zeros((n, len(STATISTICS)))
    size = np.diff(off).astype(np.float64)
    kind = CLASS[data]
    counts = np.zeros((n, CLASSES))
    full = np.flatnonzero(size > 0)
    for k in range(CLASSES):
        if len(full):
            counts[full, k] = np.add.reduceat((kind == k).astype(np.int32), off[full], dtype=np.int64)
    root = np.sqrt  # shares near zero are spread out by a square root
    for i, t in enumerate(texts):
        words = t.split()
        lines = [x for x in t.split("\n") if x]
        if words:
            length = np.fromiter(map(len, words), np.int32, len(words))
            times = Counter(words)
            out[i, 3], out[i, 4] = math.log1p(length.mean()), math.log1p(length.std())
            out[i, 13] = len(times) / len(words)
            out[i, 14] = root(max(times.values()) / len(words))
            out[i, 17], out[i, 18] = root((length <= 3).mean()), root((length > 12).mean())
            out[i, 19] = math.log1p(len(words) / (1 + counts[i, 5]))
        if lines:
            spread = np.fromiter(map(len, lines), np.int32, len(lines))
            out[i, 15] = len(set(lines)) / len(lines)
            out[i, 16] = math.log1p(spread.std())
        out[i, 1], out[i, 2] = math.log1p(len(words)), math.log1p(len(lines))
    share = root(counts / np.maximum(size, 1)[:, None])
    out[:, 0] = np.log1p(size)
    out[:, 5:13] = share[:, [0, 1, 2, 3, 5, 6, 7, 8]]
    return out


class Discriminant:
    """Means, Cholesky factors and log determinants of two classes."""

    def __init__(self, x: np.ndarray, y: np.ndarray, pooled: float = 0.5, diagonal: float = 0.1):
        self.constant = None
        n1, n0 = int((y == 1).sum()), int((y == 0).sum())
        if min(n0, n1) < 2:
            self.constant = (n1 + 1) / (n0 + n1 + 2)
            return
        self.centre, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.centre) / self.scale * self.trust(x)
        parts = [x[y == c] for c in (0, 1)]
        together = sum((p - p.mean(axis=0)).T @ (p - p.mean(axis=0)) for p in parts) / len(x)
        self.prior = math.log(n1 / n0)
        self.mean, self.factor, self.log_det = [], [], []
        for p in parts:
            own = np.cov(p.T, bias=True)
            cov = (1 - pooled) * own + pooled * together
            cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + 1e-3 * np.eye(x.shape[1])
            low = np.linalg.cholesky(cov)
            self.mean.append(p.mean(axis=0))
            self.factor.append(np.linalg.inv(low))  # whitens: a distance is one product
            self.log_det.append(2 * np.log(np.diag(low)).sum())

    @staticmethod
    def trust(x: np.ndarray) -> np.ndarray:
        """How far a text's statistics count against the average text's: few words say little."""
        words = np.expm1(x[:, STATISTICS.index("log_words")])
        return (words / (words + FEW_WORDS))[:, None]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), math.log(self.constant / (1 - self.constant)))
        x = (x - self.centre) / self.scale * self.trust(x)
        far = [((x - m) @ f.T) for m, f in zip(self.mean, self.factor, strict=True)]
        dist = [(z * z).sum(axis=1) + d for z, d in zip(far, self.log_det, strict=True)]
        return 0.5 * (dist[0] - dist[1]) + self.prior

    def state(self) -> str:
        return json.dumps({k: [np.asarray(z).tolist() for z in v] if isinstance(v, list) else
                           v.tolist() if isinstance(v, np.ndarray) else v for k, v in vars(self).items()})

    @classmethod
    def load(cls, state: str) -> Discriminant:
        out = cls.__new__(cls)
        for k, v in json.loads(state).items():
            setattr(out, k, [np.array(z) for z in v] if k in ("mean", "factor") else
                    np.array(v) if k in ("centre", "scale") else v)
        return out


def of_texts(texts: list[str]) -> np.ndarray:
    raw = [t.encode() for t in texts]
    return statistics(texts, np.cumsum([0, *map(len, raw)]), np.frombuffer(b"".join(raw), np.uint8))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 3000,
          sample_chars: int = 24_000_000, folds: int = 5, held_out: int = 0) -> Discriminant:
    """Fit in one task on the bounded sample; only means and factors come back. The sample has the classes' own
    shares only where neither class has more than per_class labels, so the prior odds are those of all labels."""
    sample = labelled_sample(docs, labels, label, per_class, folds, held_out).repartition(1)

    def run(frames):
        texts, y = bounded_rows(frames, sample_chars)
        yield pd.DataFrame({"state": [Discriminant(of_texts(texts), np.array(y)).state()]})

    row = sample.mapInPandas(run, "state string").first()
    model = Discriminant.load(row["state"]) if row else Discriminant(of_texts([]), np.zeros(0))
    n0, n1 = class_counts(labels, label, folds, held_out)
    if model.constant is None and n1 and n0:
        model.prior = math.log(n1 / n0)
    return model


def score(docs: DataFrame, model: Discriminant, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` and `score`, from 0 to 1, of every whole text."""
    base = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], blank_null(text_col).alias("t"))
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "score double"])

    def run(batches):
        for batch in pieces(batches, "t"):
            off, data = text_bytes(batch.column("t"))
            odds = model.log_odds(statistics(batch.column("t").to_pylist(), off, data))
            yield pa.RecordBatch.from_arrays([*(batch.column(f"k{i}") for i in range(len(keep))),
                                              pa.array(sigmoid(odds), pa.float64())], names=[*keep, "score"])

    return base.mapInArrow(run, schema)
