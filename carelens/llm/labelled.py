"""A bounded, repeatable sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import blank_null, fold_of


def known_labels(labels: DataFrame, label: str, folds: int, held_out: int, id_col: str = "doc_id") -> DataFrame:
    """(l_id, y) of every id outside the held-out fold that has a label. Labels that are null or neither 0 nor 1 don't
    count; of several labels of an id the largest does."""
    return (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & (fold_of(id_col, folds) != held_out))
            .groupBy(F.col(id_col).alias("l_id")).agg(F.max(label).cast("int").alias("y")))


def class_counts(labels: DataFrame, label: str, folds: int, held_out: int) -> tuple[int, int]:
    """How many ids outside the held-out fold have label 0 and label 1."""
    seen = known_labels(labels, label, folds, held_out).agg(F.sum(1 - F.col("y")), F.sum("y")).first()
    return seen[0] or 0, seen[1] or 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, folds: int, held_out: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(t, y): text and label of at most per_class documents of either class, those whose ids hash lowest, of the
    labels that `known_labels` has. The ids are at most 2 * per_class rows, so they are broadcast and the documents aren't shuffled."""
    known = known_labels(labels, label, folds, held_out, id_col).withColumn("h", F.xxhash64("l_id"))
    ids = None
    for y in (0, 1):
        some = known.where(F.col("y") == y).orderBy("h", "l_id").limit(per_class)
        ids = some if ids is None else ids.unionByName(some)
    texts = docs.select(F.col(id_col).alias("d_id"), blank_null(text_col).alias("t"))
    return (texts.join(F.broadcast(ids), F.col("d_id") == F.col("l_id")).orderBy("h", "d_id", "t")
            .limit(2 * per_class).select("t", "y"))


def bounded_rows(frames, limit: int) -> tuple[list[str], list[int]]:
    """Texts and labels, in order, of as many documents as fit into `limit` characters."""
    texts, labels, room = [], [], limit
    for frame in frames:
        for t, y in zip(frame["t"], frame["y"], strict=True):
            if len(t) <= room:
                room -= len(t)
                texts.append(t)
                labels.append(int(y))
    return texts, labels


def sigmoid(z):
    import numpy as np

    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))
