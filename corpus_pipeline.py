"""A training corpus from `documents`: language ID, near-duplicates, repeated passages, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; `run` writes what a stage
returns to the shared folder and reads it again. All stages but the last return the columns of documents and drop others.
Null and empty texts go in the first stage; later ones keep them (as empty texts from suffix_dedup on). Rows that repeat id
and text stay once from near_dedup on. Very long texts are worked on whole. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm import bpe, decontaminate, langid, neardup, suffixes
from carelens.llm.common import drop_folder, scratch_run, shared_path, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts without a letter or unlike every learned language go."""
    found = langid.identify(docs, langid.train(docs), keep=COLUMNS)
    return found.where(~F.col("rejected")).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each class of texts whose five-word shingles are 80 % alike or more."""
    return neardup.one_of_each(docs.select(COLUMNS), words=5)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of 51 words or more that occur elsewhere too (in other documents or in the same one)."""
    return suffixes.without_passages(docs.select(COLUMNS), n_chars="n_chars")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words (or a whole shorter item) of the benchmark."""
    return decontaminate.without_hits(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of the ids and of the text decoded from them."""
    return bpe.digests(docs, bpe.read_spec(spark), keep=["doc_id", "lang", "source"], with_ids=True)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup),
          ("decontamination", decontamination), ("tokenise", tokenise)]

#: SQL cannot express the stages; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage writes for itself goes when its result is there, and so does the result of
    the stage before it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline_{name}")
        with scratch_run(spark):
            docs = written(stage(spark, docs, sf_dir), name, path)
        if before:
            drop_folder(spark, before)
        before = path
    return docs
