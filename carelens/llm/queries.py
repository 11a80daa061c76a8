"""The registered queries of the numbered operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm import (
    bpe, conversations, decontaminate, fingerprints, hmm, langid, neardup, quality, runs, simhash, suffixes, toxicity, urls,
)
from carelens.llm.common import fold_of, table
from carelens.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]
Query = Callable[[SparkSession, str], DataFrame]


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.read_spec(spark), keep=["doc_id"])


def op1_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = hmm.score(docs, learn=fold_of("doc_id", 5) != 1)
    return scored.select("doc_id", (fold_of("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs), keep=["doc_id"])
    return found.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: The rules that op6 judges by.
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.Filter(URL_RULES).fit(pages).judge(pages)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.classes(table(spark, sf_dir, "documents"), words=2)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffixes.dedup(table(spark, sf_dir, "documents"), keep=["doc_id"], passages=suffixes.WORDS, texts=False)
    removed = F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)")
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       "kept_sha256", "n_passage_words")


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find(table(spark, sf_dir, "documents"), keep=["doc_id"], damage="doc_id")
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(conversations.damaged(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Query] = {
    "op1_hmm": op1_hmm,
    "op2_langid": op2_langid,
    "op3_toxicity": op3_toxicity,
    "op4_decontaminate": op4_decontaminate,
    "op5_bpe": op5_bpe,
    "op6_urls": op6_urls,
    "op7_fingerprints": op7_fingerprints,
    "op8_quality": op8_quality,
    "op9_neardup": op9_neardup,
    "op10_suffixes": op10_suffixes,
    "op11_runs": op11_runs,
    "op12_simhash": op12_simhash,
    "op13_conversations": op13_conversations,
}
