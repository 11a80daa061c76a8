"""Operator 6: URL filters: rules by host and path, and gradient-boosted trees on lexical features for the rest.

The rules label the URLs they fit; on at most `per_class` distinct URLs of either label (those that hash lowest; a
parameter) boosted trees are trained with Spark ML, and judge the URLs that no rule fits. A sampled URL weighs as many
rows as have it, and the classes weigh as all rows with a rule do, so neither a bounded sample nor a repeated URL moves
the verdicts. Features: lengths, depth, share of
digits, entropy, numbers of parameters, labels and marks, and statistics of the host's suffixes (how often the last
one and two labels were blocked among the training URLs: at most as many rows as these, so they are broadcast).
All of it is DataFrame work in the JVM. To fit, the URLs with a rule are counted and grouped (pre-aggregated, so a hot
URL costs a row per task); judging is one pass over the URLs without a shuffle.

A null URL or one without `://` has empty host and path and is judged by the trees. Without training URLs of both
labels the verdict is the label that there is, and allow without any. Very long URLs are judged whole. Repeated rows get
equal verdicts; an empty table gives no rows; further columns are ignored whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("f_length", "f_host", "f_path", "f_depth", "f_digits", "f_entropy", "f_params", "f_labels", "f_hyphens",
            "f_secure", "f_fragment", "f_last", "f_last_two", "f_ending")


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and where there is no `://`."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.expr("substring(u_url, instr(u_url, '://') + 3)")), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)


def best_rule(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits host (or a domain above it) and path, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # a longer rule is asked before a shorter
        domain, _, start = text.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit("/" + start))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def lexical(df: DataFrame) -> DataFrame:
    """The features that a URL has by itself, from u_url, host and path."""
    url = F.coalesce(F.col("u_url"), F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    count = lambda c, what: F.length(c) - F.length(F.replace(c, F.lit(what), F.lit("")))
    entropy = F.expr("""aggregate(transform(array_distinct(split(coalesce(u_url, ''), '')),
        c -> (length(u_url) - length(replace(u_url, c, ''))) / greatest(length(u_url), 1)),
        0D, (a, p) -> a - if(p > 0, p * log2(p), 0D))""")
    labels = F.split("host", r"\.")
    ending = F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)
    return df.select(
        "*", F.length(url).cast("double").alias("f_length"), F.length("host").cast("double").alias("f_host"),
        F.length("path").cast("double").alias("f_path"), count(F.col("path"), "/").cast("double").alias("f_depth"),
        ((F.length(url) - F.length(F.regexp_replace(url, "[0-9]", ""))) / n).alias("f_digits"),
        F.coalesce(entropy, F.lit(0.0)).alias("f_entropy"),
        (count(url, "=") + count(url, "&")).cast("double").alias("f_params"),
        F.size(labels).cast("double").alias("f_labels"), count(F.col("host"), "-").cast("double").alias("f_hyphens"),
        F.startswith(url, F.lit("https")).cast("double").alias("f_secure"),
        F.contains(url, F.lit("#")).cast("double").alias("f_fragment"), F.length(ending).cast("double").alias("f_ending"),
        F.element_at(labels, -1).alias("s_last"),
        F.concat_ws(".", F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2)).alias("s_last_two"))


class Filter:
    """Rules, and trees with the suffix statistics they were trained with."""

    def __init__(self, rules: Sequence[tuple[str, str]], per_class: int = 10_000, trees: int = 20, depth: int = 4,
                 seed: int = 7):
        self.rules, self.per_class, self.trees, self.depth, self.seed = rules, per_class, trees, depth, seed

    def _parsed(self, pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
        df = pages.select(F.col(id_col).alias("u_id"), F.col(url_col).cast("string").alias("u_url"))
        host, path = parts(F.col("u_url"))
        df = df.select("*", host.alias("host"), path.alias("path"))
        rule, verdict = best_rule(self.rules, F.col("host"), F.col("path"))
        return df.select("*", rule.alias("rule"), verdict.alias("ruled"))

    def _featured(self, df: DataFrame) -> DataFrame:
        """With the suffix statistics: the training rows' block odds by suffix, those of all where it isn't known."""
        df = lexical(df)
        for name in ("last", "last_two"):
            stat = getattr(self, f"by_{name}").select(F.col("suffix").alias(f"s_{name}"), F.col("odds").alias(f"f_{name}"))
            df = df.join(F.broadcast(stat), f"s_{name}", "left")
        df = df.fillna({"f_last": self.prior, "f_last_two": self.prior})
        return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)

    def fit(self, pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> Filter:
        ruled = self._parsed(pages, id_col, url_col).where(F.col("ruled").isNotNull())
        rows = {r["ruled"]: r["count"] for r in ruled.groupBy("ruled").count().collect()}  # two rows
        distinct = (ruled.groupBy("u_url", "host", "path", "ruled").agg(F.count(F.lit(1)).alias("n"))
                    .withColumn("h", F.xxhash64("u_url")))
        sample = None
        for verdict in ("allow", "block"):
            some = distinct.where(F.col("ruled") == verdict).orderBy("h", "u_url").limit(self.per_class)
            sample = some if sample is None else sample.unionByName(some)
        sample = sample.withColumn("label", (F.col("ruled") == "block").cast("double")).persist()
        seen = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.sum("n").alias("n")).collect()}  # two rows
        self.model, self.only = None, "block" if set(seen) == {1.0} else "allow"
        if len(seen) == 2:
            mean = rows["block"] / sum(rows.values())
            self.prior = math.log(mean / (1 - mean))
            # the classes' shares are those of all rows, the sum that of the sample's rows
            sampled = sum(seen.values())
            share = F.when(F.col("label") == 1.0, mean / seen[1.0]).otherwise((1 - mean) / seen[0.0]) * sampled
            weighted = sample.withColumn("weight", F.col("n") * share)
            named = lexical(weighted)
            for name in ("last", "last_two"):
                n, blocked = F.sum("weight"), F.sum(F.col("weight") * F.col("label"))
                odds = F.log((blocked + mean) / (n - blocked + 1 - mean))
                setattr(self, f"by_{name}", named.groupBy(F.col(f"s_{name}").alias("suffix")).agg(odds.alias("odds")).persist())
            trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=self.trees,
                                  maxDepth=self.depth, stepSize=0.2, subsamplingRate=1.0, seed=self.seed)
            self.model = trees.fit(self._featured(weighted).select("features", "label", "weight"))
        sample.unpersist()
        return self

    def judge(self, pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
        """id, host, path, rule, verdict and `block_score` (the trees' probability of block; null where a rule fits)."""
        df = self._parsed(pages, id_col, url_col)
        if self.model is None:
            scored = df.withColumn("judged", F.lit(self.only)).withColumn("block_score", F.lit(None).cast("double"))
        else:
            from pyspark.ml.functions import vector_to_array

            scored = self.model.transform(self._featured(df)).withColumn("block_score", vector_to_array("probability")[1])
            scored = scored.withColumn("judged", F.when(F.col("prediction") == 1.0, "block").otherwise("allow"))
        open_ = F.col("rule").isNull()
        return scored.select(F.col("u_id").alias(id_col), "host", "path", "rule",
                             F.coalesce("ruled", "judged").alias("verdict"), F.when(open_, F.col("block_score")).alias("block_score"))
