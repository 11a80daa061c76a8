"""Operator 4: benchmark decontamination by winnowing, with DataFrame and SQL functions only.

A text's fingerprints are the minimum hashes of its k-grams of words in each w consecutive k-grams. Two texts that share
k + w - 1 words in a row share one of them. Windows of `window` words (10) take k = 5 and w = 6; items that are shorter
than a window and must occur whole take tiers of their own (TIERS), which are only run where such items exist.

1. The documents' fingerprints are joined with the items'. The items' side is broadcast only up to `broadcast_rows`
   rows, counted first; beyond, both sides are shuffled on the hash.
2. Only documents with a hit are read again. Each place of a shared gram in either text gives a diagonal; along it the
   words themselves are compared, which extends the hit to every window that occurs.
3. Words covered by any window are counted once per document.

Rows are shuffled per fingerprint hit and per covered word, never per pair of documents. Null texts and texts without
words have no words and no hits; an item without words is contained nowhere; items with equal texts are all reported;
rows that repeat an id are judged each by its own text. An empty table gives no rows, or no hits. Only the named
columns are read, so others may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.native import ascii_lower, grams, let, window_minima, word_hashes, words

#: What separates words: all ASCII but letters and digits.
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
#: (least words of a span, k, w): a shared span of so many words shares a fingerprint.
TIERS = ((1, 1, 1), (2, 2, 1), (5, 3, 3), (10, 5, 6))


def _key(id_col: str, text_col: str):
    """One long for a row's id and text; equal rows share it and are judged alike."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _fingerprints(k: int, w: int) -> str:
    """SQL: the fingerprints of the array `words`."""
    return let("h_", word_hashes("words"), let("g_", grams("h_", k), window_minima("g_", w)))


def _tier(n, window: int):
    """The tier that an item of n words belongs to (by its position in TIERS)."""
    out = F.lit(None).cast("int")
    for i, (least, _, _) in enumerate(TIERS):
        out = F.when(F.least(n, F.lit(window)) >= least, F.lit(i)).otherwise(out)
    return out


def _worded(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("words", F.expr(words(ascii_lower(text), SEPARATORS)))


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_id: str = "item_id", item_text: str = "text", window: int = 10,
            broadcast_rows: int = 500_000) -> DataFrame:
    """(k, item, start, stop): the spans of words, 0-based and `stop` excluded, of documents (by `_key`) that a window
    of an item covers."""
    items = _worded(benchmark.select(F.col(item_id).alias("item"), F.col(item_text).cast("string").alias("t")), "t")
    items = (items.where(F.size("words") > 0).select("item", "words", F.size("words").alias("m"))
             .withColumn("tier", _tier(F.col("m"), window)))
    tiers = sorted(r["tier"] for r in items.select("tier").distinct().collect())  # four at most
    texts = docs.select(_key(id_col, text_col).alias("k"), F.col(text_col).cast("string").alias("t")).where("t IS NOT NULL")
    parts = [_tier_matches(texts, items.where(F.col("tier") == i), i, window, broadcast_rows) for i in tiers]
    out = parts[0] if parts else texts.crossJoin(items.limit(0)).selectExpr("k", "item", "0 AS start", "0 AS stop")
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _tier_matches(texts: DataFrame, items: DataFrame, tier: int, window: int, broadcast_rows: int) -> DataFrame:
    least, k, w = TIERS[tier]
    prints = items.select("item", F.explode(F.expr(_fingerprints(k, w))).alias("f"))
    small = prints.limit(broadcast_rows + 1).count() <= broadcast_rows
    sized = F.broadcast if small else (lambda df: df.hint("merge"))
    # 1. the documents and items that share a fingerprint
    worded = _worded(texts, "t").where(F.size("words") >= least)
    both = (worded.select("k", F.explode(F.expr(_fingerprints(k, w))).alias("f"))
            .join(sized(prints), "f").select("k", "item").distinct())
    # 2. for these, the diagonals on which grams agree, and the windows that agree along them
    sides = both.join(sized(items.select("item", F.col("words").alias("of_item"), "m")), "item").join(texts, "k")
    sides = _worded(sides, "t")
    shifts = let("a_", let("h_", word_hashes("words"), grams("h_", k)), let("b_", let("h_", word_hashes("of_item"), grams("h_", k)), """
        array_distinct(flatten(transform(
            filter(transform(a_, (g_, p_) -> struct(g_ AS g, p_ AS p)), s_ -> array_contains(b_, s_.g)),
            s_ -> transform(filter(transform(b_, (g_, q_) -> struct(g_ AS g, q_ AS q)), r_ -> r_.g = s_.g),
                            r_ -> s_.p - r_.q))))"""))
    starts = f"""array_distinct(flatten(transform(shifts, d_ -> transform(
        filter(sequence(0, m - span), j_ -> d_ + j_ BETWEEN 0 AND size(words) - span
               AND slice(of_item, j_ + 1, span) = slice(words, greatest(d_ + j_, 0) + 1, span)),
        j_ -> d_ + j_))))"""
    sides = sides.select("k", "item", "words", "of_item", "m", F.least("m", F.lit(window)).alias("span"),
                         F.expr(shifts).alias("shifts"))
    return (sides.select("k", "item", "span", F.explode(F.expr(starts)).alias("start"))
            .select("k", "item", "start", (F.col("start") + F.col("span")).alias("stop")))


def judge(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text", window: int = 10, **more) -> DataFrame:
    """One row per row of docs: id, n_words, n_hit (words in any window's occurrence), n_items and items_sha256 (items
    with occurring windows; their ids sorted as strings, comma-joined), contaminated."""
    hits = matches(docs, benchmark, id_col, text_col, item_id, item_text, window, **more)
    covered = (hits.select("k", F.explode(F.sequence("start", F.col("stop") - 1)).alias("p")).distinct()
               .groupBy("k").agg(F.count(F.lit(1)).alias("n_hit")))
    of_items = (hits.select("k", F.col("item").cast("string").alias("item")).distinct()
                .groupBy("k").agg(F.count(F.lit(1)).alias("n_items"),
                                  F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ","), 256).alias("items_sha256")))
    every = _worded(docs.select(F.col(id_col), _key(id_col, text_col).alias("k"),
                                F.col(text_col).cast("string").alias("t")), "t")
    every = every.select(F.col(id_col), "k", F.size("words").cast("long").alias("n_words"))
    return (every.join(covered, "k", "left").join(of_items, "k", "left")
            .select(F.col(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def without_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """The rows of docs, with all their columns, that no item's window occurs in."""
    hit = matches(docs, benchmark, id_col, text_col, **more).select(F.col("k").alias("hit_k")).distinct()
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _key(id_col, text_col).alias("k"))
    return keyed.join(hit, F.col("k") == F.col("hit_k"), "left_anti").select("row.*")
