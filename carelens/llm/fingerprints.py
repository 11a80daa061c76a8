"""Operator 7: one-permutation MinHash fingerprints with optimal densification and packed b-bit values, in SQL only.

A text's shingles are its runs of five words (A-Z lower-cased, split at white space; a shorter text is one shingle).
Each shingle is hashed once: the high bits of the hash name one of BINS bins, which keeps its least hash. An empty bin
takes the value of another: bins are drawn for it by a hash of its number and the attempt until one is filled
(Shrivastava's optimal densification); after TRIED draws, the filled bin with the least hash of both numbers is taken. A fingerprint is the low BITS bits of each bin's value,
hashed once more with the bin's number so that bins that borrowed the same value don't agree or differ all at once,
packed into hexadecimal text.

The likeness of two fingerprints is the share of equal values m corrected for chance, (m - 2^-b) / (1 - 2^-b), from 0 to
1. Texts without words have the fingerprint `EMPTY` (all texts without words are alike, and like no other).

`neighbours` pairs each row with the next by id without a global sort into one task: rows go to ranges of the id whose
bounds are ids of the table, and the first rows of a range are also sent to the range before it. Rows that share an id
are ordered by text; ids are numbers and null ones come first. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.native import ascii_lower, grams, let, word_hashes, words

BINS, BITS = 128, 4
#: Bins drawn for an empty bin before the filled bins are ranked instead.
TRIED = 6
BLANKS = r"\x20\x09-\x0D"
EMPTY = "-"


def fingerprint_sql(text: str) -> str:
    """The fingerprint of a string column; null counts as empty."""
    shift = 64 - BINS.bit_length() + 1
    hashes = let("h_", word_hashes("w_"), f"CASE WHEN size(h_) BETWEEN 1 AND 4 THEN array(xxhash64(h_)) ELSE {grams('h_', 5)} END")
    # sorted, the first hash of a bin is its least; then a map from bin to hash as two arrays
    firsts = let("s_", f"sort_array({hashes})", f"filter(s_, (x_, i_) -> i_ = 0 OR shiftrightunsigned(x_, {shift}) != "
                 f"shiftrightunsigned(get(s_, i_ - 1), {shift}))")
    bins = let("b_", f"transform(f_, x_ -> cast(shiftrightunsigned(x_, {shift}) AS INT))",
               f"transform(sequence(0, {BINS - 1}), j_ -> get(f_, cast(array_position(b_, j_) AS INT) - 1))")
    tried = ", ".join(f"get(v_, cast(pmod(xxhash64(j_, {n}), {BINS}) AS INT))" for n in range(TRIED))
    rest = (f"array_min(transform(f_, x_ -> struct(xxhash64(j_, shiftrightunsigned(x_, {shift}), {TRIED}) AS p, "
            "x_ AS x))).x")
    dense = let("f_", firsts, let("v_", bins, f"transform(v_, (y_, j_) -> coalesce(y_, {tried}, {rest}))"))
    packed = f"array_join(transform({dense}, (x_, n_) -> substring('0123456789abcdef', cast(xxhash64(x_, n_) & {2**BITS - 1} AS INT) + 1, 1)), '')"
    return let("w_", words(ascii_lower(text), BLANKS), f"CASE WHEN size(w_) = 0 THEN '{EMPTY}' ELSE {packed} END")


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of the shingle sets of two fingerprints."""
    same = f"size(filter(sequence(1, {BINS}), i_ -> substring({a}, i_, 1) = substring({b}, i_, 1))) / {BINS}"
    chance = 2.0**-BITS
    return F.expr(f"CASE WHEN {a} = {b} THEN 1D WHEN {a} = '{EMPTY}' OR {b} = '{EMPTY}' THEN 0D "
                  f"ELSE least(1D, greatest(0D, ({same} - {chance}D) / {1 - chance}D)) END")


def neighbours(df: DataFrame, ranges: int | None = None) -> DataFrame:
    """From (id, t, fingerprint): each row with next_t and next_fingerprint, those of the next row by id (after the
    last: the first). One shuffle. ranges: of the id, a task sorts some of them; bounds are that many ids at most."""
    n = ranges or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    found = df.agg(F.percentile_approx("id", [i / n for i in range(n)], 100 * n).alias("b"), F.min("id").alias("m"),
                   F.count(F.when(F.col("id").isNull(), 1)).alias("nulls")).first()  # n ids
    starts = sorted({*(found["b"] or []), found["m"]} - {None})
    nulls = int(found["nulls"] > 0)  # null ids are a range before the others
    kind = df.schema["id"].dataType.simpleString()
    if starts:
        listed = lambda ids: f"CAST(split('{','.join(map(str, ids))}', ',') AS array<{kind}>)"
        step = max(1, math.isqrt(len(starts)))  # a coarse and then a fine look-up
        below = lambda ids: f"size(filter({ids}, s_ -> s_ <= id))"
        place = let("c_", f"({below(listed(starts[::step]))} - 1) * {step}",
                    f"c_ + {below(f'slice({listed(starts)}, c_ + 1, {step})')} - 1")
        df = df.withColumn("r", F.when(F.col("id").isNull(), F.lit(0)).otherwise(F.expr(place) + nulls))
        start = F.expr(f"id = get({listed(starts)}, r - {nulls})")
        first = F.col("id").isNull() if nulls else F.expr(f"id = get({listed(starts)}, 0)")
    else:
        df, start, first = df.withColumn("r", F.lit(0)), F.lit(False), F.lit(True)
    to = lambda r, turn: F.struct(r.cast("int").alias("r"), F.lit(turn).alias("turn"))
    itself = to(F.col("r"), 0)  # turn 1: a copy for the range before; 2: the first rows of all, after the last range
    copies = (F.when(first, F.array(itself, to(F.lit(len(starts) - 1 + nulls if starts else 0), 2)))
              .when(start, F.array(itself, to(F.col("r") - 1, 1))).otherwise(F.array(itself)))
    spread = df.withColumn("c", F.explode(copies)).select("id", "t", "fingerprint", "c.r", "c.turn")
    order = Window.partitionBy("r").orderBy("turn", "id", "t")
    return (spread.withColumn("n", F.lead(F.struct("t", "fingerprint")).over(order)).where(F.col("turn") == 0)
            .select("id", "t", "fingerprint", F.coalesce("n.t", "t").alias("next_t"),
                    F.coalesce("n.fingerprint", "fingerprint").alias("next_fingerprint")))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column and `fingerprint` of every whole text."""
    return docs.select(F.col(id_col), F.expr(fingerprint_sql(f"`{text_col}`")).alias("fingerprint"))


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of the text whose last quarter is replaced by the beginning of the next document,
    and the likeness of the text to that and to the next document."""
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    df = neighbours(df.withColumn("fingerprint", F.expr(fingerprint_sql("t"))))
    df = df.select("*", F.length("t").alias("n"), F.expr("cast(length(t) DIV 4 AS INT)").alias("q"))
    df = df.select("id", F.col("n").cast("long").alias("n_chars"), "fingerprint", "next_fingerprint",
                   F.expr("concat(substring(t, 1, n - q), substring(next_t, 1, q))").alias("e"))
    df = df.select("id", "n_chars", F.sha2(F.col("e"), 256).alias("edited_sha256"), "fingerprint",
                   F.expr(fingerprint_sql("e")).alias("edited_fingerprint"), "next_fingerprint")
    return df.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                     likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                     likeness("fingerprint", "next_fingerprint").alias("near_next"))
