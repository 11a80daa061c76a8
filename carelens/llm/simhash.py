"""Operator 12: near-duplicates by SimHash fingerprints and multi-index hashing.

A text's shingles are its runs of `words` words (A-Z lower-cased, split at white space, joined by one space; repeats
included; a text of fewer words is one shingle). A fingerprint bit is 1 if it is set in over half of the shingles' XXH64
(seed 42). Fingerprints link at DISTANCE (3) or fewer differing bits, and components of links are classes.

1. Texts with one fingerprint are one node from here on, so copies cost nothing.
2. Multi-index: of two fingerprints that differ in at most 3 bits, one half of 32 bits differs in at most one. Each
   fingerprint enters a table under both halves and looks up the Hamming ball of radius 1 around each: of two halves that
   differ in one bit, the one that has the bit set looks the other up, so 16 look-ups a half do.
3. A bucket holds one half's value, the fingerprints that have it and those that looked it up. They are compared over all
   64 bits, breadth first, and give one tie per fingerprint at most, never all pairs.
4. A bucket that more than HOT fingerprints fall into is split by the other half: of what is left, 3 bits in 32, one part
   of 16 bits differs in at most one, so the same enumeration gives buckets of 48 known bits. These hold 65,536 own
   fingerprints at most, whatever the table's size.
5. Components of the ties (`components`), the least id of each, and back to the rows by fingerprint.

Null texts and texts without words have no shingles: fingerprint zero, linked like any other. Rows that repeat an id are
documents of their own; the component id is the least id of the class (null ids count only where there is no other). An
empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import blank_null, pieces, text_bytes, written
from carelens.llm.components import components

DISTANCE, SEED = 3, 42
HOT = 20_000
SHARD_ROWS = 400_000
PIECE = 256 << 10


def fingerprints(raw: bytes, off: np.ndarray, words: int = 3) -> np.ndarray:
    """The SimHash of each text raw[off[i] : off[i + 1]]."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    flat: list[int] = []
    begin = [0]
    raw = raw.lower()
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        own = raw[a:b].split()
        if len(own) <= words:
            flat += [digest(b" ".join(own), SEED)] if own else []
        else:
            joined = b" ".join(own)
            end = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
            start = [0, *(end[: -words] + 1).tolist()]
            flat += [digest(joined[x:y], SEED) for x, y in zip(start, end[words - 1 :].tolist(), strict=True)]
        begin.append(len(flat))
    out = np.zeros(len(begin) - 1, np.uint64)
    h, at = np.array(flat, np.uint64), np.array(begin, np.int64)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, at[:-1][full], axis=0, dtype=np.int32)
        more = 2 * ones > np.diff(at)[full][:, None]
        out[full] = np.packbits(more, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def near(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= DISTANCE


def ties(bucket: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of fingerprints that connect each bucket's as far as links do; one per fingerprint and bucket at most."""
    order = np.lexsort((fp, bucket))
    bucket, fp = bucket[order], fp[order]
    if not len(fp):
        return fp, fp
    fresh = np.ones(len(fp), bool)
    fresh[1:] = (bucket[1:] != bucket[:-1]) | (fp[1:] != fp[:-1])
    bucket, fp = bucket[fresh], fp[fresh]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    size = np.diff(np.append(first, len(fp)))
    hub = np.repeat(first, size)
    ok = near(fp, fp[hub])
    a, b = [fp[ok & (hub != np.arange(len(fp)))]], [fp[hub[ok & (hub != np.arange(len(fp)))]]]
    for i in np.flatnonzero(np.add.reduceat(ok.astype(np.int64), first) < size):  # buckets whose first isn't near all others
        left = fp[first[i] : first[i] + size[i]]
        while len(left):
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                here = queue.pop()
                hit = near(left, here)
                if hit.any():
                    a.append(left[hit])
                    b.append(np.full(int(hit.sum()), here))
                    queue += list(left[hit])
                    left = left[~hit]
    return np.concatenate(a), np.concatenate(b)


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp long) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for piece in pieces(batches, "t", PIECE):
            off, data = text_bytes(piece.column("t"))
            fp = fingerprints(data.tobytes(), off, words)
            yield pa.RecordBatch.from_arrays([piece.column("i"), pa.array(fp.view(np.int64))], names=["i", "fp"])

    return docs.select(F.col(id_col).alias("i"), blank_null(text_col).alias("t")).mapInArrow(run, f"i {kind}, fp long")


def _ball(value: str, bits: int) -> str:
    """The value itself and, for each bit set in it, the value without that bit."""
    return f"filter(transform(sequence(-1, {bits - 1}), i_ -> if(i_ < 0, {value}, {value} & ~shiftleft(1L, i_))), (x_, i_) -> i_ = 0 OR x_ != {value})"


def _half(half: str) -> str:
    return f"(CASE {half} WHEN 0 THEN shiftrightunsigned(fp, 32) ELSE fp & 4294967295L END)"


def looked_up(nodes: DataFrame) -> DataFrame:
    """(half, v, fp): each fingerprint in the buckets of its halves and of the ball around each."""
    halves = nodes.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("half")).select("fp", "half", F.expr(_half("half")).alias("own"))
    return halves.select("half", "fp", F.explode(F.expr(_ball("own", 32))).alias("v"))


def _hot(nodes: DataFrame, hot: int) -> DataFrame:
    """(half, v) of buckets into which more than `hot` fingerprints fall from values that hold a 33rd of `hot` each; the
    others together bring no more than `hot`."""
    own = nodes.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("half")).select("half", F.expr(_half("half")).alias("own"))
    big = own.groupBy("half", "own").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot // 33)
    load = big.select("half", "n", F.explode(F.expr(_ball("own", 32))).alias("v")).groupBy("half", "v").agg(F.sum("n").alias("n"))
    return load.where(F.col("n") > hot).select("half", "v")


def _split(rows: DataFrame) -> DataFrame:
    """Rows of hot buckets by the parts of the other half as well: (half, v, part, w, fp)."""
    other = f"({_half('1 - half')})"
    part = f"(CASE part WHEN 0 THEN shiftrightunsigned({other}, 16) ELSE {other} & 65535L END)"
    parts = rows.select("half", "v", "fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("part"))
    parts = parts.select("half", "v", "fp", "part", F.expr(part).alias("own"))
    return parts.select("half", "v", "part", "fp", F.explode(F.expr(_ball("own", 16))).alias("w"))


def links(nodes: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b): ties that connect the distinct fingerprints `fp` as links at DISTANCE do."""
    rows = looked_up(nodes)
    hots = written(_hot(nodes, hot), "simhash_hot")
    bucket = F.xxhash64("half", "v")
    if hots.isEmpty():
        dealt = rows.select(bucket.alias("bucket"), "fp")
    else:
        marked = rows.join(hots.withColumn("hot", F.lit(True)), ["half", "v"], "left")
        cool = marked.where(F.col("hot").isNull()).select(bucket.alias("bucket"), "fp")
        dealt = cool.unionByName(_split(marked.where("hot")).select(F.xxhash64("half", "v", "part", "w").alias("bucket"), "fp"))
    count = nodes.count()
    shards = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(count * 34 / SHARD_ROWS))

    def run(batches):
        bucket_, fp = [], []
        for batch in batches:
            bucket_.append(np.asarray(batch.column("bucket")).astype(np.int64))
            fp.append(np.asarray(batch.column("fp")).astype(np.int64))
        if bucket_:
            a, b = ties(np.concatenate(bucket_), np.concatenate(fp).view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return dealt.repartition(shards, "bucket").mapInArrow(run, "a long, b long")


def hex_of(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, hot: int = HOT) -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hex digits), component_id (the least id of its class)."""
    signed = written(fingerprinted(docs, id_col, text_col, words), "simhash_fingerprints")
    nodes = written(signed.groupBy("fp").agg(F.min("i").alias("least")), "simhash_nodes")
    roots = components(links(nodes.select("fp"), hot), "simhash_links")
    # the least id of each class, first by fingerprint and then by class, so that a hot one costs a row per task
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("class"))
    named = written(named, "simhash_classes")
    best = named.groupBy("class").agg(F.min("least").alias("component_id"))
    by_fp = named.join(best, "class").select("fp", "component_id")
    return signed.join(by_fp, "fp", "left").select(F.col("i").alias(id_col), hex_of(F.col("fp")).alias("fingerprint"), "component_id")
