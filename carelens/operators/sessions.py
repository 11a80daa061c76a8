"""Sessions of rows whose keys are equal and whose neighbours in time are no more than ``gap`` apart.

Equal to ``session_window`` (a row exactly ``gap`` after the last one still belongs), but no key's rows meet in one
task.  Rows are cut into time buckets: within a key and bucket a window finds the gaps, and each session becomes one
partial row.  Only the first and the last partial of a bucket can go on in a neighbouring one, and only if they come
within ``gap`` of its edge; those are stitched over the key, two rows a bucket at most, and all others are final.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How an aggregate's partial values are merged.
MERGE = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}


@dataclass(frozen=True)
class Agg:
    """A session's column: ``kind`` (count, sum, min or max) of a SQL expression."""
    name: str
    kind: str
    expr: str = "1"

    def first(self) -> Column:
        return F.expr(f"{self.kind}({self.expr})").alias(self.name)

    def merged(self) -> Column:
        return F.expr(f"{MERGE[self.kind]}(`{self.name}`)").alias(self.name)


def whole_number(col: str, kind: str) -> Column:
    """A time as microseconds (local times and dates in the session's time zone), a whole number as it is."""
    if kind.startswith("timestamp") or kind == "date":
        return F.expr(f"unix_micros(cast(`{col}` AS TIMESTAMP))")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.expr(f"cast(`{col}` AS BIGINT)")
    raise TypeError(f"{col}: {kind} is neither a time nor a whole number")


def floor_div(col: str, by: int) -> Column:
    return F.expr(f"`{col}` div {by} - if(`{col}` % {by} < 0, 1, 0)")


def sessions(rows: DataFrame, keys: list[str], order: str, gap: int, bucket: int | None = None, aggs: tuple[Agg, ...] = ()) -> DataFrame:
    """One row per session: keys, session_start and session_last (the first and last ``order`` value), n, and ``aggs``.

    ``order`` is a timestamp (``gap`` and ``bucket`` in seconds) or a whole number (in its unit).  ``bucket`` is the length
    of a time bucket, 24 gaps if not given, and more than one gap.  Rows without an order value belong to no session;
    null keys are a key like others.
    """
    kind = rows.schema[order].dataType.simpleString()
    timed = kind.startswith("timestamp") or kind == "date"
    scale = 1_000_000 if timed else 1
    bucket = 24 * gap if bucket is None else bucket
    names = [*keys, "session_start", "session_last", "n", *[a.name for a in aggs]]
    if len(set(names)) < len(names):
        raise ValueError(f"the result would have two columns of one name: {names}")
    if gap < 0 or bucket <= gap:
        raise ValueError("a bucket must be longer than the gap")
    gap, bucket = gap * scale, bucket * scale
    bad = [a.kind for a in aggs if a.kind not in MERGE]
    if bad:
        raise ValueError(f"partial values of {bad} cannot be merged")
    named = [F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]
    k = [f"_k{i}" for i in range(len(keys))]
    inputs = [F.expr(a.expr).alias(f"_a{i}") for i, a in enumerate(aggs)]
    own = [Agg(a.name, a.kind, f"`_a{i}`" if a.kind != "count" or a.expr != "1" else "1") for i, a in enumerate(aggs)]
    base = (rows.where(F.col(f"`{order}`").isNotNull()).select(*named, whole_number(order, kind).alias("_t"), *inputs)
            .withColumn("_b", floor_div("_t", bucket)))
    in_bucket = Window.partitionBy(*k, "_b").orderBy("_t")
    cut = F.coalesce((F.col("_t") - F.lag("_t").over(in_bucket) > gap).cast("int"), F.lit(0))
    numbered = base.withColumn("_cut", cut).withColumn("_s", F.sum("_cut").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)))
    partial = numbered.groupBy(*k, "_b", "_s").agg(F.min("_t").alias("_start"), F.max("_t").alias("_last"), F.count(F.lit(1)).alias("n"), *[a.first() for a in own])
    # the neighbouring bucket's nearest possible rows are just outside this one's edges
    reaches = (F.col("_start") - (F.col("_b") * bucket - 1) <= gap) | ((F.col("_b") + 1) * bucket - F.col("_last") <= gap)
    cols = [*k, "_start", "_last", "n", *[F.col(f"`{a.name}`") for a in aggs]]
    closed = partial.where(~reaches).select(*cols)
    of_key = Window.partitionBy(*k).orderBy("_start") if k else Window.orderBy("_start")
    apart = F.coalesce((F.col("_start") - F.lag("_last").over(of_key) > gap).cast("int"), F.lit(0))
    open_ = partial.where(reaches).withColumn("_cut", apart).withColumn("_s", F.sum("_cut").over(of_key.rowsBetween(Window.unboundedPreceding, 0)))
    stitched = open_.groupBy(*k, "_s").agg(F.min("_start").alias("_start"), F.max("_last").alias("_last"), F.sum("n").alias("n"), *[a.merged() for a in aggs])
    both = closed.unionByName(stitched.select(*cols))
    back = (lambda c: F.timestamp_micros(c).cast(kind)) if timed else (lambda c: c.cast(kind))
    return both.select(*[F.col(f"_k{i}").alias(key) for i, key in enumerate(keys)], back(F.col("_start")).alias("session_start"),
                       back(F.col("_last")).alias("session_last"), "n", *[F.col(f"`{a.name}`") for a in aggs])
