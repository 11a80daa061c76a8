"""Dimension history (type 2): versions of each key with their validity, from successive extracts.

An extract says how a key looked at its time.  A version lasts from the first extract that shows it to the next extract that
shows another one or, where extracts are full, lacks the key; the newest has no end.  A key has a row per extract at most,
so nothing here gathers more than the extracts of one key.  The versions feed the as-of and range joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelens.operators.intervals import range_join

FROM, TO = "valid_from", "valid_to"


def history(extracts: DataFrame, keys: list[str], time: str, full: bool = True) -> DataFrame:
    """One row per version: the keys, the other columns, ``valid_from``, ``valid_to`` and ``extracts`` (how many show it).

    Of several rows of one key and time the greatest counts.  Null keys are a key like others, nulls equal nulls, and rows
    without a time are left out.  ``full=False``: an extract holds changed keys only, and a key that it lacks goes on.
    """
    attributes = [c for c in extracts.columns if c not in (*keys, time)]
    if {FROM, TO, "extracts"} & set(extracts.columns):
        raise ValueError(f"columns are named {FROM}, {TO} or extracts")
    k = [F.col(f"`{c}`") for c in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in attributes])
    seen = extracts.where(F.col(f"`{time}`").isNotNull()).groupBy(*k, F.col(f"`{time}`").alias("_t")).agg(F.max(row).alias("_a"))
    # a row per extract: its number and the time of the next one
    times = extracts.select(F.col(f"`{time}`").alias("_t")).where("_t IS NOT NULL").distinct()
    in_order = Window.orderBy("_t")  # as many rows as extracts
    times = times.select("_t", F.row_number().over(in_order).alias("_i"), F.lead("_t").over(in_order).alias("_next"))
    along = Window.partitionBy(*k).orderBy("_t")
    placed = seen.join(times, "_t").withColumns({"_before": F.lag("_a").over(along), "_j": F.lag("_i").over(along)})
    new = F.col("_j").isNull() | ~F.col("_a").eqNullSafe(F.col("_before"))
    new = new | (F.col("_i") != F.col("_j") + 1) if full else new
    numbered = placed.withColumn("_v", F.sum(new.cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    versions = numbered.groupBy(*k, "_v").agg(F.first("_a").alias("_a"), F.min("_t").alias(FROM), F.max(F.struct("_t", "_next")).alias("_last"), F.count(F.lit(1)).alias("extracts"))
    end = F.col("_last._next") if full else F.lead(FROM).over(Window.partitionBy(*k).orderBy(FROM))
    return versions.withColumn(TO, end).select(*k, *[F.col(f"_a.`{c}`") for c in attributes], FROM, TO, "extracts")


def observations(versions: DataFrame, times: DataFrame, time: str) -> DataFrame:
    """What the extracts at ``times`` (one column, named ``time``) showed, from the versions made of them (``full``)."""
    columns = [c for c in versions.columns if c not in (FROM, TO, "extracts")]
    met = range_join(times.select(F.col(f"`{time}`").alias("_t")).distinct(), versions.drop("extracts"), "_t", FROM, TO)
    return met.select(*[F.col(f"i.`{c}`") for c in columns], F.col("p._t").alias(time))


def with_extract(versions: DataFrame, times: DataFrame, extract: DataFrame, keys: list[str], time: str) -> tuple[DataFrame, DataFrame]:
    """(versions, times) with one more full extract, of whatever time: a later one ends versions or goes on with them, a
    back-filled one splits the version it falls into, and one that is there already replaces itself, which changes nothing.
    Write both before the next extract; else plans grow with their number."""
    taken = extract.select(F.col(f"`{time}`")).distinct()
    before = observations(versions, times, time).join(taken, time, "left_anti").select(*[F.col(f"`{c}`") for c in extract.columns])
    return history(before.unionByName(extract), keys, time), times.unionByName(taken).distinct()
