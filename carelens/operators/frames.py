"""Analytic windows that no partition key can overload: ranks in two levels, and range frames with halo rows.

A plain window sends all rows of a key to one task.  Here a key is cut along its order: ranks are those within a cut plus
the rows before it, and a frame that looks back ``width`` gets the rows just before its cut once more (the halo).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelens.operators.sessions import floor_div, whole_number
from carelens.session import checkpoint_root


def ranks(df: DataFrame, keys: list[str], order: str, ascending: bool = False, cuts: int | None = None) -> DataFrame:
    """df with ``rank`` and ``dense_rank`` of each row by ``order`` within its keys; equal values rank equally, nulls last.

    Rows are dealt by ranges of (keys, order), so equal values are in one cut and a key with a third of the rows is in many;
    a row per key and cut then says how many rows, and how many values, came before.
    """
    checkpoint_root(df.sparkSession)
    cuts = cuts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    k = [F.col(f"`{c}`") for c in keys]
    way = F.col(f"`{order}`").asc_nulls_last() if ascending else F.col(f"`{order}`").desc_nulls_last()
    # the cuts are those of a table that stays: a cut's number must not change between the two uses
    dealt = df.repartitionByRange(cuts, *k, way).withColumn("_cut", F.spark_partition_id()).checkpoint()
    in_cut = Window.partitionBy(*k, "_cut").orderBy(way)
    local = dealt.withColumns({"_r": F.rank().over(in_cut), "_d": F.dense_rank().over(in_cut)})
    sizes = local.groupBy(*k, "_cut").agg(F.count(F.lit(1)).alias("_n"), F.max("_d").alias("_values"))
    before = Window.partitionBy(*k).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*[c.alias(f"_k{i}") for i, c in enumerate(k)], F.col("_cut").alias("_c"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
                         F.coalesce(F.sum("_values").over(before), F.lit(0)).alias("_values_before"))
    same = F.col("_cut") == F.col("_c")
    for i, c in enumerate(k):
        same = same & c.eqNullSafe(F.col(f"_k{i}"))
    joined = local.join(sizes, same)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_r") + F.col("_rows_before")).alias("rank"),
                         (F.col("_d") + F.col("_values_before")).alias("dense_rank"))


def top_per_key(df: DataFrame, keys: list[str], order: str, n: int, ascending: bool = False, cuts: int | None = None) -> DataFrame:
    """The rows of rank 1 to ``n`` of each key (ties at the last place all stay), with ``rank`` and ``dense_rank``."""
    return ranks(df, keys, order, ascending, cuts).where(F.col("rank") <= n)


#: Aggregates of a frame.
KINDS = ("count", "sum", "avg", "min", "max")


def running(df: DataFrame, keys: list[str], order: str, width: int, aggs: dict[str, tuple[str, str]], bucket: int | None = None) -> DataFrame:
    """df with aggregates (name -> (kind, column)) over the rows of equal keys from ``width`` before a row up to it.

    ``order`` is a time (``width`` and ``bucket`` in seconds) or a whole number.  Both ends count, and rows of equal order see
    each other.  A key is cut into buckets (16 widths long if not given); the rows of the last ``width`` of a bucket go to
    the next one too, for its first rows to look at.  Rows without an order value see no others (count 0, else null).
    """
    kind = df.schema[order].dataType.simpleString()
    scale = 1_000_000 if kind.startswith("timestamp") or kind == "date" else 1
    bucket = 16 * max(width, 1) if bucket is None else bucket
    bad = [x for x, _ in aggs.values() if x not in KINDS]
    if bad or width < 0 or bucket < max(width, 1):
        raise ValueError(f"kinds {bad}, width {width}, bucket {bucket}: a bucket is no shorter than the width")
    width, bucket = width * scale, bucket * scale
    k = [f"_k{i}" for i in range(len(keys))]
    base = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keys, k, strict=True)], whole_number(order, kind).alias("_t"),
                     *[F.col(f"`{c}`").alias(f"_a{i}") for i, (_, c) in enumerate(aggs.values())],
                     F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    timed = base.where("_t IS NOT NULL").withColumn("_b", floor_div("_t", bucket))
    own = timed.withColumn("_halo", F.lit(False))
    halo = (timed.where((F.col("_b") + 1) * bucket - F.col("_t") <= width)
            .withColumn("_b", F.col("_b") + 1).withColumn("_row", F.lit(None).cast(base.schema["_row"].dataType)).withColumn("_halo", F.lit(True)))
    frame = Window.partitionBy(*k, "_b").orderBy("_t").rangeBetween(-width, 0)
    found = own.unionByName(halo).select("_row", "_halo", *[F.expr(f"{x}(_a{i})").over(frame).alias(n) for i, (n, (x, _)) in enumerate(aggs.items())])
    blank = base.where("_t IS NULL").select("_row", *[F.lit(0 if x == "count" else None).cast(found.schema[n].dataType).alias(n) for n, (x, _) in aggs.items()])
    return found.where("NOT _halo").drop("_halo").unionByName(blank).select("_row.*", *[F.col(f"`{n}`") for n in aggs])
