"""As-of join: each fact with the latest version of its key that is not later than the fact.

No key's rows meet in one task.  Time is cut into buckets; a fact meets the versions of its own bucket and, as one more
version, the last one before the bucket, which is carried forward over the key's buckets (a row a bucket, never the
rows themselves).  A bucket with more than ``hot_rows`` facts of one key is dealt to several tasks, each of which sees
the bucket's versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelens.operators.sessions import floor_div, whole_number
from carelens.session import checkpoint_root

#: Hot buckets up to this number are broadcast (a few numbers each); beyond, they are joined by a shuffle.
HOT_BROADCAST_ROWS = 100_000


def asof_join(facts: DataFrame, versions: DataFrame, on: list[str], fact_time: str, version_time: str, carry: list[str],
              bucket_seconds: int, strict: bool = False, tolerance_seconds: int | None = None, hot_rows: int = 5_000_000) -> DataFrame:
    """All facts with their columns, then ``version_time`` and the ``carry`` columns of their version (nulls without one;
    names that the facts have too get the prefix ``v_``).

    A version at the fact's time counts, unless ``strict``.  Versions older than ``tolerance_seconds`` don't.  Of several
    versions at one time the one with the greatest ``carry`` values is taken.  Null keys match nothing, nor do facts or
    versions without a time.  ``bucket_seconds`` should hold some versions of a key; results don't depend on it.
    """
    checkpoint_root(facts.sparkSession)
    width = bucket_seconds * 1_000_000
    k = [f"_k{i}" for i in range(len(on))]
    whole = F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_row")
    keyed = [F.col(f"`{c}`").alias(n) for c, n in zip(on, k, strict=True)]
    usable = F.lit(True)
    for c in (*k, "_t"):
        usable = usable & F.col(c).isNotNull()
    f_all = facts.select(*keyed, whole_number(fact_time, facts.schema[fact_time].dataType.simpleString()).alias("_t"), whole)
    f = f_all.where(usable).withColumn("_b", floor_div("_t", width))
    value = F.struct(F.col("_u").alias("u"), F.col(f"`{version_time}`").alias("t"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]).alias("_v")
    v_time = whole_number(version_time, versions.schema[version_time].dataType.simpleString())
    v = versions.withColumn("_u", v_time).select(*keyed, F.col("_u").alias("_t"), value).where(usable).withColumn("_b", floor_div("_t", width))

    # a row per key and bucket: facts (0) get the last version of earlier buckets, before those of their own (1)
    counts = f.groupBy(*k, "_b").agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    last = v.groupBy(*k, "_b").agg(F.max(F.struct("_t", "_v")).alias("_l"))
    steps = (counts.select(*k, "_b", F.lit(0).alias("_kind"), F.lit(None).cast(last.schema["_l"].dataType).alias("_l"))
             .unionByName(last.select(*k, "_b", F.lit(1).alias("_kind"), "_l")))
    along = Window.partitionBy(*k).orderBy("_b", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = (steps.withColumn("_l", F.last("_l", ignorenulls=True).over(along)).where("_kind = 0 AND _l IS NOT NULL")
               .select(*k, F.col("_l._t").alias("_t"), F.col("_l._v").alias("_v"), "_b"))
    seen = v.join(counts.select(*k, "_b"), [*k, "_b"], "left_semi").select(*k, "_t", "_v", "_b").unionByName(carried)

    hot = counts.where(F.col("_n") > hot_rows).select(*k, "_b", F.ceil(F.col("_n") / hot_rows).cast("long").alias("_parts"))
    n_hot = hot.count()
    if n_hot:
        few = F.broadcast(hot) if n_hot <= HOT_BROADCAST_ROWS else hot
        salt = F.when(F.col("_parts").isNotNull(), F.expr("pmod(xxhash64(_row), _parts)")).otherwise(F.lit(0).cast("long"))
        f = f.join(few, [*k, "_b"], "left").withColumn("_p", salt).drop("_parts")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)) - 1))
        seen = seen.join(few, [*k, "_b"], "left").withColumn("_p", every).drop("_parts")
    else:
        f, seen = f.withColumn("_p", F.lit(0).cast("long")), seen.withColumn("_p", F.lit(0).cast("long"))
    mixed = (f.select(*k, "_b", "_p", "_t", F.lit(0 if strict else 1).alias("_kind"), "_row", F.lit(None).cast(v.schema["_v"].dataType).alias("_v"))
             .unionByName(seen.select(*k, "_b", "_p", "_t", F.lit(1 if strict else 0).alias("_kind"), F.lit(None).cast(f.schema["_row"].dataType).alias("_row"), "_v")))
    upto = Window.partitionBy(*k, "_b", "_p").orderBy("_t", "_kind", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = mixed.withColumn("_v", F.last("_v", ignorenulls=True).over(upto)).where("_row IS NOT NULL").select("_row", "_t", "_v")
    if tolerance_seconds is not None:
        fresh = F.col("_t") - F.col("_v.u") <= tolerance_seconds * 1_000_000
        found = found.withColumn("_v", F.when(fresh, F.col("_v")))
    none = f_all.where(~usable).select("_row", "_t", F.lit(None).cast(v.schema["_v"].dataType).alias("_v"))
    taken = set(facts.columns)
    names = [f"v_{c}" if c in taken else c for c in (version_time, *carry)]
    return found.unionByName(none).select("_row.*", F.col("_v.t").alias(names[0]), *[F.col(f"_v.c{i}").alias(n) for i, n in enumerate(names[1:])])
