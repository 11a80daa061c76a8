"""Roll-up, option lists, scaling, sort and top-k (A1-A5, O1, O2).

The roll-up is a hash aggregate with map-side partial aggregation: every task
emits at most one partial row per facility, so a facility owning a third of
the fact rows costs one partial row per task, not a hot shuffle partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.utils import q
from carelens.schemas import ROLLUP_KEYS, ROLLUP_MEASURES, TOPK_DEFAULT, TOPK_MAX, TOPK_MIN

_AGG = {"mean": "avg", "max": "max", "min": "min", "sum": "sum"}


def rollup(gold: DataFrame, keys=ROLLUP_KEYS, measures=ROLLUP_MEASURES) -> DataFrame:
    """Per-facility means of hours, census, occupancy, staff mix; max rating (A1).

    NULLs are skipped by every aggregate (NaN was turned into NULL when the
    gold table was loaded for the dashboard).
    """
    return gold.groupBy(*keys).agg(*[F.expr(f"{_AGG[how]}({q(m)}) AS {q(m)}") for m, how in measures])


def options(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-missing values of ``col``, sorted (A2-A4)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def sort_rollup(df: DataFrame, by: str = "Tot_Nurse_hrs", keys=ROLLUP_KEYS) -> DataFrame:
    """Descending on ``by``, missing last, keys as tie-break (O1)."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in keys])


def ranked(sorted_df: DataFrame, name: str = "rank") -> DataFrame:
    """A sorted frame's rows with their position from 1, without one task for all: the sort's partitions are kept by
    a checkpoint in the shared folder, and each row's number in its partition is added to the sizes before it."""
    from carelens.session import checkpoint_root

    checkpoint_root(sorted_df.sparkSession)
    kept = sorted_df.checkpoint()
    placed = kept.withColumn("_id", F.monotonically_increasing_id())
    placed = placed.withColumns({"_part": F.shiftrightunsigned("_id", 33), "_at": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per partition
    before, total = {}, 0
    for r in sorted(sizes, key=lambda r: r["_part"]):
        before[r["_part"]], total = total, total + r["n"]
    if not before:
        return kept.withColumn(name, F.lit(0).cast("long"))
    offsets = F.create_map(*[F.lit(x).cast("long") for pair in before.items() for x in pair])
    return placed.withColumn(name, offsets[F.col("_part")] + F.col("_at") + 1).drop("_id", "_part", "_at")


def check_k(k: int) -> int:
    if not isinstance(k, int) or not TOPK_MIN <= k <= TOPK_MAX:
        raise ValueError(f"k must be an integer in [{TOPK_MIN}, {TOPK_MAX}], got {k!r}")
    return k


def topk(df: DataFrame, k: int = TOPK_DEFAULT, by: str = "Tot_Nurse_hrs", keys=ROLLUP_KEYS) -> DataFrame:
    """First ``k`` rows of :func:`sort_rollup` (O2): a bounded top-k heap per
    task (``TakeOrderedAndProject``), never a full sort."""
    return sort_rollup(df, by, keys).limit(check_k(k))


def minmax_scale(df: DataFrame, cols, suffix: str = "_scaled", bounded: bool = False) -> DataFrame:
    """(x - min) / (max - min) per column over ``df`` (A5).

    Missing stays missing; a flat column scales to 0.

    * general input: all extremes come from one aggregate, used as a single
      struct-valued scalar subquery (one extra distributed pass, no join,
      nothing collected);
    * ``bounded=True`` -- only for a top-k view (k <= 100, already one partition
      after the top-k): the extremes are a window over the whole frame, so the
      input is computed once.  The plan itself checks the bound: it takes
      TOPK_MAX + 1 rows at most, and that many are an error.
    """
    if bounded:
        whole = Window.partitionBy()
        df = df.limit(TOPK_MAX + 1)
        over = F.count(F.lit(1)).over(whole) > TOPK_MAX
        df = df.withColumn("_over", F.when(over, F.raise_error(F.lit("more rows than a top-k view has")).cast("boolean"))
                           .otherwise(F.lit(False))).filter(~F.col("_over")).drop("_over")
        los = [F.min(c).over(whole).cast("double") for c in cols]
        his = [F.max(c).over(whole).cast("double") for c in cols]
    else:
        e = _extremes(df, cols)
        los = [e.getField(f"lo{i}") for i in range(len(cols))]
        his = [e.getField(f"hi{i}") for i in range(len(cols))]
    out = {}
    for c, lo, hi in zip(cols, los, his):
        x = F.col(c).cast("double")
        span = hi - lo
        scaled: Column = F.when(x.isNull(), F.lit(None).cast("double")) \
            .when(span == 0, F.lit(0.0)) \
            .otherwise((x - lo) / span)
        out[c + suffix] = scaled
    return df.withColumns(out)


def _extremes(df: DataFrame, cols) -> Column:
    ext = df.agg(F.struct(*[F.min(c).cast("double").alias(f"lo{i}") for i, c in enumerate(cols)],
                          *[F.max(c).cast("double").alias(f"hi{i}") for i, c in enumerate(cols)]).alias("e"))
    return ext.scalar()
