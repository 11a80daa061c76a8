"""Differences of two snapshots: as multisets of rows, and by key (added, changed, removed).

Rows of both sides are counted together in one aggregate: equal rows are combined in the tasks, so a row that is repeated a
million times is one row per task in the one exchange, and nulls equal nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OLD, NEW = "n_old", "n_new"


def counted(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every distinct row of either side, with how often each side has it (``n_old``, ``n_new``)."""
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    if {OLD, NEW} & set(old.columns):
        raise ValueError(f"a column is named {OLD} or {NEW}")
    both = old.withColumns({OLD: F.lit(1), NEW: F.lit(0)}).unionByName(new.withColumns({OLD: F.lit(0), NEW: F.lit(1)}))
    return both.groupBy(*[F.col(f"`{c}`") for c in old.columns]).agg(F.sum(OLD).alias(OLD), F.sum(NEW).alias(NEW))


def _times(df: DataFrame, n) -> DataFrame:
    """Each row as often as ``n`` says."""
    kept = [c for c in df.columns if c not in (OLD, NEW)]
    rows = df.withColumn("_n", n).where("_n > 0").withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return rows.select(*[F.col(f"`{c}`") for c in kept])


def except_all(new: DataFrame, old: DataFrame) -> DataFrame:
    """The rows of ``new``, each as much more often as it has it than ``old``."""
    return _times(counted(old, new), F.col(NEW) - F.col(OLD))


def intersect_all(new: DataFrame, old: DataFrame) -> DataFrame:
    """The rows that both sides have, as often as the side that has them less often."""
    return _times(counted(old, new), F.least(NEW, OLD))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key whose rows differ: keys, ``change`` (added, removed, changed), ``old`` and ``new`` (the rows that only
    that side has, or has more often: sorted arrays of structs with ``n``, how many more).

    Null keys are a key like others.  Only rows that differ are dealt by key; a key's differing rows are one result row.
    """
    rest = [c for c in old.columns if c not in keys]
    differ = counted(old, new).where(F.col(OLD) != F.col(NEW))
    # a key that one side lacks has differing rows only, and none of them on that side; one that both have may keep others
    has = counted(old.select(*keys), new.select(*keys)).select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keys)], OLD, NEW)
    one = F.struct(*[F.col(f"`{c}`") for c in rest], F.abs(F.col(NEW) - F.col(OLD)).alias("n"))
    grouped = differ.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(
        F.sort_array(F.collect_list(F.when(F.col(OLD) > F.col(NEW), one))).alias("old"),
        F.sort_array(F.collect_list(F.when(F.col(NEW) > F.col(OLD), one))).alias("new"))
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_k{i}"))
    change = F.when(F.col(OLD) == 0, "added").when(F.col(NEW) == 0, "removed").otherwise("changed")
    return grouped.join(has, same).select(*[F.col(f"`{c}`") for c in keys], change.alias("change"), "old", "new")
