"""Dashboard filters.

Each filter is bypassed when its value is None (the "All ..." choice).  The
chain is plain ``filter`` calls, which Catalyst merges and pushes below the
roll-up and, on a stored gold table, into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.schemas import PROVNAME, PROVNUM, STATE


def _eq(df: DataFrame, col: str, value) -> DataFrame:
    return df if value is None else df.filter(F.col(col) == F.lit(value))


def by_state(df: DataFrame, value: str | None = None) -> DataFrame:
    """F1."""
    return _eq(df, STATE, value)


def by_provnum(df: DataFrame, value: str | None = None) -> DataFrame:
    """F2."""
    return _eq(df, PROVNUM, value)


def by_provname(df: DataFrame, value: str | None = None) -> DataFrame:
    """F3."""
    return _eq(df, PROVNAME, value)


def cascade(df: DataFrame, state: str | None = None, provnum: str | None = None,
            provname: str | None = None) -> DataFrame:
    """F1 -> F2 -> F3."""
    return by_provname(by_provnum(by_state(df, state), provnum), provname)


def is_empty(df: DataFrame) -> bool:
    """stops at the first row found."""
    return df.isEmpty()


def empty_check(df: DataFrame) -> DataFrame:
    """F6 as a one-row frame: ``is_empty``, ``warning`` (NULL when rows exist).

    A single ``LIMIT 1`` probe, so the check costs one row, not a count.
    """
    probe = df.limit(1).agg(F.count(F.lit(1)).alias("_n"))
    return probe.select(
        (F.col("_n") == 0).alias("is_empty"),
        F.when(F.col("_n") == 0, F.lit("No facility matches this combination of filters.")).alias("warning"),
    )
