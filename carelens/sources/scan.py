"""Scan parallelism, only when asked for.

A parquet row group (or a gzip CSV) is never split, so an input of one big row
group keeps one core busy.  ``carelens.scan.partitions`` spreads such a scan's
rows over that many partitions; it is unset by default, and then no plan gets
an exchange or reads a further column.  It is for single-file inputs on one
machine: a large input has splits enough.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

SCAN_PARTITIONS = "carelens.scan.partitions"


def spread(df: DataFrame) -> DataFrame:
    """``df``, over ``carelens.scan.partitions`` partitions if that is set."""
    n = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(n)) if n and not df.isStreaming else df
