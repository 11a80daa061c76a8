"""Sinks (K1-K3) and snapshot folders.

No sink funnels the table through one task: single-file output (``coalesce(1)``)
is replaced by *snapshots* -- one ``run_id=...`` folder per run, read back whole
by :func:`carelens.sources.discovery.read_latest`.  File sizes are bounded with
``maxRecordsPerFile`` rather than by the number of writer tasks.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CSV_WRITE = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    # Spark's writer trims blanks by default; pandas keeps them.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


# Folder names of a partitioned table are text that Spark would read back as numbers, and cannot hold a blank.  So the
# column stays in the files and the folders are named by this copy of it, which begins with a letter.
PART = "part_"


def with_parts(df: DataFrame, cols) -> tuple[DataFrame, list[str]]:
    return df.withColumns({PART + c: F.concat(F.lit("k"), F.col(f"`{c}`").cast("string")) for c in cols}), [PART + c for c in cols]


def without_parts(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(PART)])


def in_part(df: DataFrame, col: str, value: str) -> DataFrame:
    """Rows of one key; of a table partitioned by it, only that key's folder is read."""
    df = df.filter(F.col(f"`{col}`") == F.lit(value))
    return df.filter(F.col(PART + col) == F.lit(f"k{value}")) if PART + col in df.columns else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by=(),
              max_records_per_file: int | None = None, compression: str | None = None) -> None:
    w = df.write.mode(mode).options(**_CSV_WRITE)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def write_bronze(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Bronze sink (K1): full overwrite of one table folder."""
    if fmt == "csv":
        write_csv(df, path, mode="overwrite")
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def write_gold(df: DataFrame, path: str, partition_by=(), mode: str = "append", fmt: str = "parquet",
               max_records_per_file: int | None = 5_000_000, rebalance: bool = True) -> None:
    """Gold sink (K2): many files, appended, optionally partitioned.

    Unpartitioned (the default, as in the source job): no shuffle, one file
    per task (split at ``max_records_per_file``).

    With ``partition_by`` and ``rebalance=True``: rows are rebalanced on the
    keys first (one shuffle), so each key's rows land in few, well-sized
    files; AQE splits a hot key (a state with a third of all rows) over many
    tasks and merges small ones.  Without it every scan task would write one
    file per key it holds (tasks x keys small files).  ``rebalance=False``
    skips the shuffle and only sorts within tasks.  The folders are named by
    ``part_`` columns (see :data:`PART`); :func:`in_part` reads one of them.
    """
    if partition_by:
        df, partition_by = with_parts(df, partition_by)
        df = df.hint("rebalance", *partition_by) if rebalance else df
        df = df.sortWithinPartitions(*partition_by)
    if fmt == "csv":
        write_csv(df, path, mode=mode, partition_by=partition_by, max_records_per_file=max_records_per_file)
        return
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def new_run_id() -> str:
    return time.strftime("%Y%m%dT%H%M%S", time.gmtime()) + f"{time.time() % 1:.6f}"[1:] + "-" + uuid.uuid4().hex[:8]


COMMITTED = "_committed"


def write_snapshot(df: DataFrame, root: str, run_id: str | None = None, fmt: str = "parquet",
                   partition_by=(), max_records_per_file: int | None = 5_000_000, before_commit=None) -> str:
    """Gold sink, one snapshot per run (K3 re-aimed); returns the folder.

    Only after the data write has committed is the run appended to the
    hidden ``_committed`` table under ``root``; readers take the newest
    committed run, so a run that died half-way is never read.
    ``before_commit(folder, run_id)`` writes what belongs to the snapshot.
    """
    rid = run_id or new_run_id()
    folder = f"{root.rstrip('/')}/run_id={rid}"
    write_gold(df, folder, partition_by=partition_by, mode="errorifexists", fmt=fmt,
               max_records_per_file=max_records_per_file)
    if before_commit:
        before_commit(folder, rid)
    spark = df.sparkSession
    (spark.createDataFrame([(rid, folder, fmt)], "run_id string, folder string, format string")
     .withColumn("committed_at", F.localtimestamp())
     .write.mode("append").parquet(f"{root.rstrip('/')}/{COMMITTED}"))
    return folder
