"""Source discovery (S4) and newest-snapshot reads.

The listing is a distributed ``binaryFile`` scan projected to metadata only,
so file contents are never read.  Only one path (the chosen snapshot) ever
reaches the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str, name_contains: str | None = None,
               min_size: int = 1, glob: str | None = None) -> DataFrame:
    """Files under ``path`` (recursive) as ``path, name, folder, modificationTime, length``.

    Keeps names containing ``name_contains`` and at least ``min_size`` bytes,
    and skips Spark's bookkeeping files (``_SUCCESS``, ``.crc``) by default.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = (r.load(path)
             .select("path", "modificationTime", "length")
             .withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))
             # partition folders (key=value) below a snapshot belong to it
             .withColumn("folder", F.coalesce(
                 F.nullif(F.regexp_extract("path", r"^(.*/run_id=[^/]+)/", 1), F.lit("")),
                 F.regexp_replace(F.regexp_extract("path", r"^(.*)/[^/]+$", 1), r"(/[^/=]+=[^/]*)+$", ""))))
    files = files.filter(~F.col("name").startswith("_") & ~F.col("name").startswith("."))
    if name_contains:
        files = files.filter(F.col("name").contains(name_contains))
    if min_size:
        files = files.filter(F.col("length") >= min_size)
    return files


def _committed_latest(spark: SparkSession, path: str, name_contains: str | None, min_size: int) -> str | None:
    """The run committed last (see ``write_snapshot``), if any; with a name or size rule, of those that hold such a
    file.  The commit time decides: run ids are names."""
    from pyspark.errors import AnalysisException

    from carelens.sources.sinks import COMMITTED
    try:
        runs = spark.read.parquet(f"{path.rstrip('/')}/{COMMITTED}")
    except AnalysisException:
        return None
    if name_contains or min_size > 1:
        run = F.regexp_extract("folder", r"run_id=([^/]+)", 1)
        kept = list_files(spark, path, name_contains, min_size).select(run.alias("run_id")).distinct()
        runs = runs.join(kept, "run_id", "left_semi")
    row = runs.agg(F.max_by("folder", F.struct("committed_at", "run_id")).alias("folder")).first()
    return None if row is None else row["folder"]


def committed_snapshots(spark: SparkSession, path: str, last: int | None = None) -> list[str]:
    """Folders of the committed runs below ``path``, the one committed last first (one short text per run)."""
    from pyspark.errors import AnalysisException

    from carelens.sources.sinks import COMMITTED
    try:
        runs = spark.read.parquet(f"{path.rstrip('/')}/{COMMITTED}")
    except AnalysisException:
        return []
    runs = runs.orderBy(F.desc("committed_at"), F.desc("run_id"))
    return [r["folder"] for r in (runs.limit(last) if last else runs).select("folder").collect()]


def latest_snapshot_path(spark: SparkSession, path: str, name_contains: str | None = None,
                         min_size: int = 1, committed_only: bool = True) -> str:
    """Folder of the newest snapshot below ``path``.

    Snapshots written by :func:`carelens.sources.sinks.write_snapshot` are
    chosen from its commit table (the run committed last).  Otherwise:

    A snapshot is the ``run_id=...`` folder written by :func:`write_snapshot`
    (or, for other layouts, the folder holding the files); its age is the newest file
    in it, ties broken by folder name.  Raises FileNotFoundError when no file
    qualifies (the reference's missing-partition error).
    """
    if committed_only:
        folder = _committed_latest(spark, path, name_contains, min_size)
        if folder is not None:
            return folder
    files = list_files(spark, path, name_contains, min_size)
    newest = (files.groupBy("folder").agg(F.max("modificationTime").alias("ts"))
              .agg(F.max_by("folder", F.struct("ts", "folder")).alias("folder")))
    row = newest.first()
    if row is None or row["folder"] is None:
        raise FileNotFoundError(f"no data files under {path}")
    return row["folder"]


def read_latest(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
                name_contains: str | None = None, parts: bool = False, **options) -> DataFrame:
    """Read every file of the newest snapshot (not just one part file).  ``parts`` keeps the ``part_`` columns that
    name the folders of a partitioned snapshot, for filters that prune them."""
    from carelens.sources.sinks import without_parts

    folder = latest_snapshot_path(spark, path, name_contains)
    r = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        from carelens.sources.csv import _CSV_OPTS
        r = r.options(**_CSV_OPTS)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(folder)
    return df if parts else without_parts(df)


def read_discovered(spark: SparkSession, path: str, name_contains: str | None = None, min_size: int = 1,
                    fmt: str = "csv", schema=None, **options) -> DataFrame:
    """Read only the files discovery keeps (S4): name holds ``name_contains``,
    size at least ``min_size``.  Raises FileNotFoundError when none qualifies.

    Both rules are filters on the scan's ``_metadata`` column, which Spark
    applies to files before it opens them.
    """
    if list_files(spark, path, name_contains, min_size).isEmpty():
        raise FileNotFoundError(f"no data files under {path} matching {name_contains!r}")
    r = spark.read.format(fmt).option("recursiveFileLookup", "true").options(**options)
    if fmt == "csv":
        from carelens.sources.csv import _CSV_OPTS
        r = r.options(**_CSV_OPTS)
    if schema is None:  # from a file that the rules keep
        first = list_files(spark, path, name_contains, min_size).orderBy("path").select("path").first()["path"]
        first = re.sub(r"([\\\[\]{}*?])", r"\\\1", first)  # the name, not a pattern
        one = spark.read.format(fmt).options(**options)
        schema = (one.options(**_CSV_OPTS) if fmt == "csv" else one).load(first).schema
    df = r.schema(schema).load(path)
    cols = list(df.columns)
    if name_contains:
        # the metadata column holds the name as in a URL
        name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
        df = df.filter(F.contains(name, F.lit(name_contains)))
    if min_size:
        df = df.filter(F.col("_metadata.file_size") >= min_size)
    return df.select(*[F.col(f"`{c}`") for c in cols])
