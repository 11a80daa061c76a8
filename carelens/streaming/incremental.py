"""Incremental ingest (S6): each run processes only files not seen before.

A file-source stream with ``trigger(availableNow=True)`` and a checkpoint in
the shared folder is the bookmark: the checkpoint's file log records what was
read, the parquet sink's commit log makes each batch exactly-once, so a
re-run after a lost executor or driver neither drops nor doubles rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# A landed file is taken whatever its date: Spark's default forgets files a week older than the newest one seen, which
# loses back-filled extracts that keep their dates.  The price is that the source remembers every file name.
MAX_FILE_AGE = "100000d"
# Progress records kept per run: the row count is their sum (Spark keeps 100 by default).
PROGRESS_CONF, PROGRESS_KEPT = "spark.sql.streaming.numRecentProgressUpdates", 1_000_000


def ingest_incremental(spark: SparkSession, source: str, sink: str, checkpoint: str, schema,
                       fmt: str = "parquet", transform=None, max_files_per_trigger: int = 1000,
                       source_options: dict | None = None, sink_format: str = "parquet",
                       partition_by=()) -> int:
    """Run one incremental pass; return the number of new input rows.

    ``transform`` (DataFrame -> DataFrame) must be stateless (e.g. a bronze
    step).  Batches are capped at ``max_files_per_trigger`` files, so a large
    backlog is taken in several bounded micro-batches.
    """
    reader = (spark.readStream.format(fmt).schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger).option("maxFileAge", MAX_FILE_AGE))
    if fmt == "csv":
        from carelens.sources.csv import _CSV_OPTS
        reader = reader.options(**_CSV_OPTS).option("enforceSchema", "false")
    reader = reader.options(**(source_options or {}))
    stream: DataFrame = reader.load(source)
    if transform is not None:
        stream = transform(stream)
    w = (stream.writeStream.format(sink_format)
         .option("checkpointLocation", checkpoint)
         .option("path", sink)
         .outputMode("append")
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    before = spark.conf.get(PROGRESS_CONF, None)
    spark.conf.set(PROGRESS_CONF, str(PROGRESS_KEPT))
    try:
        query = w.start()
        query.awaitTermination()
    finally:
        spark.conf.set(PROGRESS_CONF, before) if before else spark.conf.unset(PROGRESS_CONF)
    if query.exception() is not None:
        raise query.exception()
    progress = query.recentProgress
    if len(progress) >= PROGRESS_KEPT:
        raise RuntimeError(f"{len(progress)} batches in one run: all rows are ingested, but they are not counted")
    return int(sum(p.get("numInputRows", 0) for p in progress))


def gold_incremental(spark: SparkSession, staffing_source: str, provider: DataFrame, state_avg: DataFrame,
                     sink: str, checkpoint: str, staffing_schema, fmt: str = "parquet",
                     normalize_fact_key: bool = False, max_files_per_trigger: int = 1000) -> int:
    """Gold for new staffing files only (S6 applied to the gold job's sources).

    Each micro-batch of newly landed bronze staffing files goes through the
    same plan as the batch gold job: a stream-static LEFT join with the
    provider and state tables (measured, and broadcast when small), then the
    metric projection, appended to ``sink``.  Returns the new fact rows.
    """
    from carelens.plans.gold import gold

    def to_gold(stream: DataFrame) -> DataFrame:
        return gold(stream, provider, state_avg, normalize_fact_key=normalize_fact_key)

    return ingest_incremental(spark, staffing_source, sink, checkpoint, staffing_schema, fmt=fmt,
                              transform=to_gold, max_files_per_trigger=max_files_per_trigger)
