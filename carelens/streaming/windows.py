"""Event-time windows over landed files, with state bounded by a watermark.

A run (``trigger(availableNow=True)``) takes the files that landed since the last one.  Rows may come out of order; a
row is late when its window (or the session it would open) ended at or before the watermark: the latest event time of
earlier batches less ``delay``.  Late rows are left out, and everything at or before the watermark has left the state,
so the state holds open windows only, however long the stream runs.

Two ways to emit:

- ``emit="final"``: a window is written once, when the watermark passes its end (append mode; the parquet sink's commit
  log makes each batch exactly-once).
- ``emit="changes"``: every batch writes the new totals of the windows it touched to a folder of its own, which a
  replayed batch overwrites; :func:`current_windows` takes the last total of each.  This shows open windows too, and
  what the windows hold against what landed gives the late rows (:func:`late_rows`).

A rerun after a lost driver or executor continues from the checkpoint and gives the same table.  The number of state
partitions is fixed by a stream's first run (``partitions``); ``rocksdb`` keeps the state on the executors' disks
instead of their heaps, for many open windows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.streaming.incremental import MAX_FILE_AGE, PROGRESS_CONF, PROGRESS_KEPT

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_CONF, PARTITIONS_CONF = "spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions"
BATCH = "batch_id"


@dataclass(frozen=True)
class Windows:
    """Tumbling (``every``), sliding (``every`` and ``slide``) or session windows (``gap``) of rows with equal ``keys``.

    ``aggs`` are the columns of a window: pairs of name and SQL aggregate.  Rows without a time belong to no window.
    """
    keys: tuple[str, ...]
    aggs: tuple[tuple[str, str], ...]
    time: str = "ts"
    every: str | None = None
    slide: str | None = None
    gap: str | None = None

    def __post_init__(self):
        if (self.every is None) == (self.gap is None) or (self.slide and not self.every):
            raise ValueError("give every (and slide), or gap")

    @property
    def names(self) -> list[str]:
        return ["window_start", "window_end", *self.keys]

    def of(self, events: DataFrame, delay: str | None = None) -> DataFrame:
        """The windows of a table, or of a stream with the watermark's ``delay``.  Local times stay local times."""
        kind = events.schema[self.time].dataType.simpleString()
        events = events.withColumn(self.time, F.col(f"`{self.time}`").cast("timestamp"))  # a watermark needs instants
        events = events.withWatermark(self.time, delay) if delay else events
        if self.gap:
            span: Column = F.session_window(self.time, self.gap)
        elif self.slide:
            span = F.window(self.time, self.every, self.slide)
        else:
            span = F.window(self.time, self.every)
        timed = events.where(F.col(self.time).isNotNull())
        found = timed.groupBy(span.alias("_w"), *[F.col(f"`{k}`") for k in self.keys]).agg(*[F.expr(e).alias(n) for n, e in self.aggs])
        return found.select(F.col("_w.start").cast(kind).alias("window_start"), F.col("_w.end").cast(kind).alias("window_end"),
                            *[F.col(f"`{c}`") for c in (*self.keys, *[n for n, _ in self.aggs])])


@dataclass(frozen=True)
class Run:
    """What a run took and left: input rows, the last watermark (None before the first data), windows in the state and
    the batches it ran."""
    rows: int
    watermark: str | None
    open_windows: int
    batches: int


@contextmanager
def _conf(spark: SparkSession, values: dict[str, str | None]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k, v in values.items() if v is not None}
    try:
        for k in before:
            spark.conf.set(k, values[k])
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def run_windows(spark: SparkSession, source: str, sink: str, checkpoint: str, schema, windows: Windows, delay: str,
                emit: str = "final", fmt: str = "parquet", max_files_per_trigger: int = 1000, partitions: int | None = None,
                rocksdb: bool = False, transform=None) -> Run:
    """Take what landed in ``source`` since the last run; write windows to ``sink``."""
    if emit not in ("final", "changes"):
        raise ValueError(f"emit {emit!r}")
    stream = (spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .option("maxFileAge", MAX_FILE_AGE).load(source))
    if transform is not None:
        stream = transform(stream)
    found = windows.of(stream, delay)
    writer = found.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if emit == "final":
        writer = writer.format("parquet").option("path", sink).outputMode("append")
    else:
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/{BATCH}={batch_id}")

        writer = writer.foreachBatch(write).outputMode("update")
    values = {PROGRESS_CONF: str(PROGRESS_KEPT), PROVIDER_CONF: ROCKSDB if rocksdb else None,
              PARTITIONS_CONF: str(partitions) if partitions else None}
    with _conf(spark, values):
        query = writer.start()
        query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    progress = query.recentProgress
    marks = [p["eventTime"]["watermark"] for p in progress if "watermark" in p.get("eventTime", {})]
    state = [o["numRowsTotal"] for p in progress[-1:] for o in p["stateOperators"]]
    mark = marks[-1] if marks and not marks[-1].startswith("1970-01-01T00:00:00") else None
    return Run(sum(p["numInputRows"] for p in progress), mark, sum(state), len(progress))


def final_windows(spark: SparkSession, sink: str, windows: Windows) -> DataFrame:
    """What ``emit="final"`` wrote: windows that the watermark has passed."""
    return spark.read.parquet(sink).select(*windows.names, *[n for n, _ in windows.aggs])


def current_windows(spark: SparkSession, sink: str, windows: Windows) -> DataFrame:
    """What ``emit="changes"`` wrote last of each window, open or closed.  One aggregate; a window that changed in many
    batches is combined in the tasks before the shuffle.  Sessions move as they merge and have no such table."""
    if windows.gap:
        raise ValueError("sessions merge, so an earlier total is no longer a session; use emit='final'")
    names = [n for n, _ in windows.aggs]
    changes = spark.read.parquet(sink)
    last = changes.groupBy(*windows.names).agg(F.max_by(F.struct(*names), BATCH).alias("_last"))
    return last.select(*windows.names, *[F.col(f"_last.`{n}`").alias(n) for n in names])


def late_rows(landed: DataFrame, current: DataFrame, windows: Windows, count: str = "n") -> DataFrame:
    """By the keys: ``landed`` rows (with a time), ``on_time`` and ``late``, from tumbling windows whose ``count`` column
    counts rows.  Whatever landed and is in no window was late."""
    if windows.slide or windows.gap:
        raise ValueError("a row is in one tumbling window; of sliding windows it may be late for some only")
    timed = landed.where(F.col(windows.time).isNotNull()).groupBy(*windows.keys).agg(F.count(F.lit(1)).alias("landed"))
    kept = current.groupBy(*windows.keys).agg(F.sum(count).alias("_kept"))
    on = [F.col(f"l.`{k}`").eqNullSafe(F.col(f"k.`{k}`")) for k in windows.keys]
    joined = timed.alias("l").join(kept.alias("k"), on or F.lit(True), "left")
    on_time = F.coalesce("_kept", F.lit(0)).cast("long")
    return joined.select(*[F.col(f"l.`{k}`") for k in windows.keys], "landed", on_time.alias("on_time"),
                         (F.col("landed") - on_time).alias("late"))
