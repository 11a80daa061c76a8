"""Helpers the operators share: text columns, Arrow batches as numpy bytes, written intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.session import checkpoint_root

#: A piece of a batch that a task works on at once, in bytes of text (a single longer text is a piece of its own).
PIECE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold_of(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.expr(f"crc32(cast(coalesce(cast({doc_id} as string), '') as binary)) % {n}")


#: The folder of the run that is open, if any (see `scratch_run`).
_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder below the one that spark.checkpoint.dir names, or below the open run's."""
    return "/".join([_RUN.get() or f"{checkpoint_root(spark)}/llm", *parts, uuid.uuid4().hex])


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """df as a table written to the shared folder (or to `path`): cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = path or shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables through the file system that it is in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch_run(spark: SparkSession):
    """The intermediate tables that operators write inside are in one folder, which goes at the end; results must have been
    written or collected by then. Operators return frames that read these tables, so they can't drop them themselves."""
    folder = f"{checkpoint_root(spark)}/llm/run-{uuid.uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        drop_folder(spark, folder)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The offsets and UTF-8 bytes of a string or binary column without nulls."""
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return off - off[0] if len(off) else np.zeros(1, np.int64), raw[off[0] : off[-1]] if len(off) else raw[:0]


def pieces(batches, text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most `limit` bytes of the text column, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        off, _ = text_bytes(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(off, off[start] + limit, side="right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def blank_null(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of a uint64 over all others (murmur3's constants)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(33))
        x = x * np.uint64(0xFF51AFD7ED558CCD)
        x = x ^ (x >> np.uint64(33))
        x = x * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))
