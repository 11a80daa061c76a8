"""Projection, schema mapping and stamping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.schemas import INGESTED_AT
from carelens.utils import q, qcol


def require_columns(df: DataFrame, cols) -> None:
    """Raise when any of ``cols`` is not in ``df`` (listing all missing names)."""
    have = set(df.columns)
    missing = [c for c in cols if c not in have]
    if missing:
        raise ValueError(f"columns not found: {missing}")


def retain(df: DataFrame, cols) -> DataFrame:
    """Keep exactly ``cols`` in list order (P1/P2); a missing name raises."""
    require_columns(df, cols)
    return df.selectExpr(*[q(c) for c in cols])


def retain_all(df: DataFrame) -> DataFrame:
    """Keep every column."""
    return df.select("*")


def apply_mapping(df: DataFrame, mappings) -> DataFrame:
    """(source, source type, target, target type) mapping.

    Listed sources are cast and renamed; unlisted input columns and listed
    sources absent from the input are dropped.
    """
    have = set(df.columns)
    out = []
    for src, _src_t, dst, dst_t in mappings:
        name = src.strip("`")
        if name in have:
            out.append(qcol(name).cast(dst_t).alias(dst.strip("`")))
    return df.select(*out)


def identity_mapping(cols, dtype: str = "string"):
    """A mapping keeping ``cols`` unchanged as ``dtype``."""
    return [(c, dtype, c, dtype) for c in cols]


def ingest_ts(ts=None) -> Column:
    """Naive (no time zone) ingest time: ``ts`` if given, else now."""
    if ts is None:
        return F.localtimestamp()
    return F.to_timestamp_ntz(F.lit(str(ts)))


def stamp(df: DataFrame, ts=None, col: str = INGESTED_AT) -> DataFrame:
    """One ingest timestamp for the whole table."""
    return df.withColumn(col, ingest_ts(ts))
