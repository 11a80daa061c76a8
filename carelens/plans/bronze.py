"""Bronze pipelines (B1-B3): landing table -> cleaned, retained, stamped.

Missing-token normalisation runs after retention, so it touches only the
kept columns; all steps are narrow (no shuffle) and fuse into one codegen
stage with the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions.text import strip_sql, strip_zeros_sql, to_text_sql, upper_sql
from carelens.operators.projection import require_columns, retain_all, stamp
from carelens.schemas import CCN, PROVIDER_INFO_COLS, PROVNUM, STATE_AVG_COLS, STATE_KEY
from carelens.sources.csv import normalize_missing
from carelens.utils import q


def _finish(df: DataFrame, ts, stamped: bool) -> DataFrame:
    return stamp(df, ts) if stamped else df


def bronze_provider(landing: DataFrame, ts=None, stamped: bool = True) -> DataFrame:
    """B1: retain 63 columns, key stripped of blanks and leading zeros."""
    require_columns(landing, PROVIDER_INFO_COLS)
    df = normalize_missing(landing, keep=PROVIDER_INFO_COLS)  # P1 + S3 in one projection
    df = df.withColumn(CCN, F.expr(strip_zeros_sql(strip_sql(q(CCN)))))
    return _finish(df, ts, stamped)


def bronze_state(landing: DataFrame, ts=None, stamped: bool = True) -> DataFrame:
    """B2: retain 42 columns, join key as stripped upper-case text."""
    require_columns(landing, STATE_AVG_COLS)
    df = normalize_missing(landing, keep=STATE_AVG_COLS)  # P2 + S3 in one projection
    df = df.withColumn(STATE_KEY, F.expr(upper_sql(strip_sql(to_text_sql(q(STATE_KEY))))))
    return _finish(df, ts, stamped)


def bronze_staffing(landing: DataFrame, ts=None, stamped: bool = True) -> DataFrame:
    """Keep every column, key stripped of blanks (zeros stay)."""
    df = normalize_missing(retain_all(landing))
    df = df.withColumn(PROVNUM, F.expr(strip_sql(to_text_sql(q(PROVNUM)))))
    return _finish(df, ts, stamped)
