"""Dimension joins (J1, J2) with a measured broadcast decision.

The fact table (daily staffing) is the only large input.  A dimension is
broadcast only after one aggregate pass has measured its payload and found it
under the limit; otherwise the join is left to a shuffle (sort-merge), where
AQE's skew-join splitting copes with a facility that holds a large share of
the fact rows.  Broadcasting keeps the fact side unshuffled until the roll-up.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.functions.text import strip_zeros
from carelens.schemas import (
    CCN, CERTIFIED_BEDS, OVERALL_RATING, PROV_STATE, PROVNUM, ST_AVG_NURSE_HRS, ST_AVG_RESIDENTS, STATE_KEY,
)
from carelens.utils import q, qcol

DEFAULT_BROADCAST_MAX_BYTES = 256 * 1024 * 1024
BROADCAST_CONF = "carelens.broadcast.maxBytes"
# In-memory hash relations cost more than the raw payload.
_HASH_OVERHEAD = 2.0
_FIXED = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
          T.DoubleType: 8, T.BooleanType: 1, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8}


def _field_bytes_sql(f: T.StructField) -> str:
    c = q(f.name)
    for t, n in _FIXED.items():
        if isinstance(f.dataType, t):
            return str(n)
    if isinstance(f.dataType, (T.StringType, T.BinaryType)):
        return f"(coalesce(octet_length({c}), 0) + 8)"
    return f"coalesce(octet_length(to_json(struct({c}))), 0)"


def _size_agg(df: DataFrame, tag: int) -> DataFrame:
    row = " + ".join([_field_bytes_sql(f) for f in df.schema.fields] + ["16"])
    return df.selectExpr(f"CAST({row} AS BIGINT) AS _b").agg(
        F.lit(tag).alias("i"), F.coalesce(F.sum("_b"), F.lit(0)).alias("b"))


def measured_sizes(*dfs: DataFrame) -> list[int]:
    """Exact payload sizes of several frames in one job (one row back each)."""
    if not dfs:
        return []
    parts = [_size_agg(df, i) for i, df in enumerate(dfs)]
    both = reduce(lambda a, b: a.unionByName(b), parts)
    got = {r["i"]: int(r["b"]) for r in both.collect()}
    return [got.get(i, 0) for i in range(len(dfs))]


def measured_bytes(df: DataFrame) -> int:
    """Exact payload size of ``df`` (one aggregate pass, one row back)."""
    return measured_sizes(df)[0]


def broadcast_limit(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get(BROADCAST_CONF, None)
    return int(conf) if conf else DEFAULT_BROADCAST_MAX_BYTES


def bounded_broadcast(dim: DataFrame, strategy: str = "auto", max_bytes: int | None = None) -> DataFrame:
    """``broadcast(dim)`` when proven small, else a sort-merge join hint.

    strategy: 'auto' (measure), 'broadcast' (measure, and raise when it is too
    large), 'shuffle' (never broadcast).  The shuffle path carries a ``merge`` hint so
    that Spark's own estimate-based broadcast cannot override a failed check;
    AQE's skew-join splitting then handles a hot facility key.

    The measuring pass reads the pruned dimension once (facilities and states
    are small, so this is a few thousand rows); for a dimension known to be
    large, 'shuffle' skips that pass.
    """
    return bounded_broadcasts([dim], strategy, max_bytes)[0]


def bounded_broadcasts(dims, strategy: str = "auto", max_bytes: int | None = None) -> list[DataFrame]:
    """:func:`bounded_broadcast` for several dimensions, measured in one job."""
    if strategy == "shuffle":
        return [d.hint("merge") for d in dims]
    if not dims:
        return []
    limit = max_bytes if max_bytes is not None else broadcast_limit(dims[0])
    sizes = measured_sizes(*dims)
    if strategy == "broadcast" and any(n * _HASH_OVERHEAD > limit for n in sizes):
        raise ValueError(f"too large to broadcast: {sizes} bytes, limit {limit} / {_HASH_OVERHEAD}")
    return [F.broadcast(d) if n * _HASH_OVERHEAD <= limit else d.hint("merge") for d, n in zip(dims, sizes)]


# Private names for dimension columns, so nothing collides with s.* (e.g. the
# fact's STATE vs the provider's State, or both tables' ingest stamps).
P_KEY, P_STATE, P_BEDS, P_RATING = "_p_ccn", "_p_state", "_p_beds", "_p_rating"
S_KEY, S_RES, S_HRS = "_st_key", "_st_avg_residents", "_st_avg_nurse_hrs"


def provider_side(provider: DataFrame) -> DataFrame:
    """Only the four provider columns gold uses, under private names."""
    return provider.select(qcol(CCN).alias(P_KEY), qcol(PROV_STATE).alias(P_STATE),
                           qcol(CERTIFIED_BEDS).alias(P_BEDS), qcol(OVERALL_RATING).alias(P_RATING))


def state_side(state_avg: DataFrame) -> DataFrame:
    return state_avg.select(qcol(STATE_KEY).alias(S_KEY), qcol(ST_AVG_RESIDENTS).alias(S_RES),
                            qcol(ST_AVG_NURSE_HRS).alias(S_HRS))


def join_provider(fact: DataFrame, provider: DataFrame, normalize_fact_key: bool = False,
                  strategy: str = "auto", decided: bool = False) -> DataFrame:
    """staffing LEFT JOIN provider ON PROVNUM = CCN.

    By default the keys are compared as cleaned at bronze: the fact key is
    only stripped, the provider key also lost its leading zeros, so padded
    fact keys find no provider.  ``normalize_fact_key`` strips zeros on the
    fact side too, in the join condition only.  ``decided=True``: ``provider``
    is already :func:`provider_side` with its broadcast decision applied.
    """
    p = provider if decided else bounded_broadcast(provider_side(provider), strategy)
    fk = strip_zeros(F.col(PROVNUM)) if normalize_fact_key else F.col(PROVNUM)
    return fact.join(p, fk == F.col(P_KEY), "left")


def join_state(df: DataFrame, state_avg: DataFrame, strategy: str = "auto", decided: bool = False) -> DataFrame:
    """... LEFT JOIN state_avg ON provider.State = state_avg."State or Nation" (J2).

    ``decided=True``: ``state_avg`` is already :func:`state_side` with its
    broadcast decision applied (see :func:`carelens.plans.gold.gold`).
    """
    s = state_avg if decided else bounded_broadcast(state_side(state_avg), strategy)
    return df.join(s, F.col(P_STATE) == F.col(S_KEY), "left")
