"""Data-quality rules (D1) and their published outcomes.

Rules are tuples, evaluated together so data-based metrics cost one pass:

* ``("ColumnCount", op, n)``   -- schema only, no data read
* ``("RowCount", op, n)``
* ``("IsComplete", col)``      -- no NULL in ``col``
* ``("IsUnique", col)``        -- no key value twice (dimension keys, T12)

Outcomes never gate a write; they are returned / written as a table.
"""

from __future__ import annotations

import operator

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from carelens.utils import qcol

DEFAULT_RULES = (("ColumnCount", ">", 0),)
_OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "=": operator.eq,
        "==": operator.eq, "!=": operator.ne}
_SQL_OPS = {"==": "="}


def _rule_text(rule) -> str:
    if len(rule) > 2 and rule[0] in ("ColumnCount", "RowCount"):
        return f"{rule[0]} {_SQL_OPS.get(rule[1], rule[1])} {rule[2]}"
    return f'{rule[0]} "{rule[1]}"'


def check(df: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    """Evaluate ``rules`` on ``df`` -> ``rule, outcome, metric`` (one row each).

    All row-level metrics come from *one* aggregate over ``df`` (a single
    pass); each verdict is a struct computed from that one row and the rows
    are produced by exploding the array of verdicts, so the data is never
    read once per rule.  ``ColumnCount`` needs no data at all; each
    ``IsUnique`` adds one grouped pass (embedded as a scalar subquery).
    """
    spark = df.sparkSession
    ncols = len(df.columns)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    complete = [r[1] for r in rules if r[0] == "IsComplete"]
    aggs += [F.count(qcol(c)).alias(f"__nn_{i}") for i, c in enumerate(complete)]
    need_rows = any(r[0] in ("RowCount", "IsComplete") for r in rules)
    base = df.agg(*aggs) if need_rows else spark.range(1)

    def verdict(text, ok, metric):
        return F.struct(F.lit(text).alias("rule"),
                        F.when(ok, F.lit("Passed")).otherwise(F.lit("Failed")).alias("outcome"),
                        metric.cast("double").alias("metric"))

    verdicts = []
    for r in rules:
        kind, text = r[0], _rule_text(r)
        if kind == "ColumnCount":
            verdicts.append(verdict(text, F.lit(bool(_OPS[r[1]](ncols, r[2]))), F.lit(float(ncols))))
        elif kind == "RowCount":
            m = F.col("__rows")
            cond = {">": m > r[2], ">=": m >= r[2], "<": m < r[2], "<=": m <= r[2], "=": m == r[2],
                    "==": m == r[2], "!=": m != r[2]}[r[1]]
            verdicts.append(verdict(text, cond, m))
        elif kind == "IsComplete":
            nn = F.col(f"__nn_{complete.index(r[1])}")
            ratio = F.coalesce(F.try_divide(nn.cast("double"), F.col("__rows")), F.lit(1.0))
            verdicts.append(verdict(text, nn == F.col("__rows"), ratio))
        elif kind == "IsUnique":
            dups = (df.groupBy(qcol(r[1]).alias("_k")).count().filter(F.col("count") > 1)
                    .agg(F.count(F.lit(1)).alias("_dups"))).scalar()
            verdicts.append(verdict(text, dups == 0, dups))
        else:
            raise ValueError(f"unknown rule {r!r}")
    return base.select(F.explode(F.array(*verdicts)).alias("v")).select("v.rule", "v.outcome", "v.metric")


def check_each(df: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    """:func:`check`, best effort: a rule that cannot be evaluated gets the outcome ``Error`` (metric NULL) and the
    others keep theirs.  At most one row per rule is held by the driver."""
    spark = df.sparkSession
    try:
        rows = [tuple(r) for r in check(df, rules).collect()]
    except Exception:
        rows = []
        for rule in rules:
            try:
                rows += [tuple(r) for r in check(df, (rule,)).collect()]
            except Exception:
                rows.append((_rule_text(rule) if len(rule) > 1 else str(rule), "Error", None))
    return spark.createDataFrame(rows, "rule string, outcome string, metric double")


def observed(df: DataFrame, name: str = "gold_metrics", cols=()):
    """Attach row metrics computed *during* the next action (no extra pass).

    Returns ``(df_with_observation, observation)``; read ``observation.get``
    after the write.
    """
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")] + [F.count(qcol(c)).alias(f"non_null:{c}") for c in cols]
    return df.observe(obs, *exprs), obs


def publish(outcomes: DataFrame, path: str, mode: str = "append") -> None:
    """Write the outcome table beside the data (D2); best effort by design."""
    outcomes.withColumn("evaluated_at", F.localtimestamp()).write.mode(mode).parquet(path)
