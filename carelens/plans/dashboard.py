"""Dashboard pipeline (B5): gold -> typed keys/measures -> filters -> roll-up -> top-k.

Only the nine columns the dashboard uses are read from gold (the scan is
pruned), filters sit below the aggregate, the aggregate is partial+final, and
the top-k is a bounded per-task heap; at most k rows reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions.numeric import coerce_numeric
from carelens.functions.text import strip_sql, to_text_sql, upper_sql
from carelens.operators.aggregate import options, rollup, topk
from carelens.operators.filters import by_provnum, by_state, cascade
from carelens.schemas import (
    PROVNAME, PROVNUM, ROLLUP_MEASURES, STATE, TOPK_DEFAULT, TOPK_MAX, VIEW_HOURS_CENSUS, VIEW_OCCUPANCY, VIEW_RATING,
    VIEW_STAFF_MIX, VIEW_TABLE,
)
from carelens.sources.sinks import PART
from carelens.utils import q


DASH_STATE = "dash_state"


def state_key_sql(render: str | None = "nan") -> str:
    """The dashboard's state key: text, upper-cased, stripped."""
    return strip_sql(upper_sql(to_text_sql(q(STATE), render)))


def load_for_dashboard(gold: DataFrame, missing_key: str = "nan") -> DataFrame:
    """Keys as stripped text (state upper-cased), six measures as numbers.

    ``missing_key='nan'`` renders a missing key as 'nan' ('NAN' for state), as
    the pandas text conversion does, so such rows stay in the roll-up;
    ``'drop'`` removes rows with a missing key instead.  One projection.
    """
    if missing_key not in ("nan", "drop"):
        raise ValueError("missing_key must be 'nan' or 'drop'")
    render = "nan" if missing_key == "nan" else None
    # A gold table written with partition_by_state names its folders by the
    # cleaned state key; using that lets a state filter prune files.
    if PART + DASH_STATE in gold.columns and missing_key == "nan":
        state_key = f"substring({q(PART + DASH_STATE)}, 2) AS {STATE}"
    else:
        state_key = f"{state_key_sql(render)} AS {STATE}"
    keys = [
        f"{strip_sql(to_text_sql(q(PROVNUM), render))} AS {PROVNUM}",
        f"{strip_sql(to_text_sql(q(PROVNAME), render))} AS {PROVNAME}",
        state_key,
    ]
    measures = [m for m, _ in ROLLUP_MEASURES]
    df = coerce_numeric(gold.selectExpr(*keys, *[q(m) for m in measures]), measures)
    if missing_key == "drop":
        df = df.dropna(subset=[PROVNUM, PROVNAME, STATE])
    return df


def dashboard(gold: DataFrame, state: str | None = None, provnum: str | None = None,
              provname: str | None = None, k: int = TOPK_DEFAULT, missing_key: str = "nan",
              prereduce: bool = False) -> DataFrame:
    """Top-k facilities by mean total nurse hours under the cascaded filters.

    ``prereduce=True`` aggregates on the raw keys first and cleans only the
    distinct keys (see :func:`prereduced_rollup`); same result up to the
    summation order of the means.
    """
    if prereduce:
        return topk(prereduced_rollup(gold, state, provnum, provname, missing_key), k)
    rows = cascade(load_for_dashboard(gold, missing_key), state, provnum, provname)
    return topk(rollup(rows), k)


def prereduced_rollup(gold: DataFrame, state: str | None = None, provnum: str | None = None,
                      provname: str | None = None, missing_key: str = "nan") -> DataFrame:
    """The roll-up with key clean-up moved after a first aggregation.

    Phase 1 groups on the *raw* keys and keeps, per measure, sum and count
    (means) or max; only the measures are coerced per row.  The keys are then
    cleaned on the phase-1 rows (one per distinct raw key combination, not
    one per fact), filtered, and phase 2 merges groups whose keys clean to the
    same value: mean = sum of sums / sum of counts.  Both phases are hash
    aggregates with map-side combine, so a hot facility stays one partial row
    per task.
    """
    if missing_key not in ("nan", "drop"):
        raise ValueError("missing_key must be 'nan' or 'drop'")
    measures = [m for m, _ in ROLLUP_MEASURES]
    raw = coerce_numeric(gold.select(PROVNUM, PROVNAME, STATE, *measures), measures)
    phase1 = []
    for m, how in ROLLUP_MEASURES:
        if how == "mean":
            phase1 += [f"sum({q(m)}) AS {q('_s_' + m)}", f"count({q(m)}) AS {q('_n_' + m)}"]
        else:
            phase1.append(f"{how}({q(m)}) AS {q('_x_' + m)}")
    pre = raw.groupBy(PROVNUM, PROVNAME, STATE).agg(*[F.expr(e) for e in phase1])
    render = "nan" if missing_key == "nan" else None
    cleaned = pre.selectExpr(
        f"{strip_sql(to_text_sql(q(PROVNUM), render))} AS {PROVNUM}",
        f"{strip_sql(to_text_sql(q(PROVNAME), render))} AS {PROVNAME}",
        f"{state_key_sql(render)} AS {STATE}",
        *[q(c) for c in pre.columns if c.startswith("_")])
    if missing_key == "drop":
        cleaned = cleaned.dropna(subset=[PROVNUM, PROVNAME, STATE])
    cleaned = cascade(cleaned, state, provnum, provname)
    phase2 = []
    for m, how in ROLLUP_MEASURES:
        if how == "mean":
            phase2.append(f"try_divide(sum({q('_s_' + m)}), sum({q('_n_' + m)})) AS {q(m)}")
        else:
            phase2.append(f"{how}({q('_x_' + m)}) AS {q(m)}")
    return cleaned.groupBy(PROVNUM, PROVNAME, STATE).agg(*[F.expr(e) for e in phase2])


def page(top: DataFrame) -> DataFrame:
    """One page (B5 whole): the empty check and the five views of one top-k, as rows tagged by ``view``.

    The top-k (at most 100 rows, already in one partition) is computed once: its rows become one array, from which
    all views are drawn.  Columns a view does not show are NULL.
    """
    shown = {"hours_census": VIEW_HOURS_CENSUS, "occupancy": VIEW_OCCUPANCY, "rating": VIEW_RATING,
             "staff_mix": VIEW_STAFF_MIX, "table": VIEW_TABLE}
    names = [PROVNUM, PROVNAME, STATE, *(m for m, _ in ROLLUP_MEASURES)]
    types = {f.name: f.dataType.simpleString() for f in top.schema.fields}

    def row(view: str, cols, empty: str) -> str:
        cells = [f"{'r.' + q(c) if c in cols else f'CAST(NULL AS {types[c]})'} AS {q(c)}" for c in names]
        return f"struct('{view}' AS view, {empty} AS is_empty, {', '.join(cells)})"

    rows = ", ".join(row(v, cols, "CAST(NULL AS BOOLEAN)") for v, cols in shown.items())
    one = top.limit(TOPK_MAX).agg(F.collect_list(F.struct(*[F.col(c) for c in names])).alias("top"))
    return one.selectExpr(f"explode(concat(array({row('empty_check', (), 'size(top) = 0')}), "
                          f"flatten(transform(top, r -> array({rows}))))) AS v").select("v.*")


def state_options(dash: DataFrame) -> DataFrame:
    return options(dash, STATE)


def provnum_options(dash: DataFrame, state: str | None = None) -> DataFrame:
    return options(by_state(dash, state), PROVNUM)


def provname_options(dash: DataFrame, state: str | None = None, provnum: str | None = None) -> DataFrame:
    return options(by_provnum(by_state(dash, state), provnum), PROVNAME)
