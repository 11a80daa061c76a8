"""Gold pipeline (B4): staffing facts joined with provider and state averages.

Plan shape: fact scan -> broadcast hash join (provider) -> broadcast hash join
(state) -> projection; no exchange on the fact side.  When a dimension is
too big to broadcast (measured), both joins fall back to sort-merge with AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelens.operators.joins import bounded_broadcasts, join_provider, join_state, provider_side, state_side
from carelens.operators.metrics import add_metrics, metric_sql
from carelens.operators.sqlover import sql_over
from carelens.schemas import (
    CCN, CERTIFIED_BEDS, OVERALL_RATING, PROV_STATE, PROVNUM, ST_AVG_NURSE_HRS, ST_AVG_RESIDENTS, STATE_KEY,
)
from carelens.utils import q


def gold(staffing: DataFrame, provider: DataFrame, state_avg: DataFrame, normalize_fact_key: bool = False,
         strict: bool = False, strategy: str = "auto") -> DataFrame:
    """``s.*`` + Tot_Nurse_hrs, perm_staff, temp_staff, occup_limit,
    Avg_residents_per_day, Avg_tot_nurse_hrs_per_resident_per_day, occup_rate,
    overall_rating (all double)."""
    fact_cols = staffing.columns
    # Both dimensions are measured in one job, then each is broadcast or not.  ``strategy`` is for the provider: the
    # states are few and their key is hot (NULL for every fact without a provider), so they are always measured.
    if strategy == "auto":
        prov, st = bounded_broadcasts([provider_side(provider), state_side(state_avg)])
    else:
        prov = bounded_broadcasts([provider_side(provider)], strategy)[0]
        st = bounded_broadcasts([state_side(state_avg)])[0]
    joined = join_state(join_provider(staffing, prov, normalize_fact_key, decided=True), st, decided=True)
    return add_metrics(joined, fact_cols, strict)


def gold_sql_text() -> str:
    """The gold query as SQL over views Staffing, Provider_Info, State_Averages.

    Written for ANSI mode: ``try_cast(coalesce(x, '0'))`` instead of
    ``CAST(COALESCE(x, 0))`` (which would coerce text to BIGINT and fail on
    '1.5'), and ``try_divide`` for zero beds.  The metric expressions are the
    ones the DataFrame plan uses.
    """
    m = metric_sql(fact="s.", prov="p.", state="st.", beds=CERTIFIED_BEDS, rating=OVERALL_RATING,
                   residents=ST_AVG_RESIDENTS, nurse_hrs=ST_AVG_NURSE_HRS)
    cols = [f"  {text} AS {name}" for name, text in m.items()]
    select = ",\n".join(cols)
    return f"""
SELECT s.*,
{select}
FROM Staffing s
LEFT JOIN Provider_Info p ON s.{q(PROVNUM)} = p.{q(CCN)}
LEFT JOIN State_Averages st ON p.{q(PROV_STATE)} = st.{q(STATE_KEY)}
"""


def gold_via_sql(spark: SparkSession, staffing: DataFrame, provider: DataFrame, state_avg: DataFrame,
                 strategy: str = "auto") -> DataFrame:
    """B4 through Q1: the same result from SQL text over temp views.

    The dimension views carry the measured broadcast decision as a hint.
    """
    prov = provider.select(q(CCN), q(PROV_STATE), q(CERTIFIED_BEDS), q(OVERALL_RATING))
    st = state_avg.select(q(STATE_KEY), q(ST_AVG_RESIDENTS), q(ST_AVG_NURSE_HRS))
    if strategy == "auto":
        prov, st = bounded_broadcasts([prov, st])
    else:
        prov, st = bounded_broadcasts([prov], strategy)[0], bounded_broadcasts([st])[0]
    return sql_over(spark, gold_sql_text(), {"Staffing": staffing, "Provider_Info": prov, "State_Averages": st})
