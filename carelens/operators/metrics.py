"""Row-level gold metrics (M1-M7) and the star-plus projection.

Each metric is one SQL expression (see :func:`metric_sql`); the Column
functions wrap the same text, so the DataFrame plan and the SQL-text plan of
the gold job are the same expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.functions.numeric import add_parts_sql, num, num_sql
from carelens.operators.joins import P_BEDS, P_RATING, S_HRS, S_RES
from carelens.schemas import CENSUS, PERM_PARTS, TEMP_PARTS, TOTAL_PARTS
from carelens.utils import q


def occup_rate_sql(census: str = q(CENSUS), beds: str = q(P_BEDS)) -> str:
    """100 * census / beds; missing census counts 0, missing/malformed/zero beds -> NULL."""
    return f"100 * try_divide({num_sql(census, '0')}, {num_sql(beds)})"


def metric_sql(strict: bool = False, fact: str = "", prov: str = "", state: str = "", beds: str = P_BEDS,
               rating: str = P_RATING, residents: str = S_RES, nurse_hrs: str = S_HRS) -> dict[str, str]:
    """The eight gold columns in output order (M1-M7, P5), as SQL text.

    ``fact`` / ``prov`` / ``state`` qualify column references (e.g. 's.');
    the dimension column names default to the private names of the joins.
    """
    return {
        "Tot_Nurse_hrs": add_parts_sql(TOTAL_PARTS, strict, fact),
        "perm_staff": add_parts_sql(PERM_PARTS, strict, fact),
        "temp_staff": add_parts_sql(TEMP_PARTS, strict, fact),
        "occup_limit": num_sql(prov + q(beds)),
        "Avg_residents_per_day": num_sql(state + q(residents)),
        "Avg_tot_nurse_hrs_per_resident_per_day": num_sql(state + q(nurse_hrs)),
        "occup_rate": occup_rate_sql(fact + q(CENSUS), prov + q(beds)),
        "overall_rating": num_sql(prov + q(rating)),
    }


def tot_nurse_hrs(strict: bool = False) -> Column:
    """RN + LPN + CNA hours (M1; M1b with ``strict``)."""
    return F.expr(add_parts_sql(TOTAL_PARTS, strict))


def perm_staff(strict: bool = False) -> Column:
    """Seven employee-hour parts (M2; M2b with ``strict``)."""
    return F.expr(add_parts_sql(PERM_PARTS, strict))


def temp_staff(strict: bool = False) -> Column:
    """Seven contract-hour parts (M3; M3b with ``strict``)."""
    return F.expr(add_parts_sql(TEMP_PARTS, strict))


def occup_rate(census: Column | str = CENSUS, beds: Column | str = P_BEDS) -> Column:
    """100 * census / certified beds (M4)."""
    if isinstance(census, str) and isinstance(beds, str):
        return F.expr(occup_rate_sql(q(census), q(beds)))
    c = num(F.col(census) if isinstance(census, str) else census, "0")
    b = num(F.col(beds) if isinstance(beds, str) else beds)
    return F.lit(100) * F.try_divide(c, b)


def metric_columns(strict: bool = False) -> dict[str, Column]:
    return {n: F.expr(t) for n, t in metric_sql(strict).items()}


def add_metrics(joined: DataFrame, fact_cols, strict: bool = False) -> DataFrame:
    """``s.*`` plus the metric columns (P4), as one projection."""
    return joined.selectExpr(*[q(c) for c in fact_cols],
                             *[f"{t} AS {q(n)}" for n, t in metric_sql(strict).items()])
