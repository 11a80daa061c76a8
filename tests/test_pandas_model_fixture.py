"""The independent pandas model against the Spark pipeline on the sf0.001 driver roles."""

import math

from carelens import fixtures as fx
from carelens.operators.aggregate import rollup
from carelens.plans.bronze import bronze_provider, bronze_staffing, bronze_state
from carelens.plans.dashboard import load_for_dashboard
from carelens.plans.gold import gold
from tests import pandas_model as PM
from tests.conftest import SF_SMALL


def _pd(df):
    p = df.toPandas().astype(object)
    return p.where(p.notna(), None)


def test_rollup_matches_pandas_on_driver_roles(spark):
    r = {n: fx.role(spark, SF_SMALL, n) for n in ("staffing", "provider", "state")}
    spark_rollup = rollup(load_for_dashboard(gold(bronze_staffing(r["staffing"]), bronze_provider(r["provider"]),
                                                  bronze_state(r["state"]))))
    got = {tuple(x[:3]): x for x in spark_rollup.collect()}
    pg = PM.gold(PM.bronze_staffing(_pd(r["staffing"])), PM.bronze_provider(_pd(r["provider"])),
                 PM.bronze_state(_pd(r["state"])))
    want = PM.dashboard_rollup(pg)
    assert len(got) == len(want) > 0
    for row in want.itertuples(index=False):
        d = row._asdict()
        g = got[(d["PROVNUM"], d["PROVNAME"], d["STATE"])]
        for m in ["Tot_Nurse_hrs", "MDScensus", "occup_rate", "overall_rating", "perm_staff", "temp_staff"]:
            a, b = g[m], d[m]
            if b is None or (isinstance(b, float) and math.isnan(b)):
                assert a is None, (d, m)
            else:
                assert abs(a - b) <= 1e-9 * max(1.0, abs(b)), (d, m, a, b)
