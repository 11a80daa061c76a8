"""Bronze -> gold -> dashboard on the edge tables, against an independent pandas model."""

import math

import pytest

from carelens.operators.aggregate import rollup, sort_rollup, topk
from carelens.plans.bronze import bronze_provider, bronze_staffing, bronze_state
from carelens.plans.dashboard import dashboard, load_for_dashboard
from carelens.plans.gold import gold, gold_via_sql
from carelens.schemas import CCN, GOLD_METRICS
from tests import edge_tables as E
from tests import pandas_model as PM


@pytest.fixture()
def bronze(spark):
    s, p, st = E.spark_frames(spark)
    return bronze_staffing(s, stamped=False), bronze_provider(p, stamped=False), bronze_state(st, stamped=False)


def _close(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    if b is None or (isinstance(b, float) and math.isnan(b)):
        return False
    if isinstance(a, float) or isinstance(b, float):
        return abs(a - b) <= 1e-9 * max(1.0, abs(a))
    return a == b


def test_bronze_keys(bronze):
    s, p, st = bronze
    assert [r[CCN] for r in p.collect()] == ["15009", "15010", "15011", "15012", None, "15013", "15013"]
    assert [r["State or Nation"] for r in st.collect()] == ["AL", "NATION", None, "TX"]
    assert [r["PROVNUM"] for r in s.collect()][:4] == ["15009", "15009", "15009", "015009"]


def test_gold_matches_pandas_model(spark, bronze):
    g = gold(*bronze).collect()
    ps, pp, pst = E.pandas_frames()
    pg = PM.gold(PM.bronze_staffing(ps), PM.bronze_provider(pp), PM.bronze_state(pst))
    assert len(g) == len(pg) == len(E.STAFFING) + 1  # the duplicate provider key doubles one fact row
    key = lambda t: tuple("" if v is None else str(v) for v in t)
    cols = list(pg.columns)
    sg = sorted((tuple(r[c] for c in cols) for r in g), key=key)
    pgr = sorted((tuple(None if (isinstance(v, float) and math.isnan(v)) else v for v in row)
                  for row in pg.itertuples(index=False)), key=key)
    for a, b in zip(sg, pgr):
        assert all(_close(x, y) for x, y in zip(a, b)), (a, b)


def test_gold_sql_text_equals_dataframe_plan(spark, bronze):
    a = sorted(map(tuple, gold(*bronze).collect()), key=str)
    b = sorted(map(tuple, gold_via_sql(spark, *bronze).collect()), key=str)
    assert a == b


def test_traps_in_gold(bronze):
    rows = gold(*bronze).collect()
    by = {}
    for r in rows:
        by.setdefault(r["PROVNUM"], []).append(r)
    # The zero-padded fact key finds no provider
    assert all(r["occup_limit"] is None and r["overall_rating"] is None for r in by["015009"])
    # Zero beds -> NULL rate; T21: missing census counts 0, malformed census -> NULL
    assert by["15010"][0]["occup_rate"] is None
    assert sorted((r["occup_rate"] for r in by["15009"]), key=lambda v: (v is None, v)) == [0.0, 50.0, None]
    # Malformed part -> whole sum NULL; missing parts count 0
    assert sorted((r["Tot_Nurse_hrs"] for r in by["15009"]), key=lambda v: (v is None, v)) == [14.5, 14.5, None]
    assert by["15012"][0]["Tot_Nurse_hrs"] == 0.0
    # Provider state 'al' is not cleaned, so no state averages
    assert by["15010"][0]["Avg_residents_per_day"] is None
    assert by["15009"][0]["Avg_residents_per_day"] == 50.0
    # Duplicate provider key multiplies the fact row
    assert len(by["15013"]) == 2
    # perm / temp: 7 parts each, perm + temp != total in general
    assert by["15011"][0]["perm_staff"] == 7.0 and by["15011"][0]["temp_staff"] == 14.0
    assert set(GOLD_METRICS) <= set(rows[0].asDict())


def test_normalized_fact_key_option(bronze):
    rows = gold(*bronze, normalize_fact_key=True).collect()
    padded = [r for r in rows if r["PROVNUM"] == "015009"]
    assert padded and padded[0]["occup_limit"] == 100.0
    # the default stays as the reference: option does not leak
    assert [r for r in gold(*bronze).collect() if r["PROVNUM"] == "015009"][0]["occup_limit"] is None


def test_strict_sums(bronze):
    strict = {(r["PROVNUM"], r["MDScensus"]): r["Tot_Nurse_hrs"] for r in gold(*bronze, strict=True).collect()}
    assert strict[("15012", "50")] is None  # missing parts -> NULL in the older job


def test_rollup_matches_pandas_dashboard(spark, bronze):
    r = {(x["PROVNUM"], x["PROVNAME"], x["STATE"]): x for x in rollup(load_for_dashboard(gold(*bronze))).collect()}
    ps, pp, pst = E.pandas_frames()
    pr = PM.dashboard_rollup(PM.gold(PM.bronze_staffing(ps), PM.bronze_provider(pp), PM.bronze_state(pst)))
    assert len(r) == len(pr)
    for row in pr.itertuples(index=False):
        d = row._asdict()
        got = r[(d["PROVNUM"], d["PROVNAME"], d["STATE"])]
        for m in ["Tot_Nurse_hrs", "MDScensus", "occup_rate", "overall_rating", "perm_staff", "temp_staff"]:
            assert _close(got[m], d[m]), (d, m, got[m])
    # T5: missing keys are kept as 'nan' / 'NAN'
    assert ("nan", "nan", "NAN") in r
    # unicode blanks and case in STATE are cleaned at the dashboard
    assert ("15010", "F", "AL") in r


def test_missing_key_drop_option(bronze):
    keys = [tuple(x[:3]) for x in rollup(load_for_dashboard(gold(*bronze), missing_key="drop")).collect()]
    assert all("nan" not in k and "NAN" not in k for k in keys)


def _ties(spark):
    rows = [(f"P{i:02d}", f"N{i}", "AL", h, 1.0, 1.0, 1.0, 1.0, 1.0) for i, h in
            enumerate([5.0, 5.0, 5.0, 5.0, 5.0, 9.0, 1.0, 2.0, 3.0, None, 4.0, 6.0])]
    return spark.createDataFrame(rows, "PROVNUM string, PROVNAME string, STATE string, Tot_Nurse_hrs double, "
                                       "MDScensus double, occup_rate double, overall_rating double, "
                                       "perm_staff double, temp_staff double")


def test_topk_ties_and_nulls(spark):
    df = _ties(spark)
    top = [r["PROVNUM"] for r in topk(df, 5).collect()]
    assert top == ["P05", "P11", "P00", "P01", "P02"]  # ties broken by key, stable
    full = [r["PROVNUM"] for r in sort_rollup(df).collect()]
    assert full[-1] == "P09"  # missing hours last (T15)
    assert full[:5] == top     # top-k is a prefix of the sorted roll-up


def test_topk_bounds(spark):
    df = _ties(spark)
    for bad in (4, 101, 2.5):
        with pytest.raises(ValueError):
            topk(df, bad)


def test_dashboard_cascade_equals_conjunction(bronze):
    g = gold(*bronze)
    a = sorted(map(tuple, dashboard(g, state="AL", provnum="15009", k=100).collect()))
    b = sorted(map(tuple, dashboard(g.filter("PROVNUM = '15009'"), state="AL", k=100).collect()))
    assert a == b and len(a) == 1
    assert dashboard(g, state="AL", provnum="15010", k=5).isEmpty() is False
    assert dashboard(g, state="TX", k=5).isEmpty()


def test_minmax_scale_paths_agree(spark):
    from carelens.operators.aggregate import minmax_scale
    df = _ties(spark).withColumn("flat", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(3.0))
    cols = ["Tot_Nurse_hrs", "flat"]
    a = sorted(map(tuple, minmax_scale(df, cols).collect()), key=str)
    b = sorted(map(tuple, minmax_scale(df, cols, bounded=True).collect()), key=str)
    assert a == b
    got = {r["PROVNUM"]: (r["Tot_Nurse_hrs_scaled"], r["flat_scaled"]) for r in minmax_scale(df, cols).collect()}
    assert got["P05"] == (1.0, 0.0) and got["P06"] == (0.0, 0.0) and got["P09"] == (None, 0.0)


def _rounded(rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=str)


@pytest.mark.parametrize("filters", [{}, {"state": "AL"}, {"state": "AL", "provnum": "15009"}, {"state": "TX"}])
@pytest.mark.parametrize("missing_key", ["nan", "drop"])
def test_prereduced_rollup_equals_rollup(bronze, filters, missing_key):
    from carelens.plans.dashboard import prereduced_rollup
    from carelens.operators.filters import cascade
    g = gold(*bronze)
    want = rollup(cascade(load_for_dashboard(g, missing_key), **filters))
    got = prereduced_rollup(g, missing_key=missing_key, **filters)
    assert got.columns == want.columns
    assert _rounded(got.collect()) == _rounded(want.collect())


def test_prereduced_dashboard_on_driver_tables(spark):
    from carelens.queries import _gold
    g = _gold(spark, "/root/testdata/sf0.01")
    a = dashboard(g, k=100).collect()
    b = dashboard(g, k=100, prereduce=True).collect()
    assert _rounded(a) == _rounded(b)
