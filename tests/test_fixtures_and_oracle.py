"""Driver contract: entry(), queries() vs oracle_sql(), and the fixture role counts."""

import pytest

import __spark_entry__ as E
from carelens.queries import ORACLE, QUERIES
from tests.conftest import SF_MID, SF_SMALL
from tools.compare import canon, duck


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 20
    assert df.columns == ["PROVNUM", "PROVNAME", "STATE", "Tot_Nurse_hrs", "MDScensus", "occup_rate",
                          "overall_rating", "perm_staff", "temp_staff"]


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_fixture_counts(spark):
    """The numbers FIXTURES.md states for sf0.01."""
    g = QUERIES["gold"](spark, SF_MID)
    assert g.count() == 60000
    assert g.filter("occup_limit IS NOT NULL OR overall_rating IS NOT NULL").count() <= 40664
    j = QUERIES["left_join_state"](spark, SF_MID)
    assert j.filter("_p_ccn IS NOT NULL").count() == 40664
    assert j.filter("_st_key IS NOT NULL").count() == 40077
    assert g.filter("Tot_Nurse_hrs IS NOT NULL").count() == 59495
    assert g.filter("occup_rate IS NOT NULL").count() == 33561
    assert g.filter("perm_staff IS NULL OR temp_staff IS NULL").count() == 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = duck(SF_SMALL).execute(ORACLE[key])
    dcols = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, srows) == canon(dcols, rel.fetchall())
