"""Retention, schema mapping, stamping (P1-P3, P6, P7) and failing DQ rules."""

import datetime

import pytest

from carelens.operators.projection import apply_mapping, identity_mapping, retain, stamp
from carelens.operators.quality import check
from carelens.schemas import INGESTED_AT, PROVIDER_INFO_COLS, STATE_AVG_COLS


def test_retention_lists_are_whole():
    assert len(PROVIDER_INFO_COLS) == 63 and len(set(PROVIDER_INFO_COLS)) == 63
    assert len(STATE_AVG_COLS) == 42 and len(set(STATE_AVG_COLS)) == 42


def test_retain_orders_and_drops(spark):
    df = spark.createDataFrame([("x", "1", "2")], "`Extra Col` string, `City/Town` string, `ZIP Code` string")
    out = retain(df, ["ZIP Code", "City/Town"])
    assert out.columns == ["ZIP Code", "City/Town"] and tuple(out.collect()[0]) == ("2", "1")


def test_retain_missing_name_raises(spark):
    df = spark.createDataFrame([("1",)], "a string")
    with pytest.raises(ValueError):
        retain(df, ["a", "Provider Name"])


def test_apply_mapping_casts_renames_drops(spark):
    df = spark.createDataFrame([("1.5", "x", "keep?")], "a string, b string, c string")
    out = apply_mapping(df, [("a", "string", "alpha", "double"), ("b", "string", "b", "string"),
                             ("`not there`", "string", "z", "string")])
    assert out.columns == ["alpha", "b"]
    assert tuple(out.collect()[0]) == (1.5, "x")
    assert identity_mapping(["a"]) == [("a", "string", "a", "string")]


def test_stamp_is_one_naive_constant(spark):
    df = stamp(spark.range(3), ts="2024-10-01 00:00:00")
    assert dict(df.dtypes)[INGESTED_AT] == "timestamp_ntz"
    assert {r[INGESTED_AT] for r in df.collect()} == {datetime.datetime(2024, 10, 1)}
    live = {r[INGESTED_AT] for r in stamp(spark.range(50)).collect()}
    assert len(live) == 1


def test_failing_rules(spark):
    df = spark.createDataFrame([], "k string")
    out = {r["rule"]: r["outcome"] for r in check(df, (("ColumnCount", ">", 5), ("RowCount", ">", 0))).collect()}
    assert out == {"ColumnCount > 5": "Failed", "RowCount > 0": "Failed"}
    with pytest.raises(ValueError):
        check(df, (("Bogus", "k"),))


def test_cluster_conf_respects_explicit_settings(spark):
    from carelens.session import CLUSTER_CONF, apply_cluster_conf
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key, None)
    try:
        apply_cluster_conf(spark)
        assert spark.conf.get(key) == CLUSTER_CONF[key]
        # shuffle partitions were set explicitly when the test session was built
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    finally:
        for k in CLUSTER_CONF:
            if k != "spark.sql.shuffle.partitions":
                spark.conf.unset(k)
        if old is not None:
            spark.conf.set(key, old)
