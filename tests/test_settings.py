"""Bounds, views, ranks and session settings."""

import pytest
from pyspark.sql import functions as F

from carelens.operators.aggregate import minmax_scale, options, ranked
from carelens.operators.joins import BROADCAST_CONF, bounded_broadcast
from carelens.operators.sqlover import sql_over
from carelens.session import checkpoint_root


def test_bounded_scaling_checks_its_bound(spark):
    assert minmax_scale(spark.range(100).toDF("x"), ["x"], bounded=True).agg(F.max("x_scaled")).first()[0] == 1.0
    with pytest.raises(Exception, match="more rows than a top-k view"):
        minmax_scale(spark.range(101).toDF("x"), ["x"], bounded=True).collect()


def test_a_demanded_broadcast_is_measured(spark):
    df = spark.range(1000).toDF("n")
    spark.conf.set(BROADCAST_CONF, "1000")
    try:
        with pytest.raises(ValueError, match="too large to broadcast"):
            bounded_broadcast(df, "broadcast")
    finally:
        spark.conf.unset(BROADCAST_CONF)
    assert "broadcast" in bounded_broadcast(df, "broadcast")._jdf.queryExecution().logical().toString().lower()


def test_views_of_the_caller_stay(spark):
    spark.range(3).createOrReplaceTempView("Staffing")
    got = sql_over(spark, "SELECT count(*) AS n FROM Staffing s JOIN Other o ON s.id = o.id",
                   {"Staffing": spark.range(5), "Other": spark.range(4)})
    assert got.first()["n"] == 4
    assert spark.table("Staffing").count() == 3 and "other" not in [t.name.lower() for t in spark.catalog.listTables()]
    spark.catalog.dropTempView("Staffing")


def test_ranks_follow_the_sort(spark):
    df = spark.range(500).select(((F.col("id") * 7919) % 503).alias("v"), F.col("id"))
    got = ranked(df.orderBy(F.col("v").desc(), "id")).collect()
    want = sorted(((r["v"], r["id"]) for r in df.collect()), key=lambda x: (-x[0], x[1]))
    assert [(r["v"], r["id"]) for r in sorted(got, key=lambda r: r["rank"])] == want and {r["rank"] for r in got} == set(range(1, 501))
    assert ranked(options(spark.createDataFrame([], "x string"), "x")).columns == ["x", "rank"]


def test_no_temp_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: d)})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
