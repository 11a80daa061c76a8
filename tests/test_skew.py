"""A facility holding over a third of all fact rows (the hot-key case)."""

from pyspark.sql import functions as F

from carelens import fixtures as fx
from carelens.operators.aggregate import rollup
from carelens.plans.bronze import bronze_provider, bronze_staffing, bronze_state
from carelens.plans.dashboard import load_for_dashboard
from carelens.plans.gold import gold

SF = "/root/testdata/sf0.01"


def _skewed(spark):
    # several map tasks, as a large scan has: a hot partition is split between them
    li = fx.table(spark, SF, "lineitem").repartition(8)
    # every order key divisible by 2 goes to supplier 1: ~half of all rows on one facility
    li = li.withColumn("l_suppkey", F.when(F.col("l_orderkey") % 2 == 0, F.lit(1).cast("bigint"))
                       .otherwise(F.col("l_suppkey")))
    s = bronze_staffing(fx.staffing_landing(li), stamped=False)
    p = bronze_provider(fx.role(spark, SF, "provider"), stamped=False)
    st = bronze_state(fx.role(spark, SF, "state"), stamped=False)
    return s, p, st


def _final_plan(df):
    df.collect()  # runs this frame's own adaptive plan to its final form
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_share(spark):
    s, _, _ = _skewed(spark)
    n = s.count()
    hot = s.filter("PROVNUM = '1'").count()
    assert hot * 3 > n


def test_shuffle_path_splits_hot_partition_and_agrees(spark):
    s, p, st = _skewed(spark)
    want = sorted(map(tuple, rollup(load_for_dashboard(gold(s, p, st))).collect()))
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        g = gold(s, p, st, strategy="shuffle")
        plan = _final_plan(g)
        # the provider is shuffled; the states, whose key is hot, are measured and broadcast
        assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") >= 1
        assert "skew=true" in plan  # AQE split the hot facility's partition
        got = sorted(map(tuple, rollup(load_for_dashboard(g)).collect()))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    def rounded(rows):  # summation order differs between plans
        return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows]
    assert rounded(got) == rounded(want)


def test_rollup_combines_map_side(spark):
    s, p, st = _skewed(spark)
    plan = rollup(load_for_dashboard(gold(s, p, st)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan and "partial_max" in plan


def test_unmatched_facts_do_not_meet_in_the_state_join(spark):
    """Most facts without a provider, so without a state: the state join moves no fact."""
    s, p, st = _skewed(spark)
    s = s.withColumn("PROVNUM", F.when(F.col("Hrs_CNA") > "0.02", F.lit("nobody")).otherwise(F.col("PROVNUM")))
    g = gold(s, p, st, strategy="shuffle")
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and "hashpartitioning(_p_state" not in plan
    assert g.count() == s.count() and g.filter("overall_rating IS NULL").count() > s.count() // 3
