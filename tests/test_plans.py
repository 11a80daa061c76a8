"""Plan shape and the broadcast size check."""


from carelens.operators.joins import BROADCAST_CONF, bounded_broadcast, measured_bytes
from carelens.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan(spark):
    p = _plan(QUERIES["dashboard_topk"](spark, SF))
    assert p.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in p
    assert "TakeOrderedAndProject" in p
    assert "Python" not in p and "ArrowEval" not in p
    # fact scan reads only the columns the staffing role needs
    li = [line for line in p.splitlines() if "lineitem.parquet" in line]
    assert li and "l_shipdate" not in li[0] and "l_extendedprice" not in li[0]


def test_gold_has_no_fact_exchange(spark):
    p = _plan(QUERIES["gold"](spark, SF))
    assert p.count("BroadcastHashJoin") == 2
    # every exchange feeds a broadcast: none stands between the fact scan and the result
    chain, depth = [], None
    for line in reversed(p.splitlines()):
        indent = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        if depth is None and "lineitem.parquet" in line:
            depth = indent
        elif depth is not None and indent < depth:
            chain.append(line)
            depth = indent
    assert chain and not any("Exchange" in line for line in chain)


def test_broadcast_falls_back_to_shuffle_when_too_big(spark):
    spark.conf.set(BROADCAST_CONF, "1")
    try:
        p = _plan(QUERIES["gold"](spark, SF))
        assert "BroadcastHashJoin" not in p and p.count("SortMergeJoin") == 2
        # same rows either way
        a = QUERIES["gold"](spark, SF).count()
    finally:
        spark.conf.unset(BROADCAST_CONF)
    assert a == QUERIES["gold"](spark, SF).count()


def test_measured_bytes(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2)], "s string, n long")
    # (2+8) + 8 + 16  and  (0+8) + 8 + 16
    assert measured_bytes(df) == 34 + 32
    assert "Broadcast" not in _plan(bounded_broadcast(df, max_bytes=10).join(df, "n"))


def test_sql_text_gold_keeps_broadcast_decision(spark):
    p = _plan(QUERIES["sql_over_frames"](spark, SF))
    assert p.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in p


def test_rollup_is_partial_then_final(spark):
    p = _plan(QUERIES["provider_rollup"](spark, SF))
    assert "partial_avg" in p and p.count("HashAggregate") >= 2


def test_quality_rules_read_the_data_once(spark):
    from carelens.operators.quality import check
    from carelens.queries import _gold
    df = check(_gold(spark, SF), (("ColumnCount", ">", 0), ("RowCount", ">", 0), ("IsComplete", "occup_rate"),
                                  ("IsComplete", "PROVNUM")))
    assert df.count() == 4
    p = _plan(df)
    assert len([l for l in p.splitlines() if "FileScan" in l and "lineitem" in l]) == 1
    # no union of per-rule branches (the only Union is the fixture's national state row)
    assert p.count("Union") == _plan(_gold(spark, SF)).count("Union")
