"""Dimension history and JSON columns on edge rows."""

import random

import pytest
from pyspark.sql import functions as F

from carelens.functions.semistructured import items, parse_json, quality
from carelens.operators.history import history, observations, with_extract
from tests.test_event_time import ordered, plan, rows

SCHEMA = "k string, a string, b long, t long"


def plain_history(data, full):
    """By key: the extracts in order, one step after the other."""
    seen, times = {}, sorted({t for *_, t in data if t is not None})
    for k, a, b, t in data:
        if t is not None:
            key = (x is not None, x) if (x := a) is not None else (False, "")
            rank = (key, (b is not None, b or 0))
            if (k, t) not in seen or rank > seen[k, t][0]:
                seen[k, t] = (rank, (a, b))
    out = []
    for k in {k for k, _ in seen}:
        current = None
        for i, t in enumerate(times):
            here = seen.get((k, t), (None, None))[1]
            if here is None and not full:
                continue
            if current and (here is None or here != current[0]):
                out.append((k, *current[0], current[1], t, current[2]))
                current = None
            if here is not None:
                current = (here, current[1], current[2] + 1) if current else (here, t, 1)
        if current:
            out.append((k, *current[0], current[1], None, current[2]))
    return out


def some(seed, n=160):
    rnd = random.Random(seed)
    return [(rnd.choice(["x", "y", "z", None]), rnd.choice([None, "p", "q"]), rnd.choice([None, 1]), rnd.choice([None, *range(8), *range(8)])) for _ in range(n // 4)]


@pytest.mark.parametrize("full", [True, False])
def test_history_equals_plain_python(spark, full):
    for seed in range(4):
        data = some(seed)
        df = spark.createDataFrame(data, SCHEMA)
        assert rows(history(df, ["k"], "t", full)) == ordered(plain_history(data, full))
    assert history(df.limit(0), ["k"], "t", full).count() == 0
    with pytest.raises(ValueError):
        history(df.withColumn("valid_to", F.lit(1)), ["k"], "t")


def test_backfilled_extracts_split_versions_and_reruns_change_nothing(spark):
    data = [("x", "p", 1, 10), ("x", "p", 1, 30), ("y", "q", 1, 10), ("y", "q", 1, 20), ("z", "r", None, 20), ("x", "p", 1, 40), ("z", "s", None, 40)]
    df = spark.createDataFrame(data, SCHEMA)
    whole = history(df, ["k"], "t")
    kept = lambda f: spark.createDataFrame(f.collect(), f.schema)  # noqa: E731  as a table written after each extract
    for order in ((40, 20, 10, 30),):
        versions, times = history(df.limit(0), ["k"], "t"), df.limit(0).select("t")
        for t in (*order, order[1]):
            versions, times = map(kept, with_extract(versions, times, df.where(F.col("t") == t), ["k"], "t"))
        assert rows(versions, *whole.columns) == rows(whole)
    assert rows(observations(whole, df.select("t"), "t"), "k", "a", "b", "t") == ordered(data)
    split = [r for r in rows(whole) if r[0] == "x"]
    assert split == [("x", "p", 1, 10, 20, 1), ("x", "p", 1, 30, None, 2)]  # absent at 20
    assert "Cartesian" not in plan(observations(whole, df.select("t"), "t")) and "NestedLoop" not in plan(whole)


def test_json_keeps_what_does_not_parse(spark):
    texts = ['{"k": 69}', '{"k": "x", "m": 3}', '{"k": 1', None, "", " ", "[1]", '{"k": 5, "z": {"a": 1}, "y": [1,2]}', "{}", '{"k": null, "m": 2.5}', "7", '{"k": 3.7}', "nope"]
    df = spark.createDataFrame([(i, t, "keep") for i, t in enumerate(texts)], "id long, props string, other string")
    got = parse_json(df, "props", "k bigint, m double")
    assert got.columns == ["id", "other", "k", "m", "_malformed", "_extra"]
    found = {r.id: (r.k, r.m, r._malformed, r._extra) for r in got.collect()}
    assert {i for i, x in found.items() if x[2] is not None} == {1, 2, 6, 10, 11, 12} and all(found[i][2] == texts[i] for i in (1, 2, 6, 10, 11, 12))
    assert [found[i][:2] for i in (0, 1, 7, 9)] == [(69, None), (None, 3.0), (5, None), (None, 2.5)]
    assert found[7][3] == {"z": '{"a":1}', "y": "[1,2]"} and all(x[3] is None for i, x in found.items() if i != 7)
    assert rows(quality(got)) == [(13, 6, 1)] and quality(got.limit(0)).first().documents == 0
    assert "Python" not in plan(got)
    with pytest.raises(ValueError):
        parse_json(df.withColumn("k", F.lit(1)), "props", "k bigint")


def test_items_keep_empty_arrays(spark):
    df = spark.createDataFrame([(1, [5, 6]), (2, []), (3, None)], "id long, xs array<long>")
    assert rows(items(df, "xs")) == ordered([(1, 0, 5), (1, 1, 6), (2, None, None), (3, None, None)])
