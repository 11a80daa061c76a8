"""Sketches, subtotals, analytic windows and snapshot differences on edge rows, against plain Python."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from carelens.operators.difference import counted, except_all, intersect_all, snapshot_diff
from carelens.operators.frames import ranks, running, top_per_key
from carelens.operators.grouping import cube_sets, rollup_sets, subtotals
from carelens.operators.sketches import Distinct, Quantiles, answer, sketch, unite
from carelens.plans.gold import gold
from carelens.plans.runner import ask_sketches, write_summaries
from carelens.sources.sinks import write_snapshot
from carelens.plans.bronze import bronze_provider, bronze_staffing, bronze_state
from carelens import fixtures as fx
from tests.conftest import SF_SMALL
from tests.test_event_time import ordered, plan, rows

# ---------------------------------------------------------------- sketches

SPECS = (Distinct("d", "x"), Quantiles("q", "v", 200))


def test_sketches_are_within_their_bounds_after_uniting(spark):
    df = spark.range(200_000).selectExpr("id % 4 AS g", "pmod(xxhash64(id % 40000), 100000000) AS x", "pow(id % 1000, 2) AS v", "id % 7 AS part")
    tables = [sketch(df.where(F.col("part") == p), ["g", "part"], SPECS) for p in range(7)]
    both = tables[0]
    for t in tables[1:]:
        both = both.unionByName(t)
    got = {r.g: r for r in answer(unite(both, ["g"], SPECS), ["g"], SPECS, (0.1, 0.5, 0.999)).collect()}
    for r in df.groupBy("g").agg(F.count_distinct("x").alias("d"), F.count("v").alias("n")).collect():
        mine = got[r.g]
        assert mine.rows == r.n == mine.q_n and abs(mine.d - r.d) <= SPECS[0].bound * r.d
        own = sorted(x.v for x in df.where(F.col("g") == r.g).select("v").collect())
        for p, q in ((0.1, mine.q_p10), (0.5, mine.q_p50), (0.999, mine.q_p99_9)):
            below, upto = sum(x < q for x in own) / len(own), sum(x <= q for x in own) / len(own)
            assert below - 2 * SPECS[1].bound <= p <= upto + 2 * SPECS[1].bound
    # whatever order and grouping they are united in, counts are the same
    again = answer(unite(unite(both, ["part", "g"], SPECS), [], SPECS), [], SPECS, ()).first()
    assert again["rows"] == 200_000 and abs(again.d - 40_000) <= SPECS[0].bound * 40_000


def test_sketches_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([("a", None, None), ("a", None, float("nan")), ("b", 1, 2.0), (None, 1, -1.0)], "g string, x long, v double")
    got = answer(unite(sketch(df, ["g"], SPECS), ["g"], SPECS), ["g"], SPECS, (0.0, 1.0))
    assert rows(got) == ordered([("a", 2, 0, 0, None, None), ("b", 1, 1, 1, 2.0, 2.0), (None, 1, 1, 1, -1.0, -1.0)])
    assert answer(unite(sketch(df.limit(0), ["g"], SPECS), ["g"], SPECS), ["g"], SPECS).count() == 0
    with pytest.raises(ValueError):
        answer(sketch(df, ["g"], SPECS), ["g"], SPECS, (1.5,))


def test_snapshots_are_asked_from_their_sketches(spark, scratch):
    land = {n: fx.role(spark, SF_SMALL, n) for n in ("staffing", "provider", "state")}
    g = gold(bronze_staffing(land["staffing"], stamped=False), bronze_provider(land["provider"], stamped=False), bronze_state(land["state"], stamped=False))
    root = scratch("sketched")
    half = F.pmod(F.xxhash64(*g.columns), F.lit(2))
    first = write_snapshot(g.where(half == 0), root, before_commit=write_summaries(spark))
    write_snapshot(g.where(half == 1), root, before_commit=write_summaries(spark))
    got = {r.STATE: r for r in ask_sketches(spark, root).collect()}
    want = {r.STATE: r for r in g.selectExpr("upper(trim(STATE)) AS STATE", "trim(PROVNUM) AS p", "Tot_Nurse_hrs AS h").groupBy("STATE")
            .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("p").alias("d"), F.count("h").alias("h")).collect()}
    assert {k: (r["rows"], r.facilities, r.hours_n) for k, r in got.items()} == {k: (r.n, r.d, r.h) for k, r in want.items()}
    whole = ask_sketches(spark, root, by_state=False, probabilities=(0.5,)).first()
    assert whole["rows"] == g.count() and whole.hours_p50 is not None
    newest = ask_sketches(spark, root, by_state=False, last=1).first()
    assert newest["rows"] == g.where(half == 1).count()
    text = plan(ask_sketches(spark, root, state="ST3"))
    assert "_sketch" in text and "MDScensus" not in text  # no fact column is read
    with pytest.raises(FileNotFoundError):
        ask_sketches(spark, scratch("nothing"))
    write_snapshot(g.limit(1), root)  # a snapshot without sketches isn't passed over in silence
    with pytest.raises(Exception, match="_sketch"):
        ask_sketches(spark, root).collect()
    assert ask_sketches is not None and first.startswith(root)


# ---------------------------------------------------------------- subtotals


def test_subtotals_tell_null_keys_from_totals(spark):
    data = [("a", None, 1), ("a", "x", 2), (None, "x", 4), (None, None, 8), ("b", "y", 16)]
    df = spark.createDataFrame(data, "k string, l string, v long")
    got = subtotals(df, ["k", "l"], cube_sets(["k", "l"]), {"n": "count(1)", "s": "sum(v)", "u": "count(DISTINCT l)"})
    assert got.columns == ["k", "l", "grouping", "n", "s", "u"]
    want = collections.defaultdict(list)
    for k, l, v in data:
        for name, key in (("k+l", (k, l)), ("k", (k, None)), ("l", (None, l)), ("total", (None, None))):
            want[(*key, name)].append((l, v))
    assert rows(got) == ordered([(*k, len(v), sum(x for _, x in v), len({x for x, _ in v} - {None})) for k, v in want.items()])


def test_subtotals_in_one_scan_and_exchange(spark):
    df = spark.range(1000).selectExpr("id % 3 AS a", "id % 5 AS b", "id % 7 AS c", "id AS v")
    for sets in (rollup_sets(["a", "b", "c"]), cube_sets(["a", "b", "c"]), [("c",), (), ("a", "b")]):
        text = plan(subtotals(df, ["a", "b", "c"], sets, {"s": "sum(v)"}))
        assert text.count("Exchange hashpartitioning") == 1 and text.count("Expand") == 1 and text.count("Range (") == 1
    assert rollup_sets(["a", "b"]) == [("a", "b"), ("a",), ()]
    total = subtotals(df.limit(0), ["a"], [("a",), ()], {"n": "count(1)"})
    assert [r for r in rows(total) if r[1] != "total" or r[2]] == []
    same = subtotals(df, ["a"], [("a",), ("a",)], {"n": "count(1)"})
    assert same.count() == 3
    for bad in (dict(sets=[("z",)]), dict(sets=[]), dict(sets=[()], aggs={"a": "count(1)"}), dict(sets=[()], aggs={"grouping": "count(1)"})):
        with pytest.raises(ValueError):
            subtotals(df, ["a"], bad["sets"], bad.get("aggs", {"n": "count(1)"}))


# ---------------------------------------------------------------- analytic windows


def ranked_rows(seed):
    rnd = random.Random(seed)
    data = [("hot", rnd.choice([None, rnd.randrange(40)]), i) for i in range(700)]
    return data + [(rnd.choice(["a", "b", None]), rnd.choice([None, rnd.randrange(9)]), i) for i in range(200)] + [("hot", 5, 0)] * 3


@pytest.mark.parametrize("ascending", [False, True])
def test_ranks_equal_the_plain_window(spark, ascending):
    df = spark.createDataFrame(ranked_rows(1), "k string, v long, i long").repartition(5)
    way = "ASC NULLS LAST" if ascending else "DESC NULLS LAST"
    want = df.selectExpr("*", f"CAST(rank() OVER (PARTITION BY k ORDER BY v {way}) AS BIGINT) AS rank",
                         f"CAST(dense_rank() OVER (PARTITION BY k ORDER BY v {way}) AS BIGINT) AS dense_rank")
    got = ranks(df, ["k"], "v", ascending, cuts=7)
    assert rows(got) == rows(want)
    assert rows(top_per_key(df, ["k"], "v", 3, ascending)) == rows(want.where("rank <= 3"))
    assert ranks(df.limit(0), ["k"], "v").count() == 0
    assert rows(ranks(df, [], "v", ascending, 4)) == rows(df.selectExpr("*", f"CAST(rank() OVER (ORDER BY v {way}) AS BIGINT) AS rank",
                                                                        f"CAST(dense_rank() OVER (ORDER BY v {way}) AS BIGINT) AS dense_rank"))


def test_a_hot_key_is_ranked_in_many_tasks(spark):
    df = spark.range(20_000).selectExpr("id div 100000 AS k", "id AS v")
    dealt = df.repartitionByRange(8, "k", F.col("v").desc()).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(dealt) == 8 and max(r["count"] for r in dealt) < 4000
    got = ranks(df, ["k"], "v", cuts=8)
    assert got.agg(F.min("rank"), F.max("rank"), F.count_distinct("rank")).first()[:] == (1, 20_000, 20_000)
    windows = [x.split("Window [")[1] for x in plan(got).split("\n") if "Window [" in x]
    assert all("_cut" in x for x in windows)  # no window over a key's rows


AGGS = {"n": ("count", "v"), "s": ("sum", "v"), "m": ("avg", "v"), "lo": ("min", "v"), "hi": ("max", "v")}


@pytest.mark.parametrize("bucket", [10, 37, 5000])
def test_running_equals_plain_python(spark, bucket):
    rnd = random.Random(bucket)
    data = [(rnd.choice(["a", "b", None]), rnd.choice([None, rnd.randrange(-300, 300)]), rnd.choice([None, rnd.randrange(9)]), i) for i in range(250)]
    df = spark.createDataFrame(data, "k string, t long, v long, i long").withColumns({"_b": F.lit(1), "_row": F.lit(2)})
    got = running(df, ["k"], "t", 10, AGGS, bucket)
    assert got.columns == [*df.columns, *AGGS]
    want = []
    for k, t, v, i in data:
        x = [w for l, u, w, _ in data if l == k and t is not None and u is not None and t - 10 <= u <= t and w is not None]
        want.append((i, len(x), sum(x) if x else None, sum(x) / len(x) if x else None, min(x, default=None), max(x, default=None)))
    assert rows(got, "i", *AGGS) == ordered(want)


def test_running_arguments_and_plan(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "timestamp_seconds(id * 50) AS t", "id AS v")
    assert rows(running(df, ["k"], "t", 100, {"s": ("sum", "v")}), "v", "s") == [(0, 0), (1, 1), *((i, 2 * i - 2) for i in range(2, 10))]
    assert "_b#" in plan(running(df, ["k"], "t", 100, {"s": ("sum", "v")})).split("Window [")[1].split("], [")[1]
    for bad in (dict(width=-1), dict(width=5, bucket=4), dict(width=5, aggs={"s": ("median", "v")})):
        with pytest.raises(ValueError):
            running(df, ["k"], "t", **{"aggs": {"s": ("sum", "v")}, **bad})


# ---------------------------------------------------------------- differences


def multiset(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_multiset_differences(spark):
    rnd = random.Random(4)
    pick = lambda n: [(rnd.choice([None, "a", "b"]), rnd.choice([None, 1, 2]), rnd.choice([None, float("nan"), 0.5])) for _ in range(n)]
    old, new = (spark.createDataFrame(pick(n), "k string, v long, x double").withColumn("x", F.col("x").cast("string")) for n in (90, 70))
    a, b = multiset(old), multiset(new)
    assert multiset(except_all(new, old)) == b - a and multiset(intersect_all(new, old)) == a & b
    assert multiset(except_all(new, old)) == multiset(new.exceptAll(old))
    assert plan(counted(old, new)).count("Exchange") == 1
    empty = new.limit(0)
    assert multiset(except_all(empty, old)) == collections.Counter() and multiset(except_all(new, empty)) == b
    with pytest.raises(ValueError):
        counted(old, new.drop("x"))
    with pytest.raises(ValueError):
        counted(old.withColumn("n_old", F.lit(1)), new.withColumn("n_old", F.lit(1)))


def test_snapshot_diff_by_key(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (2, "b", 1), (3, None, 1), (None, "n", 1), (5, "same", 1), (6, "x", 1), (6, "y", 1)], "k long, v string, w long")
    new = spark.createDataFrame([(1, "a", 2), (2, "b", 1), (4, "d", 1), (None, "n", 1), (None, "m", 1), (5, "same", 1), (6, "x", 1)], "k long, v string, w long")
    got = {r.k: (r.change, [tuple(x) for x in r.old], [tuple(x) for x in r.new]) for r in snapshot_diff(old, new, ["k"]).collect()}
    assert got == {
        1: ("changed", [("a", 1, 1)], [("a", 2, 1)]), 2: ("changed", [("b", 1, 1)], []), 3: ("removed", [(None, 1, 1)], []),
        4: ("added", [], [("d", 1, 1)]), None: ("changed", [], [("m", 1, 1)]), 6: ("changed", [("y", 1, 1)], []),
    }
    assert snapshot_diff(new, new, ["k"]).count() == 0
