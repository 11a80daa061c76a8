"""Event-time windows of streams, sessions, as-of and range joins on edge rows, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from carelens.operators.intervals import overlap_join, range_join, range_parts
from carelens.operators.sessions import Agg, sessions
from carelens.operators.temporal import asof_join
from carelens.streaming.windows import Windows, current_windows, final_windows, late_rows, run_windows

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=lambda x: tuple((y is not None, str(type(y)), y) for y in x))


def ordered(out):
    return sorted(out, key=lambda x: tuple((y is not None, str(type(y)), y) for y in x))


# ---------------------------------------------------------------- streams

HOURLY = Windows(("k",), (("n", "count(1)"), ("total", "sum(v)")), every="1 hour")
SCHEMA = "k string, ts timestamp, v long"
BATCHES = [
    [("a", 0, 1), ("a", 59, 2), ("b", 30, 4), (None, 10, 8), ("a", None, 16)],
    [("a", 300, 1), ("a", 20, 32)],  # 20 is on time: no watermark before the first batch has ended
    [("a", 30, 64), ("b", 179, 1), ("b", 180, 2), ("a", 310, 1)],  # the watermark is at 180: only 180 is on time
    [("a", 900, 1)],
]


def land_and_run(spark, base, emit="final", batches=BATCHES, windows=HOURLY, delay="2 hours", **options):
    runs = []
    for batch in batches:
        spark.createDataFrame([(k, at(m), v) for k, m, v in batch], SCHEMA).write.mode("append").parquet(f"{base}/in")
        runs.append(run_windows(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", SCHEMA, windows, delay, emit, partitions=2, **options))
    return runs


def w(hour, *rest):
    return (at(60 * hour), at(60 * hour + 60), *rest)


def test_final_windows_and_restart(spark, scratch):
    base = scratch("final")
    runs = land_and_run(spark, base)
    want = [w(0, "a", 3, 35), w(0, "b", 1, 4), w(0, None, 1, 8), w(3, "b", 1, 2), w(5, "a", 2, 2)]
    assert rows(final_windows(spark, f"{base}/out", HOURLY)) == ordered(want)
    assert [r.rows for r in runs] == [5, 2, 4, 1]
    assert runs[0].watermark is None or runs[0].watermark < "2024-01-01T00:00:00"
    assert runs[-1].watermark.startswith("2024-01-01T13:00:00")
    # the state holds open windows only, whatever went through it
    assert [r.open_windows for r in runs] == [3, 1, 2, 1]
    again = run_windows(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", SCHEMA, HOURLY, "2 hours", partitions=2)
    assert again.rows == 0 and rows(final_windows(spark, f"{base}/out", HOURLY)) == ordered(want)


def test_changes_show_open_windows_and_late_rows(spark, scratch):
    base = scratch("changes")
    land_and_run(spark, base, "changes")
    current = current_windows(spark, f"{base}/out", HOURLY)
    want = [w(0, "a", 3, 35), w(0, "b", 1, 4), w(0, None, 1, 8), w(3, "b", 1, 2), w(5, "a", 2, 2), w(15, "a", 1, 1)]
    assert rows(current) == ordered(want)
    landed = spark.read.parquet(f"{base}/in")
    assert rows(late_rows(landed, current, HOURLY)) == ordered([("a", 7, 6, 1), ("b", 3, 2, 1), (None, 1, 1, 0)])
    assert "Window" not in plan(current).replace("window_", "")  # one aggregate, combined before the shuffle


def test_a_lost_driver_replays_its_batch(spark, scratch):
    """A run dies inside its first batch; the next run takes the same files once."""
    base = scratch("replay")
    spark.createDataFrame([("a", at(0), 1), ("a", at(1), 2)], SCHEMA).write.parquet(f"{base}/in")
    calls = []

    def breaks(df):
        calls.append(1)
        return df.withColumn("v", F.expr("if(v = 2, raise_error('lost'), v)")) if len(calls) == 1 else df

    for expected in (False, True):
        try:
            run_windows(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", SCHEMA, HOURLY, "1 hour", "changes", partitions=2, transform=breaks)
            assert expected
        except Exception:
            if expected:
                raise
    assert rows(current_windows(spark, f"{base}/out", HOURLY)) == [w(0, "a", 2, 3)]


def test_sliding_rocksdb_and_arguments(spark, scratch):
    sliding = Windows(("k",), HOURLY.aggs, every="2 hours", slide="1 hour")
    base = scratch("sliding")
    land_and_run(spark, base, windows=sliding, rocksdb=True, batches=[[("a", 30, 1), ("a", 90, 2)], [("a", 600, 1)]])
    assert [(r[0], r[3], r[4]) for r in rows(final_windows(spark, f"{base}/out", sliding))] == [(at(-60), 1, 1), (at(0), 2, 3), (at(60), 1, 2)]
    with pytest.raises(ValueError):
        Windows((), HOURLY.aggs)
    with pytest.raises(ValueError):
        Windows((), HOURLY.aggs, every="1 hour", gap="1 hour")
    with pytest.raises(ValueError):
        late_rows(spark.range(1), spark.range(1), sliding)
    with pytest.raises(ValueError):
        run_windows(spark, base, base, base, SCHEMA, HOURLY, "1 hour", "all")
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"  # the run's own settings are gone


def test_stream_and_batch_windows_are_equal_when_nothing_is_late(spark, scratch):
    rnd = random.Random(3)
    batches = [[(rnd.choice("abc"), 400 * i + rnd.randrange(-300, 300) + 300, rnd.randrange(9)) for _ in range(40)] for i in range(4)]
    batches.append([("z", 100_000, 0)])
    for windows in (HOURLY, Windows(("k",), HOURLY.aggs, gap="20 minutes")):
        base = scratch("equal")
        land_and_run(spark, base, batches=batches, windows=windows, delay="1 day")
        whole = windows.of(spark.read.parquet(f"{base}/in")).where("k <> 'z'")
        assert rows(final_windows(spark, f"{base}/out", windows)) == rows(whole)


# ---------------------------------------------------------------- sessions


def plain_sessions(data, gap):
    out, by = [], {}
    for k, t, v in data:
        if t is not None:
            by.setdefault(k, []).append((t, v))
    for k, own in by.items():
        own.sort()
        cur = [own[0]]
        for x in own[1:] + [None]:
            if x is None or x[0] - cur[-1][0] > gap:
                out.append((k, cur[0][0], cur[-1][0], len(cur), sum(v for _, v in cur), min(v for _, v in cur)))
                cur = []
            cur.append(x)
    return out


AGGS = (Agg("total", "sum", "v"), Agg("least", "min", "v"))


@pytest.mark.parametrize("bucket", [11, 13, 64, 10_000])
def test_sessions_equal_plain_python(spark, bucket):
    rnd = random.Random(bucket)
    data = [(rnd.choice(["a", "b", None]), rnd.choice([None, rnd.randrange(-400, 400), 10 * rnd.randrange(40)]), rnd.randrange(9)) for _ in range(400)]
    data += [("chain", 10 * i, 1) for i in range(200)]  # every gap is exactly 10: one session over all buckets
    df = spark.createDataFrame(data, "k string, t long, v long").withColumns({"n_": F.lit(1), "_b": F.lit(2), "_t": F.lit(3)})
    assert rows(sessions(df, ["k"], "t", 10, bucket, AGGS)) == ordered(plain_sessions(data, 10))


def test_sessions_equal_the_window_function(spark):
    rnd = random.Random(5)
    data = [(rnd.choice("ab"), at(rnd.randrange(0, 4000) / 2), 1) for _ in range(500)]
    df = spark.createDataFrame(data, "k string, t timestamp, v long")
    ours = sessions(df, ["k"], "t", 300, 3600).selectExpr("k", "session_start", "session_last + INTERVAL 300 SECONDS AS session_end", "n")
    theirs = df.groupBy("k", F.session_window("t", "300 seconds").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    assert rows(ours) == rows(theirs.select("k", "w.start", "w.end", "n"))
    local = sessions(df.withColumn("t", F.col("t").cast("timestamp_ntz")), ["k"], "t", 300, 3600)
    assert dict(local.dtypes)["session_start"] == "timestamp_ntz"


def test_sessions_without_keys_rows_or_sense(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 6, 1), (2, 50, 1)], "k long, t long, v long")
    assert rows(sessions(df, [], "t", 10, 100)) == [(5, 6, 2), (50, 50, 1)]
    assert sessions(df.limit(0), ["k"], "t", 10).count() == 0
    for bad in (dict(gap=10, bucket=10), dict(gap=10, aggs=(Agg("a", "avg", "v"),)), dict(gap=1, aggs=(Agg("n", "sum", "v"),))):
        with pytest.raises(ValueError):
            sessions(df, ["k"], "t", **bad)
    with pytest.raises(TypeError):
        sessions(df.withColumn("t", F.lit(1.5)), ["k"], "t", 10)


def test_a_hot_user_is_cut_into_buckets(spark):
    """All rows of one user: they are dealt by bucket as well, and one or two rows a bucket are stitched."""
    df = spark.range(50_000).select(F.expr("id div 100000").alias("k"), (F.col("id") * 2).alias("t"))
    got = sessions(df, ["k"], "t", 2, 1000)
    assert rows(got) == [(0, 0, 99_998, 50_000)]
    text = plan(sessions(df, ["k"], "t", 2, 1000))
    parts = [x.split(")")[0] for x in text.split("hashpartitioning(")[1:]]
    by_bucket, by_user = [x for x in parts if "_b#" in x], [x for x in parts if "_b#" not in x]
    assert by_bucket and by_user
    # what is dealt by the user alone are partial sessions, two a bucket at most
    assert all("HashAggregate" in text.split(f"hashpartitioning({x}")[1] for x in by_user)


# ---------------------------------------------------------------- as-of join


def plain_asof(facts, versions, strict=False, tolerance=None):
    out = []
    for k, t, x in facts:
        ok = [v for v in versions if k is not None and t is not None and v[0] == k and v[1] is not None and (v[1] < t if strict else v[1] <= t)]
        best = max(ok, key=lambda v: v[1:], default=(None, None, None))
        if best[1] is not None and tolerance is not None and (t - best[1]).total_seconds() > tolerance:
            best = (None, None, None)
        out.append((k, t, x, best[1], best[2]))
    return out


@pytest.mark.parametrize("options", [{}, {"strict": True}, {"tolerance_seconds": 1800}, {"hot_rows": 7}, {"hot_rows": 1, "strict": True}])
def test_asof_equals_plain_python(spark, options):
    rnd = random.Random(7)
    pick = lambda n: rnd.choice([None, at(rnd.randrange(n)), at(rnd.randrange(n)), at(rnd.randrange(n))])
    facts = [(rnd.choice(["a", "b", "c", None]), pick(500), i) for i in range(300)] + [("a", at(100), 1000)] * 40
    versions = [(rnd.choice(["a", "b", None, "d"]), pick(400), i % 50) for i in range(120)]
    f = spark.createDataFrame(facts, "k string, t timestamp, x long").withColumn("_b", F.lit(1))
    v = spark.createDataFrame(versions, "k string, t timestamp, x long").withColumn("_v", F.lit(1))
    got = asof_join(f, v, ["k"], "t", "t", ["x"], 3600, **options)
    assert got.columns == ["k", "t", "x", "_b", "v_t", "v_x"]
    want = plain_asof(facts, versions, options.get("strict", False), options.get("tolerance_seconds"))
    assert rows(got.drop("_b")) == ordered(want)


def test_asof_with_empty_sides_and_before_the_epoch(spark):
    f = spark.createDataFrame([("a", dt.datetime(1960, 1, 1), 1)], "k string, t timestamp, x long")
    v = spark.createDataFrame([("a", dt.datetime(1950, 1, 1), 9)], "k string, t timestamp, y long")
    assert rows(asof_join(f, v, ["k"], "t", "t", ["y"], 86_400), "x", "y") == [(1, 9)]
    assert rows(asof_join(f, v.limit(0), ["k"], "t", "t", ["y"], 86_400), "x", "y") == [(1, None)]
    assert asof_join(f.limit(0), v, ["k"], "t", "t", ["y"], 86_400).count() == 0


def test_asof_plan_deals_rows_by_bucket(spark):
    """No window over a key's rows: the one by key alone is over a row per bucket."""
    f = spark.range(1000).selectExpr("id % 3 AS k", "timestamp_seconds(id * 60) AS t", "id AS x")
    text = plan(asof_join(f, f, ["k"], "t", "t", ["x"], 3600))
    by_key = [x for x in text.split("Window [")[1:] if "_b#" not in x.split("], [")[1]]
    assert by_key and all("_l#" in x.split("]")[0] for x in by_key)
    assert not any(x in text for x in ("NestedLoop", "Cartesian"))


# ---------------------------------------------------------------- range joins


def intervals(seed, n=150):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        a = rnd.choice([None, rnd.randrange(-500, 500)]) if i % 10 == 0 else rnd.randrange(-500, 500)
        b = None if i % 17 == 0 else (a or 0) + rnd.choice([0, -3, 1, 2, 5, 8, 9, 64, 100_000])
        out.append((i, rnd.choice(["a", "b", None]), a, b))
    return out + [(500, "a", 0, 7)] * 2


def inside(p, a, b):
    return p is not None and a is not None and a <= p and (b is None or p < b)


@pytest.mark.parametrize("on", [(), ("k",)])
def test_range_join_equals_plain_python(spark, on):
    rnd = random.Random(1)
    points = [(i, rnd.choice(["a", "b", None]), rnd.choice([None, rnd.randrange(-600, 600), rnd.randrange(20)])) for i in range(200)]
    ints = intervals(2)
    p = spark.createDataFrame(points, "id long, k string, t long").withColumn("_s", F.lit(1))
    i = spark.createDataFrame(ints, "id long, k string, s long, e long").withColumn("_l", F.lit(1))
    got = range_join(p, i, "t", "s", "e", on).select("p.id", F.col("i.id").alias("i"))
    same = lambda x, y: not on or (x is not None and x == y)
    assert rows(got) == ordered([(pid, iid) for pid, pk, t in points for iid, ik, a, b in ints if same(pk, ik) and inside(t, a, b)])
    assert not any(x in plan(got) for x in ("NestedLoop", "Cartesian"))
    for x, y in ((p.limit(0), i), (p, i.limit(0))):
        assert range_join(x, y, "t", "s", "e", on).count() == 0


FOUND = (Agg("n", "count"), Agg("least", "min", "id"), Agg("most", "max", "id"), Agg("total", "sum", "v"))


@pytest.mark.parametrize("on", [(), ("k",)])
def test_range_parts_equal_the_aggregated_pairs(spark, on):
    """Repeated rows, nulls in every column, negative numbers, empty sides; bins of one to three levels."""
    rnd = random.Random(5)
    points = [(rnd.choice([None, i]), rnd.choice(["a", "b", None]), rnd.choice([None, rnd.randrange(-600, 600), rnd.randrange(20), rnd.randrange(-90_000, 90_000)]),
               rnd.choice([None, i % 7])) for i in range(300)]
    p = spark.createDataFrame([*points, *points[:40]], "id long, k string, t long, v long").withColumn("_m", F.lit(1))
    i = spark.createDataFrame(intervals(6), "id long, k string, s long, e long").withColumn("_a", F.lit(1))
    by = F.col("i.id").alias("i")
    for x in (p, p.where("t BETWEEN 0 AND 3"), p.limit(0)):
        got = range_parts(x, i, "t", "s", "e", FOUND, on).groupBy(by).agg(*[a.merged() for a in FOUND])
        pairs = range_join(x, i, "t", "s", "e", on).select(by, "p.id", "p.v").groupBy("i").agg(*[a.first() for a in FOUND])
        assert rows(got) == rows(pairs)
    assert range_parts(p, i.limit(0), "t", "s", "e", FOUND, on).count() == 0


def test_aggregates_of_a_range_join_make_no_pairs(spark, tmp_path):
    """All sign-ups lie in all outages, 1,500 times 1,500: the joins of the query made that many rows."""
    from carelens.event_queries import q_range_join_all

    kind = "CASE WHEN id < 1500 THEN 'error' ELSE 'signup' END"
    ts = "timestamp_micros(CASE WHEN id < 1500 THEN id ELSE 7000000 + id * 1000003 END)"
    spark.range(3000).selectExpr("id AS event_id", f"{ts} AS ts", "id AS user_id", f"{kind} AS event_type", "50D AS value", "'' AS props").write.parquet(f"{tmp_path}/events.parquet")
    found = q_range_join_all(spark, str(tmp_path))
    assert {(r["n"], r["first_id"], r["last_id"]) for r in found.collect()} == {(1500, 1500, 2999)}
    todo, joined = [found._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        name = node.nodeName()
        todo += [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if name.endswith("QueryStage") else []
        children = node.children()
        todo += [children.apply(n) for n in range(children.size())]
        joined += [node.metrics().apply("numOutputRows").value()] if name.endswith("Join") else []
    assert joined and max(joined) < 1500 * 1500 / 5


@pytest.mark.parametrize("on", [(), ("k",)])
def test_overlap_join_equals_plain_python(spark, on):
    a, b = intervals(3), intervals(4, 90)
    frames = [spark.createDataFrame(x, "id long, k string, s long, e long") for x in (a, b)]
    got = overlap_join(*frames, "s", "e", on).select("l.id", F.col("r.id").alias("r"))
    real = lambda x: x[2] is not None and (x[3] is None or x[2] < x[3])
    share = lambda x, y: (x[3] is None or y[2] < x[3]) and (y[3] is None or x[2] < y[3])
    same = lambda x, y: not on or (x is not None and x == y)
    assert rows(got) == ordered([(x[0], y[0]) for x in a for y in b if real(x) and real(y) and same(x[1], y[1]) and share(x, y)])
    assert not any(x in plan(got) for x in ("NestedLoop", "Cartesian"))


def test_long_intervals_take_two_bins(spark):
    """A million-fold longer interval costs no more rows; times work like numbers."""
    p = spark.range(1000).selectExpr("timestamp_seconds(id) AS t")
    i = spark.createDataFrame([(at(0) - dt.timedelta(days=30_000), at(0)), (dt.datetime(1970, 1, 1), None)], "s timestamp, e timestamp")
    assert range_join(p, i, "t", "s", "e").count() == 2000
    with pytest.raises(TypeError):
        range_join(p.withColumn("t", F.lit("x")), i, "t", "s", "e")
