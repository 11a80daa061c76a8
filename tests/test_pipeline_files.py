"""File-to-file run: Latin-1 landing CSV -> bronze -> gold snapshot -> questions."""

import csv
import io
import os

from carelens.plans.bronze import bronze_provider, bronze_staffing, bronze_state
from carelens.plans.dashboard import dashboard
from carelens.plans.gold import gold
from carelens.plans.runner import LandingFiles, ask, load_gold, run_bronze, run_gold
from carelens.schemas import PROVIDER_INFO_COLS, STATE_AVG_COLS
from tests import edge_tables as E


def _write_latin1(path, header, rows):
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(header)
    for r in rows:
        w.writerow(["" if v is None else v for v in r])
    with open(path, "wb") as f:
        f.write(buf.getvalue().encode("latin-1"))


def test_end_to_end_files(spark, scratch):
    base = scratch("e2e")
    local = base[len("file:"):] if base.startswith("file:") else base
    landing = f"{local}/landing"
    os.makedirs(landing)
    files = LandingFiles()
    provider_rows = [tuple("Peña Care" if c == "Provider Name" else v
                           for c, v in zip(PROVIDER_INFO_COLS, r)) for r in E.provider_rows()]
    # extra landing columns that retention must drop
    _write_latin1(f"{landing}/{files.provider}", list(PROVIDER_INFO_COLS) + ["Location"],
                  [r + ("x",) for r in provider_rows])
    _write_latin1(f"{landing}/{files.state}", list(STATE_AVG_COLS), E.state_rows())
    _write_latin1(f"{landing}/{files.staffing}", E.FACT_COLS, E.STAFFING)

    out = run_bronze(spark, landing, f"{base}/bronze", ts="2024-10-01 00:00:00")
    assert set(out) == {"provider_info", "state_averages", "staffing"}
    bp = spark.read.parquet(out["provider_info"])
    assert "Location" not in bp.columns and len(bp.columns) == len(PROVIDER_INFO_COLS) + 1
    assert {r["Provider Name"] for r in bp.collect()} == {"Peña Care"}

    res = run_gold(spark, f"{base}/bronze", f"{base}/gold")
    assert res["metrics"]["rows"] == len(E.STAFFING) + 1
    dq = spark.read.parquet(f"{base}/gold/_dq").collect()
    assert dq[0]["outcome"] == "Passed"

    # same answer as the in-memory chain (CSV empty fields read back as NULL, like the NA tokens)
    s, p, st = E.spark_frames(spark)
    mem = dashboard(gold(bronze_staffing(s), bronze_provider(p), bronze_state(st)), k=100)
    key = lambda r: tuple(str(v) for v in r)
    want = sorted(map(tuple, mem.collect()), key=key)
    assert sorted(map(tuple, ask(spark, f"{base}/gold", k=100).collect()), key=key) == want

    loaded = load_gold(spark, f"{base}/gold")
    assert sorted(map(tuple, ask(spark, loaded=loaded, k=100).collect()), key=key) == want
    assert ask(spark, loaded=loaded, state="AL", provnum="15009", k=5).count() == 1
    loaded.unpersist()

    # a second run adds a newer snapshot; questions read only that one
    run_gold(spark, f"{base}/bronze", f"{base}/gold")
    assert sorted(map(tuple, ask(spark, f"{base}/gold", k=100).collect()), key=key) == want


def test_state_partitioned_gold_prunes(spark, scratch):
    from carelens.plans.dashboard import load_for_dashboard
    from carelens.operators.filters import by_state
    from carelens.sources.sinks import write_bronze
    s, p, st = E.spark_frames(spark)
    base = scratch("partitioned")
    write_bronze(bronze_staffing(s), f"{base}/bronze/staffing")
    write_bronze(bronze_provider(p), f"{base}/bronze/provider_info")
    write_bronze(bronze_state(st), f"{base}/bronze/state_averages")
    run_gold(spark, f"{base}/bronze", f"{base}/gold", partition_by_state=True)
    key = lambda r: tuple(str(v) for v in r)
    mem = dashboard(gold(bronze_staffing(s), bronze_provider(p), bronze_state(st)), state="AL", k=100)
    got = ask(spark, f"{base}/gold", state="AL", k=100)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, mem.collect()), key=key)
    from carelens.sources.discovery import read_latest
    q = by_state(load_for_dashboard(read_latest(spark, f"{base}/gold", parts=True)), "AL")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "substring(part_dash_state" in plan.split("PartitionFilters: [")[1][:300] and "= AL)" in plan
    # missing keys keep their 'NAN' partition, whole roll-up unchanged
    full = ask(spark, f"{base}/gold", k=100)
    want = dashboard(gold(bronze_staffing(s), bronze_provider(p), bronze_state(st)), k=100)
    assert sorted(map(tuple, full.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_questions_read_the_roll_up_only(spark, scratch):
    from carelens.plans.runner import ask_options, ask_page
    from carelens.sources.sinks import write_bronze
    s, p, st = E.spark_frames(spark)
    base = scratch("rolled")
    write_bronze(bronze_staffing(s), f"{base}/bronze/staffing")
    write_bronze(bronze_provider(p), f"{base}/bronze/provider_info")
    write_bronze(bronze_state(st), f"{base}/bronze/state_averages")
    res = run_gold(spark, f"{base}/bronze", f"{base}/gold", rules=(("ColumnCount", ">", 0), ("IsComplete", "no such column"), ("Nonsense",)))
    assert res["dq_error"] is None  # a failing rule is an outcome, and the run succeeds
    outcomes = {r["rule"]: r["outcome"] for r in spark.read.parquet(f"{base}/gold/_dq").collect()}
    assert sorted(outcomes.values()) == ["Error", "Error", "Passed"]
    answer = ask(spark, f"{base}/gold", state="AL")
    assert all("/_rollup/" in f for f in answer.inputFiles()) and answer.inputFiles()
    assert "HashAggregate" not in answer._jdf.queryExecution().executedPlan().toString()
    rows = ask_page(spark, f"{base}/gold", k=5).collect()
    top = ask(spark, f"{base}/gold", k=5).collect()
    assert len(rows) == 1 + 5 * len(top) and [r["is_empty"] for r in rows if r["view"] == "empty_check"] == [False]
    none = ask_page(spark, f"{base}/gold", state="nowhere").collect()
    assert [(r["view"], r["is_empty"]) for r in none] == [("empty_check", True)]
    states = [r["STATE"] for r in ask_options(spark, f"{base}/gold")["state"].collect()]
    assert states == sorted(states) and "AL" in states


def test_failed_publish_leaves_the_run_successful(spark, scratch, monkeypatch):
    from carelens.plans import runner
    from carelens.sources.sinks import write_bronze
    s, p, st = E.spark_frames(spark)
    base = scratch("unpublished")
    write_bronze(bronze_staffing(s), f"{base}/bronze/staffing")
    write_bronze(bronze_provider(p), f"{base}/bronze/provider_info")
    write_bronze(bronze_state(st), f"{base}/bronze/state_averages")
    monkeypatch.setattr(runner, "publish", lambda *a: (_ for _ in ()).throw(OSError("no space")))
    res = run_gold(spark, f"{base}/bronze", f"{base}/gold")
    assert res["dq_error"] == "no space" and spark.read.parquet(res["snapshot"]).count() == len(E.STAFFING) + 1
