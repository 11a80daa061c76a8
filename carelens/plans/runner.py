"""File-to-file runner: landing CSV -> bronze -> gold snapshot -> dashboard.

    from carelens.plans.runner import run_bronze, run_gold, ask
    run_bronze(spark, landing, bronze)            # three landing CSVs
    run_gold(spark, bronze, gold_root)            # one new snapshot + DQ table
    ask(spark, gold_root, state="AL", k=20)       # top-k over the newest snapshot

Landing files are Latin-1 CSV (as delivered); everything after is UTF-8
Parquet.  Every step is a distributed Spark job; the driver only sees file
paths, the DQ verdicts and the k rows of an answer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.operators.aggregate import rollup, topk
from carelens.operators.filters import cascade
from carelens.operators.quality import check_each, observed, publish
from carelens.operators.sketches import Distinct, Quantiles, answer, sketch, unite
from carelens.plans.bronze import bronze_provider, bronze_staffing, bronze_state
from carelens.plans.dashboard import (
    DASH_STATE, load_for_dashboard, page, provname_options, provnum_options, state_key_sql, state_options,
)
from carelens.plans.gold import gold
from carelens.schemas import CCN, PROVNUM, STATE
from carelens.sources.csv import read_csv
from carelens.sources.discovery import committed_snapshots, latest_snapshot_path, read_latest
from carelens.sources.sinks import without_parts, write_bronze, write_snapshot


@dataclass(frozen=True)
class LandingFiles:
    """Names of the three landing files (or folders) under the landing root."""
    provider: str = "provider_info.csv"
    state: str = "state_averages.csv"
    staffing: str = "daily_staffing.csv"


@dataclass(frozen=True)
class BronzeTables:
    provider: str = "provider_info"
    state: str = "state_averages"
    staffing: str = "staffing"


def run_bronze(spark: SparkSession, landing: str, bronze: str, files: LandingFiles = LandingFiles(),
               tables: BronzeTables = BronzeTables(), encoding: str = "ISO-8859-1", ts=None,
               fmt: str = "parquet", multi_line: bool | None = None) -> dict[str, str]:
    """B1-B3 over the landing CSVs; keys are read as text (no inference).

    Quoted fields of the two dimension files may contain line breaks (these
    files are small, so reading each in one task costs nothing).  The staffing
    file is split, and a line break in it stops the load with an error;
    ``multi_line`` sets all three.
    """
    out = {}
    steps = (
        (files.provider, tables.provider, bronze_provider, [CCN]),
        (files.state, tables.state, bronze_state, None),
        (files.staffing, tables.staffing, bronze_staffing, [PROVNUM]),
    )
    for src, dst, step, keys in steps:
        raw = read_csv(spark, f"{landing.rstrip('/')}/{src}", encoding=encoding, string_cols=keys,
                       multi_line=src != files.staffing if multi_line is None else multi_line)
        path = f"{bronze.rstrip('/')}/{dst}"
        write_bronze(step(raw, ts=ts), path, fmt=fmt)
        out[dst] = path
    return out


def _read_bronze(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    return spark.read.parquet(path) if fmt == "parquet" else read_csv(spark, path)


def run_gold(spark: SparkSession, bronze: str, gold_root: str, tables: BronzeTables = BronzeTables(),
             fmt: str = "parquet", rules=(("ColumnCount", ">", 0),), normalize_fact_key: bool = False,
             partition_by=(), partition_by_state: bool = False) -> dict:
    """B4 + D1/D2: write one new gold snapshot and its DQ outcome table.

    The roll-up (one row per facility) and the sketches (one row per state,
    see :data:`SKETCHES`) are written beside each snapshot before it is
    committed: questions, option lists and views read only those.

    Row metrics are gathered by an ``Observation`` during the write itself;
    the outcomes never gate the write (best effort, as in the source job): a
    rule that fails is an outcome, and a failed publish is returned as
    ``dq_error`` of a run that succeeded.

    ``partition_by_state``: add the dashboard's cleaned state key as column
    ``dash_state`` and partition the snapshot by it, so that a question for
    one state reads only that state's files (partition pruning).
    """
    b = bronze.rstrip("/")
    g = gold(_read_bronze(spark, f"{b}/{tables.staffing}", fmt),
             _read_bronze(spark, f"{b}/{tables.provider}", fmt),
             _read_bronze(spark, f"{b}/{tables.state}", fmt),
             normalize_fact_key=normalize_fact_key)
    if partition_by_state:
        g = g.withColumn(DASH_STATE, F.expr(state_key_sql()))
        partition_by = tuple(partition_by) + (DASH_STATE,)
    g_obs, obs = observed(g, cols=("overall_rating", "occup_rate"))

    folder = write_snapshot(g_obs, gold_root, partition_by=partition_by, before_commit=write_summaries(spark))
    error = None
    try:
        publish(check_each(without_parts(spark.read.parquet(folder)), rules), f"{gold_root.rstrip('/')}/_dq")
    except Exception as e:
        error = str(e)
    return {"snapshot": folder, "rollup": rollup_path(folder), "metrics": obs.get, "dq_error": error}


#: Sketches of a snapshot, by state: facilities, and the distribution of hours and occupancy over its daily facts.
SKETCHES = (Distinct("facilities", PROVNUM), Quantiles("hours", "Tot_Nurse_hrs"), Quantiles("occupancy", "occup_rate"))


def write_summaries(spark: SparkSession):
    """What ``write_snapshot`` runs before it commits: the snapshot's roll-up and its sketches."""

    def write(folder: str, run_id: str) -> None:
        facts = load_for_dashboard(spark.read.parquet(folder))
        rollup(facts).write.parquet(rollup_path(folder))
        sketch(facts, [STATE], SKETCHES).write.parquet(sketch_path(folder))

    return write


def _beside(folder: str, name: str) -> str:
    root, _, run = folder.rstrip("/").rpartition("/")
    return f"{root}/{name}/{run}"


def rollup_path(folder: str) -> str:
    """Where a snapshot's roll-up lies: ``<root>/_rollup/run_id=...`` (hidden from file discovery)."""
    return _beside(folder, "_rollup")


def sketch_path(folder: str) -> str:
    """Where a snapshot's sketches lie: ``<root>/_sketch/run_id=...``."""
    return _beside(folder, "_sketch")


def ask_sketches(spark: SparkSession, gold_root: str, by_state: bool = True, state: str | None = None, last: int | None = None,
                 probabilities=(0.5, 0.9, 0.99)) -> DataFrame:
    """Facility counts and quantiles of hours and occupancy over committed snapshots together (the ``last`` ones, or all),
    by state or over all; within the error bounds of :data:`SKETCHES`.  Only sketches are read, never facts: a row per state
    and snapshot.  A snapshot without sketches is an error."""
    found = committed_snapshots(spark, gold_root, last)
    if not found:
        raise FileNotFoundError(f"no committed snapshot under {gold_root}")
    rows = spark.read.parquet(*[sketch_path(f) for f in found])
    rows = rows.where(F.col(STATE) == F.lit(state)) if state is not None else rows
    by = [STATE] if by_state else []
    return answer(unite(rows, by, SKETCHES), by, SKETCHES, probabilities)


def load_gold(spark: SparkSession, gold_root: str, cache: bool = True) -> DataFrame:
    """The newest snapshot's roll-up, kept for repeated questions (X1): one row per facility is cached, never the
    facts.  A lost cached block is read again.  A snapshot that was written without a roll-up is rolled up here."""
    from pyspark import StorageLevel
    from pyspark.errors import AnalysisException

    folder = latest_snapshot_path(spark, gold_root)
    try:
        rolled = spark.read.parquet(rollup_path(folder))
    except AnalysisException:
        rolled = rollup(load_for_dashboard(read_latest(spark, gold_root, parts=True)))
    return rolled.persist(StorageLevel.MEMORY_AND_DISK) if cache else rolled


def ask(spark: SparkSession, gold_root: str | None = None, state: str | None = None, provnum: str | None = None,
        provname: str | None = None, k: int = 20, loaded: DataFrame | None = None) -> DataFrame:
    """B5 over the newest snapshot's roll-up, or over ``loaded`` (what :func:`load_gold` returned).  The filters are
    on the roll-up's keys, so filtering it equals rolling up the filtered facts."""
    rolled = loaded if loaded is not None else load_gold(spark, gold_root, cache=False)
    return topk(cascade(rolled, state, provnum, provname), k)


def ask_page(spark: SparkSession, gold_root: str | None = None, **question) -> DataFrame:
    """The whole page for a question: empty check and five views, from one top-k."""
    return page(ask(spark, gold_root, **question))


def ask_options(spark: SparkSession, gold_root: str | None = None, state: str | None = None,
                provnum: str | None = None, loaded: DataFrame | None = None) -> dict[str, DataFrame]:
    """The three option lists, each under the choices before it, from the roll-up."""
    rolled = loaded if loaded is not None else load_gold(spark, gold_root, cache=False)
    return {"state": state_options(rolled), "provnum": provnum_options(rolled, state),
            "provname": provname_options(rolled, state, provnum)}
