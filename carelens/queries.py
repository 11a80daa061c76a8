"""Registered queries: one per operator of the inventory, plus its DuckDB oracle.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the driver
tables in their fixture roles (whole tables; no sampling).  I/O queries write
to a fresh folder under the shared checkpoint root and read back.  Computed
columns carry the same names on both sides.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens import fixtures as fx
from carelens import fixtures_sql as fs
from carelens import analysis_queries, event_queries
from carelens.functions.numeric import to_number
from carelens.functions.text import strip, strip_zeros, to_text, upper
from carelens.operators.aggregate import minmax_scale, ranked, rollup, sort_rollup, topk
from carelens.operators.filters import by_provname, by_provnum, by_state, cascade, empty_check
from carelens.operators.joins import P_BEDS, join_provider, join_state
from carelens.operators.metrics import occup_rate, perm_staff, temp_staff, tot_nurse_hrs
from carelens.operators.projection import apply_mapping, identity_mapping, retain, retain_all, stamp
from carelens.operators.quality import check, publish
from carelens.operators.views import (
    view_hours_census, view_occupancy, view_rating, view_staff_mix, view_table, view_table_scaled,
)
from carelens.plans.bronze import bronze_provider, bronze_staffing, bronze_state
from carelens.plans.dashboard import dashboard, load_for_dashboard, page, provname_options, provnum_options, state_options
from carelens.plans.gold import gold, gold_via_sql
from carelens.schemas import (
    CCN, CENSUS, CERTIFIED_BEDS, INGESTED_AT, OVERALL_RATING, PERM_PARTS, PROVIDER_INFO_COLS, STATE_AVG_COLS,
    ROLLUP_MEASURES, STATE_KEY, TEMP_PARTS, TOTAL_PARTS, VIEW_HOURS_CENSUS, VIEW_OCCUPANCY, VIEW_RATING, VIEW_STAFF_MIX,
    VIEW_TABLE,
)
from carelens.session import scratch_path
from carelens.sources.csv import normalize_missing, read_csv, read_csv_tolerant
from carelens.sources.discovery import read_discovered, read_latest
from carelens.sources.intake import intake, resolve_shortcuts
from carelens.sources.sinks import without_parts, write_bronze, write_csv, write_gold, write_snapshot
from carelens.streaming.incremental import gold_incremental, ingest_incremental
from carelens.utils import qcol

Query = Callable[[SparkSession, str], DataFrame]

# Filter values of the dashboard questions (a facility that exists at every sf).
SEL_STATE, SEL_PROVNUM, SEL_PROVNAME = "ST3", "3", "Provider 3"
FIXED_TS = "2024-10-01 00:00:00"
STAFFING_COLS = fs.STAFFING_COLS

# ---------------------------------------------------------------- building blocks


class _Roles:
    """Landing roles built on first use, so a query pays only for what it reads."""

    def __init__(self, spark, d):
        self.spark, self.d = spark, d

    def __getitem__(self, name):
        return fx.role(self.spark, self.d, name)


def _roles(spark, d):
    return _Roles(spark, d)


_BRONZE = {"staffing": bronze_staffing, "provider": bronze_provider, "state": bronze_state}


def _b(spark, d, name):
    return _BRONZE[name](fx.role(spark, d, name), stamped=False)


def _bronze(spark, d):
    return tuple(_b(spark, d, n) for n in ("staffing", "provider", "state"))


def _gold(spark, d, **kw):
    return gold(*_bronze(spark, d), **kw)


def _dash(spark, d):
    return load_for_dashboard(_gold(spark, d))


def _top20(spark, d):
    return dashboard(_gold(spark, d), k=20)


def _with_fact(df, name, col):
    return df.select(*[F.col(c) for c in STAFFING_COLS], col.alias(name))


# ---------------------------------------------------------------- sources


def q_csv_scan(spark, d):
    staffing = _roles(spark, d)["staffing"]
    path = scratch_path(spark, "csv_scan")
    write_csv(staffing, path)
    return read_csv(spark, path)


def q_csv_scan_string_key(spark, d):
    provider = _roles(spark, d)["provider"]
    path = scratch_path(spark, "csv_scan_string_key")
    # the file has its columns in another order than the schema, and a quoted line break in the address
    address = F.concat(qcol(CCN), F.lit("\nSuite 4"))
    write_csv(provider.withColumn("Provider Address", address).select(*[qcol(c) for c in reversed(PROVIDER_INFO_COLS)]), path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in PROVIDER_INFO_COLS])
    return read_csv(spark, path, schema=schema, string_cols=[CCN], multi_line=True)


def q_missing_tokens(spark, d):
    return normalize_missing(_roles(spark, d)["staffing"])


def q_file_discovery(spark, d):
    r = _roles(spark, d)
    folder = scratch_path(spark, "file_discovery")
    write_csv(r["staffing"], folder, mode="append")
    # A decoy in the same folder that the name rule must skip.
    fx.table(spark, d, "nation").write.mode("append").json(folder)
    return read_discovered(spark, folder, name_contains=".csv", fmt="csv")


#: Rows of a file of the newest snapshot, about.
FILE_ROWS = 1_000_000


def q_latest_snapshot(spark, d):
    """The run committed last is read, whole: it has three files or more, the other one other rows and a name that sorts later."""
    staffing = _roles(spark, d)["staffing"]
    root = scratch_path(spark, "latest_snapshot")
    write_snapshot(staffing.withColumn("PROVNAME", F.lit("older")), root, fmt="csv", run_id="run9")
    files = max(3, -(-staffing.count() // FILE_ROWS))  # a task's share is bounded, however large the table is
    write_snapshot(staffing.repartition(files), root, fmt="csv", run_id="run10")
    return read_latest(spark, root, fmt="csv")


def _land_dated(spark, source: str, target: str, days_back: int) -> None:
    """Move finished files into a landing folder with their dates set back (file system calls, one per file)."""
    jvm = spark._jvm
    src, dst = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs_ = src.getFileSystem(spark._jsc.hadoopConfiguration())
    old = int(time.time() * 1000) - days_back * 86_400_000
    for status in fs_.listStatus(src):
        name = status.getPath().getName()
        if name.startswith("part-"):
            fs_.setTimes(status.getPath(), old, -1)
            fs_.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(dst, name))


def q_incremental_ingest(spark, d):
    events = fx.table(spark, d, "events")
    base = scratch_path(spark, "incremental_ingest")
    landing, sink, ckpt = f"{base}/landing", f"{base}/sink", f"{base}/_checkpoint"
    early = F.dayofmonth("ts") <= 15
    events.filter(early).write.mode("append").parquet(landing)
    n1 = ingest_incremental(spark, landing, sink, ckpt, events.schema)
    # back-filled files: landed later, dated long before the others
    events.filter(~early | F.col("ts").isNull()).write.mode("append").parquet(f"{base}/late")
    _land_dated(spark, f"{base}/late", landing, days_back=400)
    n2 = ingest_incremental(spark, landing, sink, ckpt, events.schema)
    n3 = ingest_incremental(spark, landing, sink, ckpt, events.schema)
    if n3 != 0 or n1 + n2 != events.count():
        raise RuntimeError(f"the runs counted {n1}, {n2} and {n3} rows")
    return spark.read.parquet(sink)


def q_incremental_gold(spark, d):
    """Bronze staffing lands in two batches of files; each run turns only the
    new files into gold rows; a third run finds nothing new."""
    staffing = _b(spark, d, "staffing")
    prov, st = _b(spark, d, "provider"), _b(spark, d, "state")
    base = scratch_path(spark, "incremental_gold")
    landing, sink, ckpt = f"{base}/landing", f"{base}/gold", f"{base}/_checkpoint"
    first = F.col("MDScensus").isNull() | (F.col("MDScensus").try_cast("int") % 2 == 0)
    staffing.filter(first).write.mode("append").parquet(landing)
    n1 = gold_incremental(spark, landing, prov, st, sink, ckpt, staffing.schema)
    staffing.filter(~first).write.mode("append").parquet(landing)
    n2 = gold_incremental(spark, landing, prov, st, sink, ckpt, staffing.schema)
    n3 = gold_incremental(spark, landing, prov, st, sink, ckpt, staffing.schema)
    if n3 != 0 or n1 == 0:
        raise RuntimeError(f"incremental gold runs ingested {n1}, {n2}, {n3} rows")
    return spark.read.parquet(sink)


def q_intake_filter(spark, d):
    return intake(fx.file_manifest(fx.table(spark, d, "pages")))


def q_resolve_shortcuts(spark, d):
    return resolve_shortcuts(fx.file_manifest(fx.table(spark, d, "pages")))


TOLERANT_TEXT = ("PROVNUM", "PROVNAME", "STATE")


def tolerant_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType() if c in TOLERANT_TEXT else T.DoubleType())
                         for c in STAFFING_COLS])


def q_tolerant_scan(spark, d):
    staffing = _roles(spark, d)["staffing"]
    path = scratch_path(spark, "tolerant_scan")
    write_csv(staffing, path)
    good, bad, _failed = read_csv_tolerant(spark, path, tolerant_schema())
    text = bad.select(*[F.col(c).try_cast(good.schema[c].dataType).alias(c) for c in good.columns])
    return (good.withColumn("status", F.lit("good"))
            .unionByName(text.withColumn("status", F.lit("rejected"))))


def _land_cut(spark, source: str, target: str) -> None:
    """Copy the first half of one of a folder's data files into another folder (a transfer that broke off)."""
    hadoop = spark._jvm.org.apache.hadoop
    src, dst = hadoop.fs.Path(source), hadoop.fs.Path(target)
    fs_ = src.getFileSystem(spark._jsc.hadoopConfiguration())
    status = min((s for s in fs_.listStatus(src) if s.getPath().getName().startswith("part-")), key=lambda s: s.getPath().getName())
    out = fs_.create(hadoop.fs.Path(dst, "cut-" + status.getPath().getName()))
    spark._jvm.org.apache.commons.io.IOUtils.copyLarge(fs_.open(status.getPath()), out, 0, status.getLen() // 2)
    out.close()


def q_tolerant_files(spark, d):
    """Rows and failed files of a folder where one compressed file is cut in half: it is listed, no row of it taken."""
    path = scratch_path(spark, "tolerant_files")
    write_csv(_roles(spark, d)["staffing"], path, compression="gzip")
    write_csv(_roles(spark, d)["provider"].select(F.lit("cut").alias("PROVNUM"), *[F.lit("1").alias(c) for c in STAFFING_COLS[1:]])
              , f"{path}-cut", compression="gzip", max_records_per_file=10_000)
    _land_cut(spark, f"{path}-cut", path)
    good, bad, failed = read_csv_tolerant(spark, path, tolerant_schema())
    one = lambda df, what: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n")
    return one(good, "good rows").unionByName(one(bad, "rejected rows")).unionByName(one(failed, "failed files"))


# ---------------------------------------------------------------- sinks (K1-K3)


def q_bronze_roundtrip(spark, d):
    bs = _b(spark, d, "staffing")
    path = scratch_path(spark, "bronze_roundtrip")
    write_bronze(bs, path, fmt="csv")
    return read_csv(spark, path)


def q_gold_roundtrip(spark, d):
    g = _gold(spark, d)
    path = scratch_path(spark, "gold_roundtrip")
    write_gold(g, path, mode="append")
    return spark.read.parquet(path)


def q_gold_single_file(spark, d):
    """Two snapshots with different rows; the newer, partitioned by a text key with leading zeros, is read whole."""
    g = _gold(spark, d)
    root = scratch_path(spark, "gold_snapshots")
    write_snapshot(g.withColumn("PROVNAME", F.lit("older")), root)
    write_snapshot(g, root, partition_by=("STATE",))
    return read_latest(spark, root)


def q_gold_partitioned(spark, d):
    """Partitioned by a key of text like `01` and blanks: the layout changes no value."""
    key = F.when(F.col("STATE").contains("st3"), F.lit("")).otherwise(F.lpad(F.regexp_extract("STATE", "([0-9]+)", 1), 2, "0"))
    g = _gold(spark, d).withColumn("STATE", key)
    path = scratch_path(spark, "gold_partitioned")
    write_gold(g, path, partition_by=("STATE",))
    return without_parts(spark.read.parquet(path))


# ---------------------------------------------------------------- projection


def q_retain_provider(spark, d):
    return retain(fx.provider_landing(fx.table(spark, d, "supplier"), extra=True), PROVIDER_INFO_COLS)


def q_retain_state(spark, d):
    return retain(fx.state_landing(fx.table(spark, d, "nation"), extra=True), STATE_AVG_COLS)


def q_retain_all(spark, d):
    return retain_all(_roles(spark, d)["staffing"])


def q_star_plus(spark, d):
    bs = _b(spark, d, "staffing")
    return bs.select("*", tot_nurse_hrs().alias("Tot_Nurse_hrs"), perm_staff().alias("perm_staff"),
                     temp_staff().alias("temp_staff"))


def q_alias_dims(spark, d):
    bs, bp, bst = _bronze(spark, d)
    j = join_state(join_provider(bs, bp), bst)
    return j.select("PROVNUM", F.col(P_BEDS).alias("occup_limit"),
                    F.col("_st_avg_residents").alias("Avg_residents_per_day"),
                    F.col("_st_avg_nurse_hrs").alias("Avg_tot_nurse_hrs_per_resident_per_day"),
                    F.col("_p_rating").alias("overall_rating"))


def q_apply_mapping(spark, d):
    """The 63-name mapping with two casts and a rename; a listed name that the input lacks is dropped."""
    changed = {CERTIFIED_BEDS: ("beds", "int"), OVERALL_RATING: ("overall_rating", "double"), "Provider Name": ("facility", "string")}
    identity = identity_mapping(PROVIDER_INFO_COLS + (INGESTED_AT,))
    return apply_mapping(_b(spark, d, "provider"), [(c, t, *changed.get(c, (c, t))) for c, t, _, _ in identity])


def q_ingest_stamp(spark, d):
    return stamp(_roles(spark, d)["state"], ts=FIXED_TS)


def q_view_hours_census(spark, d):
    return view_hours_census(_top20(spark, d))


def q_view_occupancy(spark, d):
    return view_occupancy(_top20(spark, d))


def q_view_rating(spark, d):
    return view_rating(_top20(spark, d))


def q_view_staff_mix(spark, d):
    return view_staff_mix(_top20(spark, d))


def q_view_table(spark, d):
    return view_table(_top20(spark, d))


# ---------------------------------------------------------------- filters


def q_filter_state(spark, d):
    return by_state(_dash(spark, d), SEL_STATE)


def q_filter_provnum(spark, d):
    return by_provnum(_dash(spark, d), SEL_PROVNUM)


def q_filter_provname(spark, d):
    return by_provname(_dash(spark, d), SEL_PROVNAME)


def q_filter_cascade(spark, d):
    return cascade(_dash(spark, d), SEL_STATE, SEL_PROVNUM, SEL_PROVNAME)


def q_empty_check(spark, d):
    # Facility 4 is not in state ST3: the combination is empty.
    return empty_check(cascade(_dash(spark, d), SEL_STATE, "4"))


# ---------------------------------------------------------------- joins


def q_left_join_provider(spark, d):
    bs, bp = _b(spark, d, "staffing"), _b(spark, d, "provider")
    return join_provider(bs, bp)


def q_left_join_state(spark, d):
    bs, bp, bst = _bronze(spark, d)
    return join_state(join_provider(bs, bp), bst)


# ---------------------------------------------------------------- metrics (M1-M7)


def q_tot_nurse_hrs(spark, d):
    return _with_fact(_b(spark, d, "staffing"), "Tot_Nurse_hrs", tot_nurse_hrs())


def q_perm_staff(spark, d):
    return _with_fact(_b(spark, d, "staffing"), "perm_staff", perm_staff())


def q_temp_staff(spark, d):
    return _with_fact(_b(spark, d, "staffing"), "temp_staff", temp_staff())


def q_tot_nurse_hrs_strict(spark, d):
    return _with_fact(_b(spark, d, "staffing"), "Tot_Nurse_hrs", tot_nurse_hrs(strict=True))


def q_perm_staff_strict(spark, d):
    return _with_fact(_b(spark, d, "staffing"), "perm_staff", perm_staff(strict=True))


def q_temp_staff_strict(spark, d):
    return _with_fact(_b(spark, d, "staffing"), "temp_staff", temp_staff(strict=True))


def q_occup_rate(spark, d):
    bs, bp = _b(spark, d, "staffing"), _b(spark, d, "provider")
    return join_provider(bs, bp).select("PROVNUM", CENSUS, F.col(P_BEDS).alias("beds"),
                                        occup_rate().alias("occup_rate"))


def q_dim_carry(spark, d):
    return _gold(spark, d).select("PROVNUM", "occup_limit", "Avg_residents_per_day",
                                  "Avg_tot_nurse_hrs_per_resident_per_day", "overall_rating")


# ---------------------------------------------------------------- aggregation, sort, limit


def q_provider_rollup(spark, d):
    return rollup(_dash(spark, d))


def q_options_state(spark, d):
    return ranked(state_options(_dash(spark, d)))


def q_options_provnum(spark, d):
    return ranked(provnum_options(_dash(spark, d), SEL_STATE))


def q_options_provname(spark, d):
    return ranked(provname_options(_dash(spark, d), SEL_STATE, SEL_PROVNUM))


def q_minmax_scale(spark, d):
    return minmax_scale(_top20(spark, d), ["MDScensus", "occup_rate"], bounded=True)


def q_sorted_rollup(spark, d):
    return ranked(sort_rollup(rollup(_dash(spark, d))))


def q_minmax_rollup(spark, d):
    """A5 over the whole roll-up, by one more aggregate instead of a window."""
    return minmax_scale(rollup(_dash(spark, d)), ["MDScensus", "occup_rate"])


def q_dashboard_page(spark, d):
    """B5 whole: the empty check and the five views, from one top-k under a state filter."""
    return page(dashboard(_gold(spark, d), state=SEL_STATE, k=10))


def q_topk_providers(spark, d):
    return topk(rollup(_dash(spark, d)), 50)


# ---------------------------------------------------------------- scalar functions


def q_fn_strip(spark, d):
    s = _roles(spark, d)["staffing"]
    return s.select(F.col("PROVNUM").alias("raw_provnum"), strip("PROVNUM").alias("provnum"),
                    strip("STATE").alias("state"))


def q_fn_strip_zeros(spark, d):
    p = _roles(spark, d)["provider"]
    return p.select(qcol(CCN).alias("raw_ccn"), strip_zeros(strip(qcol(CCN))).alias("ccn"))


def q_fn_upper(spark, d):
    st = _roles(spark, d)["state"]
    return st.select(qcol(STATE_KEY).alias("raw_key"), upper(qcol(STATE_KEY)).alias("upper_key"))


def q_fn_to_text(spark, d):
    p = _roles(spark, d)["provider"]
    return p.select(to_text(qcol(CERTIFIED_BEDS), "nan").alias("beds_text"),
                    to_text(qcol(OVERALL_RATING), "nan").alias("rating_text"))


def q_coerce_numeric(spark, d):
    s = _roles(spark, d)["staffing"]
    return s.select("PROVNUM", *[to_number(c).alias(c) for c in (CENSUS, *TOTAL_PARTS)])


# ---------------------------------------------------------------- SQL, quality, pipelines


def q_sql_over_frames(spark, d):
    return gold_via_sql(spark, *_bronze(spark, d))


DQ_RULES = (("ColumnCount", ">", 0), ("RowCount", ">", 0))
DQ_PUBLISHED_RULES = DQ_RULES + (("IsComplete", "overall_rating"), ("IsComplete", "PROVNUM"))


def q_dq_column_count(spark, d):
    return check(_gold(spark, d), DQ_RULES)


def q_dq_outcomes(spark, d):
    outcomes = check(_gold(spark, d), DQ_PUBLISHED_RULES)
    path = scratch_path(spark, "dq_outcomes")
    publish(outcomes, path)
    return spark.read.parquet(path).drop("evaluated_at")


def q_bronze_provider(spark, d):
    return _b(spark, d, "provider")


def q_bronze_state(spark, d):
    return _b(spark, d, "state")


def q_bronze_staffing(spark, d):
    return _b(spark, d, "staffing")


def q_gold(spark, d):
    return _gold(spark, d)


def q_gold_normalized_keys(spark, d):
    return _gold(spark, d, normalize_fact_key=True)


def q_dashboard_topk(spark, d):
    return _top20(spark, d)


def q_dashboard_state_topk(spark, d):
    """The flagship under a state filter, k at its minimum (F1 + A1 + O2)."""
    return dashboard(_gold(spark, d), state=SEL_STATE, k=5)


def q_view_table_scaled(spark, d):
    """The gradient table: P12 with census and occupancy scaled over its rows (A5)."""
    return view_table_scaled(_top20(spark, d))


def q_gold_strict(spark, d):
    """Gold with the older job's null-propagating sums (M1b-M3b in place)."""
    return _gold(spark, d, strict=True)


QUERIES: dict[str, Query] = {
    # sources
    "csv_scan": q_csv_scan,
    "csv_scan_string_key": q_csv_scan_string_key,
    "missing_tokens": q_missing_tokens,
    "file_discovery": q_file_discovery,
    "latest_snapshot": q_latest_snapshot,
    "incremental_ingest": q_incremental_ingest,
    "incremental_gold": q_incremental_gold,
    "intake_filter": q_intake_filter,
    "resolve_shortcuts": q_resolve_shortcuts,
    "tolerant_scan": q_tolerant_scan,
    "tolerant_files": q_tolerant_files,
    # sinks
    "bronze_roundtrip": q_bronze_roundtrip,
    "gold_roundtrip": q_gold_roundtrip,
    "gold_single_file": q_gold_single_file,
    "gold_partitioned": q_gold_partitioned,
    # projection
    "retain_provider": q_retain_provider,
    "retain_state": q_retain_state,
    "retain_all": q_retain_all,
    "star_plus": q_star_plus,
    "alias_dims": q_alias_dims,
    "apply_mapping": q_apply_mapping,
    "ingest_stamp": q_ingest_stamp,
    "view_hours_census": q_view_hours_census,
    "view_occupancy": q_view_occupancy,
    "view_rating": q_view_rating,
    "view_staff_mix": q_view_staff_mix,
    "view_table": q_view_table,
    # filters
    "filter_state": q_filter_state,
    "filter_provnum": q_filter_provnum,
    "filter_provname": q_filter_provname,
    "filter_cascade": q_filter_cascade,
    "empty_check": q_empty_check,
    # joins
    "left_join_provider": q_left_join_provider,
    "left_join_state": q_left_join_state,
    # metrics
    "tot_nurse_hrs": q_tot_nurse_hrs,
    "perm_staff": q_perm_staff,
    "temp_staff": q_temp_staff,
    "tot_nurse_hrs_strict": q_tot_nurse_hrs_strict,
    "perm_staff_strict": q_perm_staff_strict,
    "temp_staff_strict": q_temp_staff_strict,
    "occup_rate": q_occup_rate,
    "dim_carry": q_dim_carry,
    # aggregation, sort, limit
    "provider_rollup": q_provider_rollup,
    "options_state": q_options_state,
    "options_provnum": q_options_provnum,
    "options_provname": q_options_provname,
    "minmax_scale": q_minmax_scale,
    "minmax_rollup": q_minmax_rollup,
    "sorted_rollup": q_sorted_rollup,
    "topk_providers": q_topk_providers,
    # scalar functions
    "fn_strip": q_fn_strip,
    "fn_strip_zeros": q_fn_strip_zeros,
    "fn_upper": q_fn_upper,
    "fn_to_text": q_fn_to_text,
    "coerce_numeric": q_coerce_numeric,
    # SQL, quality, pipelines
    "sql_over_frames": q_sql_over_frames,
    "dq_column_count": q_dq_column_count,
    "dq_outcomes": q_dq_outcomes,
    "bronze_provider": q_bronze_provider,
    "bronze_state": q_bronze_state,
    "bronze_staffing": q_bronze_staffing,
    "gold": q_gold,
    "gold_normalized_keys": q_gold_normalized_keys,
    "dashboard_topk": q_dashboard_topk,
    "dashboard_page": q_dashboard_page,
    "dashboard_state_topk": q_dashboard_state_topk,
    "view_table_scaled": q_view_table_scaled,
    "gold_strict": q_gold_strict,
}

# ================================================================= oracle SQL

_sql = fs.sql
_dq = fs.dq


def _fact_cols(prefix: str = "") -> str:
    return ", ".join(prefix + _dq(c) for c in STAFFING_COLS)


def _dq_sql(rules) -> str:
    ncols = len(STAFFING_COLS) + 8
    parts = []
    for r in rules:
        if r[0] == "ColumnCount":
            parts.append("SELECT 'ColumnCount > 0' AS rule, CASE WHEN count(*) > 0 THEN 'Passed' ELSE 'Failed' END AS "
                         "outcome, CAST(count(*) AS DOUBLE) AS metric FROM (SELECT unnest(map_keys(json_transform("
                         "to_json(g), '\"MAP(VARCHAR, JSON)\"'))) FROM (SELECT * FROM gold LIMIT 1) g)")
        elif r[0] == "RowCount":
            parts.append("SELECT 'RowCount > 0' AS rule, CASE WHEN count(*) > 0 THEN 'Passed' ELSE 'Failed' END "
                         "AS outcome, CAST(count(*) AS DOUBLE) AS metric FROM gold")
        elif r[0] == "IsComplete":
            c = _dq(r[1])
            parts.append(f"SELECT 'IsComplete \"{r[1]}\"' AS rule, CASE WHEN count({c}) = count(*) THEN 'Passed' "
                         f"ELSE 'Failed' END AS outcome, COALESCE(CAST(count({c}) AS DOUBLE) / count(*), 1.0) "
                         "AS metric FROM gold")
    return "\nUNION ALL\n".join(parts)


def _intake_sql() -> str:
    sheet, folder, csv = fs.lit(fx.MIME_SHEET), fs.lit(fx.MIME_FOLDER), fs.lit(fx.MIME_CSV)
    action = (f"CASE WHEN mimeType = {folder} THEN 'skip_folder' WHEN mimeType = {sheet} THEN 'export' "
              f"WHEN mimeType = {csv} OR ends_with(lower(name), '.csv') THEN 'download' ELSE 'skip_other' END")
    tname = f"CASE WHEN mimeType = {sheet} AND NOT ends_with(lower(name), '.csv') THEN name || '.csv' ELSE name END"
    return (f"SELECT id, name, mimeType, action, target_key FROM (SELECT id, name, mimeType, {action} AS action, "
            f"'data/' || {tname} AS target_key FROM manifest) c WHERE action IN ('export', 'download')")


def _resolve_sql() -> str:
    sheet = fs.lit(fx.MIME_SHEET)
    inner = ("SELECT id, name, CASE WHEN shortcutDetails IS NOT NULL THEN shortcutDetails.targetId ELSE id END "
             "AS target_id, CASE WHEN shortcutDetails IS NOT NULL THEN shortcutDetails.targetMimeType "
             "ELSE mimeType END AS target_mime FROM manifest")
    return (f"SELECT id, name, target_id, target_mime, COALESCE(target_mime = {sheet}, false) AS export, "
            f"'downloaded_tables/' || CASE WHEN target_mime = {sheet} AND NOT ends_with(name, '.csv') "
            f"THEN name || '.csv' ELSE name END AS target_key FROM ({inner}) r")


def _tolerant_sql() -> str:
    sel, ok = [], []
    for c in STAFFING_COLS:
        if c in TOLERANT_TEXT:
            sel.append(_dq(c))
        else:
            sel.append(f"TRY_CAST({_dq(c)} AS DOUBLE) AS {_dq(c)}")
            ok.append(f"({_dq(c)} IS NULL OR TRY_CAST({_dq(c)} AS DOUBLE) IS NOT NULL)")
    return f"SELECT {', '.join(sel)}, CASE WHEN {' AND '.join(ok)} THEN 'good' ELSE 'rejected' END AS status FROM staffing"


def _minmax_sql(source: str = "SELECT * FROM top20") -> str:
    cols = ["MDScensus", "occup_rate"]
    ext = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in cols)
    scaled = ", ".join(
        f"CASE WHEN t.{c} IS NULL THEN NULL WHEN e.mx_{c} - e.mn_{c} = 0 THEN 0.0 "
        f"ELSE (t.{c} - e.mn_{c}) / (e.mx_{c} - e.mn_{c}) END AS {c}_scaled" for c in cols)
    return f"SELECT t.*, {scaled} FROM ({source}) t, (SELECT {ext} FROM ({source}) s) e"


def _gold_norm_sql() -> str:
    # Same as gold, but the fact key also loses its leading zeros in the join.
    j = ("SELECT s.*, p." + _dq(CCN) + " AS _p_ccn, p.\"State\" AS _p_state, p." + _dq(CERTIFIED_BEDS)
         + " AS _p_beds, p." + _dq(OVERALL_RATING) + " AS _p_rating FROM b_staffing s LEFT JOIN b_provider p "
         "ON NULLIF(ltrim(s.PROVNUM, '0'), '') = p." + _dq(CCN))
    js = ("SELECT j.*, st." + _dq(STATE_KEY) + " AS _st_key, st.\"Average Number of Residents per Day\" "
          "AS _st_avg_residents, st.\"Reported Total Nurse Staffing Hours per Resident per Day\" "
          "AS _st_avg_nurse_hrs FROM jn j LEFT JOIN b_state st ON j._p_state = st." + _dq(STATE_KEY))
    body = fs.gold_select(False).replace("FROM j_state s", "FROM jsn s")
    base = _sql("SELECT 1", "b_staffing", "b_provider", "b_state")
    ctes = base[len("WITH "):base.rindex("\nSELECT 1")]
    return f"WITH {ctes},\njn AS ({j}),\njsn AS ({js})\n{body}"


def _ranked(col: str, where: str) -> str:
    return _sql(f"SELECT {col}, row_number() OVER (ORDER BY {col}) AS rank FROM "
                f"(SELECT DISTINCT {col} FROM dash WHERE {where}) o", "dash")


def _page_sql(top: str) -> str:
    names = ["PROVNUM", "PROVNAME", "STATE", *(m for m, _ in ROLLUP_MEASURES)]
    shown = {"hours_census": VIEW_HOURS_CENSUS, "occupancy": VIEW_OCCUPANCY, "rating": VIEW_RATING,
             "staff_mix": VIEW_STAFF_MIX, "table": VIEW_TABLE}
    nulls = ", ".join(f"CAST(NULL AS {'VARCHAR' if c in names[:3] else 'DOUBLE'}) AS {c}" for c in names)
    parts = [f"SELECT 'empty_check' AS view, count(*) = 0 AS is_empty, {nulls} FROM ({top}) t"]
    for view, cols in shown.items():
        cells = ", ".join(c if c in cols else f"CAST(NULL AS {'VARCHAR' if c in names[:3] else 'DOUBLE'}) AS {c}" for c in names)
        parts.append(f"SELECT '{view}' AS view, CAST(NULL AS BOOLEAN) AS is_empty, {cells} FROM ({top}) t")
    return " UNION ALL ".join(f"({p})" for p in parts)


def _views(cols) -> str:
    return _sql(f"SELECT {', '.join(cols)} FROM top20", "top20")


_DASH_FILTER = f"SELECT * FROM dash WHERE STATE = '{SEL_STATE}'"
_EMPTY_SQL = ("SELECT count(*) = 0 AS is_empty, CASE WHEN count(*) = 0 THEN "
              "'No facility matches this combination of filters.' END AS warning "
              f"FROM (SELECT 1 FROM dash WHERE STATE = '{SEL_STATE}' AND PROVNUM = '4' LIMIT 1) t")


def _metric_sql(name: str, parts, strict: bool) -> str:
    return _sql(f"SELECT {_fact_cols('s.')}, {fs.sum_parts(parts, strict)} AS {name} FROM b_staffing s",
                "b_staffing")


ORACLE: dict[str, str] = {
    "csv_scan": _sql("SELECT * FROM staffing", "staffing"),
    "csv_scan_string_key": _sql(f"SELECT * REPLACE ({_dq(CCN)} || chr(10) || 'Suite 4' AS \"Provider Address\") FROM provider",
                                "provider"),
    "missing_tokens": _sql("SELECT " + ", ".join(f"{fs.na(_dq(c))} AS {_dq(c)}" for c in STAFFING_COLS)
                           + " FROM staffing", "staffing"),
    "file_discovery": _sql("SELECT * FROM staffing", "staffing"),
    "latest_snapshot": _sql("SELECT * FROM staffing", "staffing"),
    "incremental_ingest": "SELECT * FROM events",
    "incremental_gold": _sql("SELECT * FROM gold", "gold"),
    "intake_filter": _sql(_intake_sql(), "manifest"),
    "resolve_shortcuts": _sql(_resolve_sql(), "manifest"),
    "tolerant_scan": _sql(_tolerant_sql(), "staffing"),
    "tolerant_files": _sql(f"SELECT status || ' rows' AS what, count(*) AS n FROM ({_tolerant_sql()}) t GROUP BY status "
                           "UNION ALL SELECT 'failed files', 1", "staffing"),
    "bronze_roundtrip": _sql("SELECT * FROM b_staffing", "b_staffing"),
    "gold_roundtrip": _sql("SELECT * FROM gold", "gold"),
    "gold_single_file": _sql("SELECT * FROM gold", "gold"),
    "gold_partitioned": _sql("SELECT * REPLACE (CASE WHEN contains(STATE, 'st3') THEN '' ELSE "
                             "lpad(regexp_extract(STATE, '([0-9]+)', 1), 2, '0') END AS STATE) FROM gold", "gold"),
    "retain_provider": _sql("SELECT " + ", ".join(_dq(c) for c in PROVIDER_INFO_COLS) + " FROM provider_x",
                            "provider_x"),
    "retain_state": _sql("SELECT " + ", ".join(_dq(c) for c in STATE_AVG_COLS) + " FROM state_x", "state_x"),
    "retain_all": _sql("SELECT * FROM staffing", "staffing"),
    "star_plus": _sql(f"SELECT s.*, {fs.sum_parts(TOTAL_PARTS)} AS Tot_Nurse_hrs, "
                      f"{fs.sum_parts(PERM_PARTS)} AS perm_staff, {fs.sum_parts(TEMP_PARTS)} AS temp_staff "
                      "FROM b_staffing s", "b_staffing"),
    "alias_dims": _sql("SELECT PROVNUM, _p_beds AS occup_limit, _st_avg_residents AS Avg_residents_per_day, "
                       "_st_avg_nurse_hrs AS Avg_tot_nurse_hrs_per_resident_per_day, _p_rating AS overall_rating "
                       "FROM j_state", "j_state"),
    "apply_mapping": _sql(f"SELECT * EXCLUDE ({_dq(CERTIFIED_BEDS)}, {_dq(OVERALL_RATING)}, \"Provider Name\"), "
                          f"CAST({_dq(CERTIFIED_BEDS)} AS INTEGER) AS beds, CAST({_dq(OVERALL_RATING)} AS DOUBLE) AS "
                          "overall_rating, \"Provider Name\" AS facility FROM b_provider", "b_provider"),
    "ingest_stamp": _sql(f"SELECT *, TIMESTAMP '{FIXED_TS}' AS {INGESTED_AT} FROM state_avg", "state_avg"),
    "view_hours_census": _views(["PROVNUM", "Tot_Nurse_hrs", "MDScensus"]),
    "view_occupancy": _views(["PROVNUM", "occup_rate"]),
    "view_rating": _views(["PROVNUM", "overall_rating"]),
    "view_staff_mix": _views(["PROVNUM", "perm_staff", "temp_staff"]),
    "view_table": _views(["STATE", "PROVNUM", "PROVNAME", "MDScensus", "Tot_Nurse_hrs", "occup_rate",
                          "overall_rating"]),
    "filter_state": _sql(_DASH_FILTER, "dash"),
    "filter_provnum": _sql(f"SELECT * FROM dash WHERE PROVNUM = '{SEL_PROVNUM}'", "dash"),
    "filter_provname": _sql(f"SELECT * FROM dash WHERE PROVNAME = '{SEL_PROVNAME}'", "dash"),
    "filter_cascade": _sql(f"{_DASH_FILTER} AND PROVNUM = '{SEL_PROVNUM}' AND PROVNAME = '{SEL_PROVNAME}'", "dash"),
    "empty_check": _sql(_EMPTY_SQL, "dash"),
    "left_join_provider": _sql("SELECT * FROM j_provider", "j_provider"),
    "left_join_state": _sql("SELECT * FROM j_state", "j_state"),
    "tot_nurse_hrs": _metric_sql("Tot_Nurse_hrs", TOTAL_PARTS, False),
    "perm_staff": _metric_sql("perm_staff", PERM_PARTS, False),
    "temp_staff": _metric_sql("temp_staff", TEMP_PARTS, False),
    "tot_nurse_hrs_strict": _metric_sql("Tot_Nurse_hrs", TOTAL_PARTS, True),
    "perm_staff_strict": _metric_sql("perm_staff", PERM_PARTS, True),
    "temp_staff_strict": _metric_sql("temp_staff", TEMP_PARTS, True),
    "occup_rate": _sql(f"SELECT PROVNUM, MDScensus, _p_beds AS beds, {fs.occup_rate_sql('MDScensus', '_p_beds')} "
                       "AS occup_rate FROM j_provider", "j_provider"),
    "dim_carry": _sql("SELECT PROVNUM, occup_limit, Avg_residents_per_day, Avg_tot_nurse_hrs_per_resident_per_day, "
                      "overall_rating FROM gold", "gold"),
    "provider_rollup": _sql("SELECT * FROM rollup", "rollup"),
    "options_state": _ranked("STATE", "STATE IS NOT NULL"),
    "options_provnum": _ranked("PROVNUM", f"STATE = '{SEL_STATE}' AND PROVNUM IS NOT NULL"),
    "options_provname": _ranked("PROVNAME", f"STATE = '{SEL_STATE}' AND PROVNUM = '{SEL_PROVNUM}' AND PROVNAME IS NOT NULL"),
    "minmax_rollup": _sql(_minmax_sql("SELECT * FROM rollup"), "rollup"),
    "dashboard_page": _sql(_page_sql(f"SELECT * FROM rollup WHERE STATE = '{SEL_STATE}' ORDER BY {fs.ORDER_ROLLUP} LIMIT 10"),
                           "rollup"),
    "minmax_scale": _sql(_minmax_sql(), "top20"),
    "sorted_rollup": _sql(f"SELECT *, row_number() OVER (ORDER BY {fs.ORDER_ROLLUP}) AS rank FROM rollup", "rollup"),
    "topk_providers": _sql(fs.top_select(50), "rollup"),
    "fn_strip": _sql(f"SELECT PROVNUM AS raw_provnum, {fs.strip('PROVNUM')} AS provnum, {fs.strip('STATE')} AS state "
                     "FROM staffing", "staffing"),
    "fn_strip_zeros": _sql(f"SELECT {_dq(CCN)} AS raw_ccn, NULLIF(ltrim({fs.strip(_dq(CCN))}, '0'), '') AS ccn "
                           "FROM provider", "provider"),
    "fn_upper": _sql(f"SELECT {_dq(STATE_KEY)} AS raw_key, upper({_dq(STATE_KEY)}) AS upper_key FROM state_avg",
                     "state_avg"),
    "fn_to_text": _sql(f"SELECT COALESCE({_dq(CERTIFIED_BEDS)}, 'nan') AS beds_text, "
                       f"COALESCE({_dq(OVERALL_RATING)}, 'nan') AS rating_text FROM provider", "provider"),
    "coerce_numeric": _sql("SELECT PROVNUM, " + ", ".join(f"{fs.to_number(_dq(c))} AS {_dq(c)}"
                                                          for c in (CENSUS, *TOTAL_PARTS)) + " FROM staffing",
                           "staffing"),
    "sql_over_frames": _sql("SELECT * FROM gold", "gold"),
    "dq_column_count": _sql(_dq_sql(DQ_RULES), "gold"),
    "dq_outcomes": _sql(_dq_sql(DQ_PUBLISHED_RULES), "gold"),
    "bronze_provider": _sql("SELECT * FROM b_provider", "b_provider"),
    "bronze_state": _sql("SELECT * FROM b_state", "b_state"),
    "bronze_staffing": _sql("SELECT * FROM b_staffing", "b_staffing"),
    "gold": _sql("SELECT * FROM gold", "gold"),
    "gold_normalized_keys": _gold_norm_sql(),
    "dashboard_topk": _sql("SELECT * FROM top20", "top20"),
    "dashboard_state_topk": _sql(f"SELECT * FROM rollup WHERE STATE = '{SEL_STATE}' ORDER BY {fs.ORDER_ROLLUP} LIMIT 5",
                                 "rollup"),
    "view_table_scaled": _sql(_minmax_sql("SELECT STATE, PROVNUM, PROVNAME, MDScensus, Tot_Nurse_hrs, occup_rate, "
                                          "overall_rating FROM top20"), "top20"),
    "gold_strict": _sql("SELECT * FROM gold_strict", "gold_strict"),
}

QUERIES |= event_queries.QUERIES | analysis_queries.QUERIES
ORACLE |= event_queries.ORACLE | analysis_queries.ORACLE

assert set(ORACLE) == set(QUERIES), set(QUERIES) ^ set(ORACLE)
