"""Scans, sinks, snapshots, discovery and incremental ingest (S1-S9, K1-K3; T16, T17, T20)."""

import os

from urllib.parse import unquote
import pytest
from pyspark.sql import functions as F

from carelens.sources.csv import read_csv, read_csv_tolerant
from carelens.sources.discovery import latest_snapshot_path, list_files, read_discovered, read_latest
from carelens.sources.sinks import in_part, write_bronze, write_csv, write_gold, write_snapshot
from carelens.streaming.incremental import ingest_incremental


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_latin1_landing(spark, scratch):
    d = _local(scratch("latin1"))
    os.makedirs(d)
    with open(f"{d}/p.csv", "wb") as f:
        f.write("Provider Name,City/Town\nPeña,José\n".encode("latin-1"))
    df = read_csv(spark, f"{d}/p.csv", encoding="ISO-8859-1")
    assert [tuple(r) for r in df.collect()] == [("Peña", "José")]
    # written back as UTF-8 and re-read as UTF-8, accents survive
    out = scratch("latin1_out")
    write_csv(df, out)
    assert [tuple(r) for r in read_csv(spark, out).collect()] == [("Peña", "José")]


def test_blanks_survive_csv_round_trip(spark, scratch):
    df = spark.createDataFrame([(" a ", "b  ", "  c")], "x string, y string, z string")
    path = scratch("blanks")
    write_bronze(df, path, fmt="csv")
    assert [tuple(r) for r in read_csv(spark, path).collect()] == [(" a ", "b  ", "  c")]


def test_declared_schema_no_inference(spark, scratch):
    df = spark.createDataFrame([("015009", "1.5")], "PROVNUM string, v string")
    path = scratch("typed")
    write_csv(df, path)
    back = read_csv(spark, path, schema="PROVNUM string, v double")
    assert back.collect()[0]["PROVNUM"] == "015009" and back.collect()[0]["v"] == 1.5


def test_tolerant_scan_quarantines_bad_rows(spark, scratch):
    df = spark.createDataFrame([("a", "1.5"), ("b", "x?"), ("c", None)], "k string, v string")
    path = scratch("tolerant")
    write_csv(df, path)
    with open(f"{_local(path)}/ragged.csv", "w") as f:
        f.write("k,v\nd,1,2\n")
    good, bad, failed = read_csv_tolerant(spark, path, "k string, v double")
    assert sorted(r["k"] for r in good.collect()) == ["a", "c"]
    # the verdict does not hang on what is selected
    assert sorted(r["k"] for r in good.select("k").collect()) == ["a", "c"] and good.count() == 2 and bad.count() == 2
    assert sorted((r["k"], r["v"]) for r in bad.select("k", "v").collect()) == [("b", "x?"), ("d", "1")]
    assert failed.count() == 0


def test_tolerant_scan_lists_broken_files_and_takes_nothing_of_them(spark, scratch):
    import gzip
    d = _local(scratch("broken"))
    os.makedirs(d)
    raw = gzip.compress(("k,v\n" + "".join(f"x{i},{i}\n" for i in range(50_000))).encode())
    with open(f"{d}/cut.csv.gz", "wb") as f:
        f.write(raw[: len(raw) // 2])
    with open(f"{d}/whole.csv.gz", "wb") as f:
        f.write(gzip.compress(b"k,v\na,1\n") + gzip.compress(b"b,2\nc,no\n"))
    good, bad, failed = read_csv_tolerant(spark, d, "k string, v double")
    assert sorted(r["k"] for r in good.collect()) == ["a", "b"] and [r["k"] for r in bad.collect()] == ["c"]
    assert [r["path"].split("/")[-1] for r in failed.collect()] == ["cut.csv.gz"]


@pytest.mark.parametrize("codec", ["gzip", "bzip2", "deflate"])
def test_every_checked_codec_is_read_to_its_end(spark, scratch, codec):
    """Several cut files among whole ones, one of a name with blanks and signs; the first by name is cut too."""
    path = scratch("codecs")
    write_csv(spark.range(30_000).selectExpr("concat('k', id) AS k", "CAST(id AS STRING) AS v").repartition(6), path, compression=codec)
    d = _local(path)
    files = sorted(f for f in os.listdir(d) if f.startswith("part-"))
    os.rename(f"{d}/{files[4]}", f"{d}/part-x [a] 100%.{files[4].split('.', 1)[1]}")
    files = sorted(f for f in os.listdir(d) if f.startswith("part-"))
    whole = {f: open(f"{d}/{f}", "rb").read() for f in files}
    for f in (files[0], files[2], files[5]):
        with open(f"{d}/{f}", "wb") as out:
            out.write(whole[f][: 2 * len(whole[f]) // 3])
    for f in os.listdir(d):
        if f.endswith(".crc"):
            os.remove(f"{d}/{f}")
    good, bad, failed = read_csv_tolerant(spark, path, "k string, v long")
    assert sorted(unquote(r["path"]).split("/")[-1] for r in failed.collect()) == [files[0], files[2], files[5]]
    assert 0 < good.count() < 30_000 and bad.count() == 0
    assert "_metadata" not in good.columns


def test_codecs_that_hide_a_missing_end_are_refused(spark, scratch):
    path = scratch("hides")
    write_csv(spark.range(1000).selectExpr("id AS k"), path, compression="snappy")
    with pytest.raises(ValueError, match="codec"):
        read_csv_tolerant(spark, path, "k long")
    write_csv(spark.range(10).selectExpr("id AS k"), path, mode="append")
    good, bad, failed = read_csv_tolerant(spark, path, "k long", unchecked="list")
    assert good.count() == 10 and failed.count() >= 1


def test_columns_are_bound_by_header(spark, scratch):
    d = _local(scratch("header"))
    os.makedirs(d)
    with open(f"{d}/x.csv", "w") as f:
        f.write("b,a\nB1,A1\n")
    assert [tuple(r) for r in read_csv(spark, f"{d}/x.csv", schema="a string, b string").collect()] == [("A1", "B1")]
    with open(f"{d}/y.csv", "w") as f:
        f.write("a,b\nA2,B2\n")
    with pytest.raises(Exception):  # two orders in one folder
        read_csv(spark, d).collect()
    with pytest.raises(ValueError):
        read_csv(spark, f"{d}/x.csv", schema="a string, z string")


def test_ragged_rows(spark, scratch):
    d = _local(scratch("ragged"))
    os.makedirs(d)
    with open(f"{d}/short.csv", "w") as f:
        f.write('a,b,c\n1,"x,y"\n4,5,6\n')
    assert sorted(map(tuple, read_csv(spark, f"{d}/short.csv").collect())) == [("1", "x,y", None), ("4", "5", "6")]
    with open(f"{d}/long.csv", "w") as f:
        f.write("a,b\n1,2,3\n")
    with pytest.raises(Exception, match="malformed CSV row"):
        read_csv(spark, f"{d}/long.csv").select("a").collect()
    with open(f"{d}/broken.csv", "w") as f:
        f.write('a,b\n1,"12 Main\nSuite 4"\n')
    with pytest.raises(Exception, match="malformed CSV row"):
        read_csv(spark, f"{d}/broken.csv").collect()


def test_snapshots_newest_whole(spark, scratch):
    root = scratch("snap")
    old = spark.range(5).withColumn("run", F.lit(1))
    new = spark.range(7).withColumn("run", F.lit(2)).repartition(3)
    f1 = write_snapshot(old, root)
    # an empty file in the older run must not count
    open(_local(f1) + "/part-empty.parquet", "wb").close()
    f2 = write_snapshot(new, root)
    assert latest_snapshot_path(spark, root).rstrip("/").split("/")[-1] == f2.split("/")[-1]
    got = read_latest(spark, root)
    assert got.count() == 7 and {r["run"] for r in got.collect()} == {2}
    files = list_files(spark, f2, name_contains="part-")
    assert files.count() == 3


def test_snapshot_missing_raises(spark, scratch):
    d = _local(scratch("empty"))
    os.makedirs(d)
    with pytest.raises(Exception):
        latest_snapshot_path(spark, d)


def test_discovery_filters_names_and_sizes(spark, scratch):
    folder = scratch("disc")
    write_csv(spark.range(10).selectExpr("CAST(id AS STRING) AS id"), folder, mode="append")
    spark.range(3).write.mode("append").json(folder)
    open(_local(folder) + "/part-zero.csv", "wb").close()
    files = list_files(spark, folder, name_contains=".csv")
    assert files.filter(F.col("length") == 0).count() == 0
    assert all(r["name"].endswith(".csv") for r in files.collect())
    assert read_discovered(spark, folder, name_contains=".csv").count() == 10
    with pytest.raises(FileNotFoundError):
        read_discovered(spark, folder, name_contains="part-r-")


def test_gold_append_and_partitioned(spark, scratch):
    df = spark.createDataFrame([("AL", 1.0), ("TX", 2.0), ("AL", 3.0)], "STATE string, v double")
    path = scratch("gold_part")
    write_gold(df, path, partition_by=("STATE",))
    write_gold(df, path, partition_by=("STATE",))
    back = spark.read.parquet(path)
    assert back.count() == 6
    one = in_part(back, "STATE", "AL")
    assert one.count() == 4
    assert "(part_STATE" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]


def test_partitioned_keys_keep_their_text(spark, scratch):
    rows = [("015009", "01"), ("15009", ""), (None, None), ("1e3", " 1 ")]
    root = scratch("text_parts")
    write_snapshot(spark.createDataFrame(rows, "PROVNUM string, STATE string"), root, partition_by=("STATE", "PROVNUM"))
    got = read_latest(spark, root)
    assert got.columns == ["PROVNUM", "STATE"] and sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)


def test_partitioned_folder_without_runs_is_one_snapshot(spark, scratch):
    root = scratch("leaves")
    write_gold(spark.createDataFrame([("AL", 1), ("TX", 2), ("ST", 3)], "STATE string, v int"), f"{root}/gold", partition_by=("STATE",))
    assert read_latest(spark, root).count() == 3


def test_newest_run_by_commit_time(spark, scratch):
    root = scratch("runs")
    write_snapshot(spark.range(2), root, run_id="run9")
    write_snapshot(spark.range(3), root, run_id="run10")
    assert read_latest(spark, root).count() == 3
    with pytest.raises(FileNotFoundError):
        latest_snapshot_path(spark, root, name_contains="nothing-has-this", committed_only=True)


@pytest.mark.parametrize("rows, files", [(5, 3), (2000, 20)])
def test_files_of_the_newest_snapshot_grow_with_the_table(spark, tmp_path, monkeypatch, rows, files):
    from carelens import queries
    monkeypatch.setattr(queries, "FILE_ROWS", 100, raising=False)
    (spark.range(rows).selectExpr("id AS l_orderkey", "id AS l_suppkey", "CAST(id % 7 AS INT) AS l_linenumber", "1D AS l_quantity", "0.5D AS l_tax",
                                  "0.1D AS l_discount", "'N' AS l_returnflag").write.parquet(f"{tmp_path}/lineitem.parquet"))
    got = queries.q_latest_snapshot(spark, str(tmp_path))
    assert got.count() == rows and got.where("PROVNAME = 'older'").isEmpty()
    per_file = got.groupBy(F.input_file_name()).count().agg(F.count("*"), F.max("count")).first()
    assert per_file[0] == files and per_file[1] <= 110


def test_back_filled_files_are_ingested_and_counted(spark, scratch, monkeypatch):
    base = scratch("old_dates")
    landing, sink, ckpt = f"{base}/landing", f"{base}/sink", f"{base}/_ckpt"
    spark.range(5).coalesce(1).write.parquet(landing)
    schema = spark.range(1).schema
    assert ingest_incremental(spark, landing, sink, ckpt, schema) == 5
    spark.range(100, 107).repartition(7).write.mode("append").parquet(landing)
    for f in os.listdir(_local(landing)):
        os.utime(f"{_local(landing)}/{f}", (1, 1)) if f.startswith("part-") and os.path.getmtime(f"{_local(landing)}/{f}") > 1 else None
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        assert ingest_incremental(spark, landing, sink, ckpt, schema, max_files_per_trigger=1) == 7
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert spark.read.parquet(sink).count() == 12


def test_name_rule_is_text_not_a_glob(spark, scratch):
    folder = scratch("names")
    d = _local(folder)
    os.makedirs(d)
    for name in ("a[1].csv", "a1.csv"):
        with open(f"{d}/{name}", "w") as f:
            f.write(f"x\n{name}\n")
    assert [r["x"] for r in read_discovered(spark, folder, name_contains="[1]").collect()] == ["a[1].csv"]


def test_incremental_twice_is_once(spark, scratch):
    base = scratch("inc")
    landing, sink, ckpt = f"{base}/landing", f"{base}/sink", f"{base}/_ckpt"
    df1 = spark.range(0, 100).withColumn("v", F.col("id") * 2)
    df1.write.mode("append").parquet(landing)
    assert ingest_incremental(spark, landing, sink, ckpt, df1.schema) == 100
    assert ingest_incremental(spark, landing, sink, ckpt, df1.schema) == 0
    spark.range(100, 130).withColumn("v", F.col("id") * 2).write.mode("append").parquet(landing)
    assert ingest_incremental(spark, landing, sink, ckpt, df1.schema) == 30
    out = spark.read.parquet(sink)
    assert out.count() == 130 and out.select("id").distinct().count() == 130


def test_incremental_csv_with_bronze_transform(spark, scratch):
    from carelens.plans.bronze import bronze_staffing
    from tests.edge_tables import FACT_COLS, STAFFING
    base = scratch("inc_csv")
    landing, sink, ckpt = f"{base}/landing", f"{base}/sink", f"{base}/_ckpt"
    schema = ", ".join(f"`{c}` string" for c in FACT_COLS)
    write_csv(spark.createDataFrame(STAFFING, schema), landing, mode="append")
    n = ingest_incremental(spark, landing, sink, ckpt, spark.createDataFrame([], schema).schema, fmt="csv",
                           transform=lambda s: bronze_staffing(s, ts="2024-10-01 00:00:00"))
    assert n == len(STAFFING)
    out = spark.read.parquet(sink)
    assert "bronze_ingested_at" in out.columns
    assert out.filter("PROVNUM = '15009'").count() == 3


def test_uncommitted_snapshot_is_ignored(spark, scratch):
    root = scratch("commit")
    good = write_snapshot(spark.range(4), root)
    # a later run that died after writing some files, before its commit record
    spark.range(100).write.parquet(f"{root}/run_id=29991231T000000.000000-dead")
    assert latest_snapshot_path(spark, root).rstrip("/").split("/")[-1] == good.split("/")[-1]
    assert read_latest(spark, root).count() == 4
    # without the commit table the file-time rule applies (foreign layouts)
    assert latest_snapshot_path(spark, root, committed_only=False).endswith("-dead")


def test_quoted_line_breaks_need_multi_line(spark, scratch):
    d = _local(scratch("multiline"))
    os.makedirs(d)
    with open(f"{d}/p.csv", "wb") as f:
        f.write('Provider Name,Provider Address\n"Peña Care","12 Main St\nSuite 4"\nOther,"1 Road"\n'.encode("latin-1"))
    rows = read_csv(spark, f"{d}/p.csv", encoding="ISO-8859-1", multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("Peña Care", "12 Main St\nSuite 4"), ("Other", "1 Road")]
    import pandas as pd
    assert pd.read_csv(f"{d}/p.csv", encoding="latin-1").shape[0] == len(rows)
