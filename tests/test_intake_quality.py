"""Intake manifest rules (S7, S8) and data-quality outcomes."""

from pyspark.sql import functions as F

from carelens.operators.quality import check, observed, publish
from carelens.schemas import MIME_CSV, MIME_FOLDER, MIME_SHEET
from carelens.sources.intake import classify_intake, intake, resolve_shortcuts

MANIFEST_SCHEMA = ("id string, name string, mimeType string, "
                   "shortcutDetails struct<targetId: string, targetMimeType: string>")


def _manifest(spark):
    rows = [
        ("1", "sub", MIME_FOLDER, None),
        ("2", "Budget", MIME_SHEET, None),
        ("3", "Budget.CSV", MIME_SHEET, None),
        ("4", "staff.csv", "application/octet-stream", None),
        ("5", "DATA.CsV", "text/plain", None),
        ("6", "export", MIME_CSV, None),
        ("7", "notes.txt", "text/plain", None),
        ("8", "link", "application/vnd.google-apps.shortcut", ("99", MIME_SHEET)),
    ]
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def test_classify_intake(spark):
    got = {r["id"]: (r["action"], r["target_key"]) for r in classify_intake(_manifest(spark)).collect()}
    assert got["1"] == ("skip_folder", None)
    assert got["2"] == ("export", "data/Budget.csv")
    assert got["3"] == ("export", "data/Budget.CSV")
    assert got["4"] == ("download", "data/staff.csv")
    assert got["5"] == ("download", "data/DATA.CsV")
    assert got["6"] == ("download", "data/export")
    assert got["7"] == ("skip_other", None)
    assert sorted(r["id"] for r in intake(_manifest(spark)).collect()) == ["2", "3", "4", "5", "6"]


def test_resolve_shortcuts(spark):
    got = {r["id"]: r for r in resolve_shortcuts(_manifest(spark)).collect()}
    assert (got["8"]["target_id"], got["8"]["target_mime"], got["8"]["export"]) == ("99", MIME_SHEET, True)
    assert got["8"]["target_key"] == "downloaded_tables/link.csv"
    assert got["2"]["target_id"] == "2" and got["2"]["target_key"] == "downloaded_tables/Budget.csv"
    # exact-case '.csv' check for the single-file copier
    assert got["3"]["target_key"] == "downloaded_tables/Budget.CSV.csv"


def test_dq_rules(spark, scratch):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0)], "k string, v double")
    rules = (("ColumnCount", ">", 0), ("RowCount", ">=", 3), ("IsComplete", "v"), ("IsUnique", "k"))
    out = {r["rule"]: (r["outcome"], r["metric"]) for r in check(df, rules).collect()}
    assert out["ColumnCount > 0"] == ("Passed", 2.0)
    assert out["RowCount >= 3"] == ("Passed", 3.0)
    assert out['IsComplete "v"'][0] == "Failed" and abs(out['IsComplete "v"'][1] - 2 / 3) < 1e-12
    assert out['IsUnique "k"'] == ("Failed", 1.0)
    path = scratch("dq")
    publish(check(df, rules), path)
    assert spark.read.parquet(path).count() == 4


def test_observation_during_write(spark):
    df = spark.range(10).withColumn("v", F.when(F.col("id") % 2 == 0, F.col("id")))
    o, obs = observed(df, cols=("v",))
    o.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 10, "non_null:v": 5}
