"""Scalar functions on the edge tables of FIXTURES.md §4 (traps T1-T4, T6, T13, T14)."""

import math

from pyspark.sql import functions as F

from carelens.functions.numeric import add_parts, num, to_number
from carelens.functions.text import strip, strip_zeros, to_text, upper
from carelens.sources.csv import normalize_missing

KEYS = [" 015009 ", "015009", "15009", "15E009", "01A193", "000000", "\t015009\u00a0", None]


def _one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_strip_is_unicode_aware(spark):
    got = [r[0] for r in _one_col(spark, KEYS).select(strip("v")).collect()]
    assert got == ["015009", "015009", "15009", "15E009", "01A193", "000000", "015009", None]
    # Python's str.strip agrees on every non-null key
    assert got[:-1] == [k.strip() for k in KEYS[:-1]]


def test_strip_equals_python_strip_on_every_space(spark):
    from carelens.functions.text import PY_WHITESPACE
    vals = [f"{c}k{c}" for c in PY_WHITESPACE] + ["\u200bk", "k\u00ad"]  # zero-width / soft hyphen are not space
    got = [r[0] for r in _one_col(spark, vals).select(strip("v")).collect()]
    assert got == [v.strip() for v in vals]


def test_strip_zeros_and_all_zero_key(spark):
    got = [r[0] for r in _one_col(spark, KEYS).select(strip_zeros(strip("v"))).collect()]
    assert got == ["15009", "15009", "15009", "15E009", "1A193", None, "15009", None]


def test_keys_stay_text_no_inference(spark, scratch):
    from carelens.sources.csv import read_csv
    from carelens.sources.sinks import write_csv
    path = scratch("keys")
    write_csv(_one_col(spark, KEYS[:-1], "PROVNUM"), path)
    back = read_csv(spark, path, string_cols=["PROVNUM"])
    assert dict(back.dtypes)["PROVNUM"] == "string"
    assert sorted(r[0] for r in back.collect()) == sorted(KEYS[:-1])


def test_upper_and_to_text(spark):
    df = _one_col(spark, [" al ", None])
    assert [r[0] for r in df.select(upper(strip("v"))).collect()] == ["AL", None]
    assert [r[0] for r in df.select(to_text("v", "nan")).collect()] == [" al ", "nan"]
    assert [r[0] for r in df.select(to_text("v")).collect()] == [" al ", None]


def test_missing_tokens(spark):
    toks = ["", "NA", "N/A", "NULL", "null", "None", "nan", "-", "0", "#N/A", "n/a", "<NA>"]
    out = [r[0] for r in normalize_missing(_one_col(spark, toks)).collect()]
    assert out == [None, None, None, None, None, None, None, "-", "0", None, None, None]


def test_missing_tokens_leave_numbers_alone(spark):
    df = spark.createDataFrame([(1, "NA")], "n int, s string")
    out = normalize_missing(df).collect()[0]
    assert out["n"] == 1 and out["s"] is None


NUMBERS = ["12.5", " 5 ", "1e3", "inf", "NaN", "1,234", "1.0d", "5f", "x?", None, "-2", ".5", "+7."]


def test_to_number_matches_pandas_to_numeric(spark):
    import pandas as pd
    got = [r[0] for r in _one_col(spark, NUMBERS).select(to_number("v")).collect()]
    want = pd.to_numeric(pd.Series(NUMBERS, dtype=object), errors="coerce").tolist()
    for g, w in zip(got, want):
        if w is None or (isinstance(w, float) and math.isnan(w)):
            assert g is None  # NaN is turned into NULL so aggregates skip it
        else:
            assert g == w


def test_num_is_legacy_cast(spark):
    # gold's CAST(COALESCE(x, 0) AS DOUBLE) with the legacy cast: missing -> 0, malformed -> NULL
    got = [r[0] for r in _one_col(spark, ["1.5", None, "x?", "", " 2 "]).select(num("v", "0")).collect()]
    assert got == [1.5, 0.0, None, None, 2.0]


def test_add_parts_null_safe_vs_strict(spark):
    df = spark.createDataFrame([("1", "2", None), ("1", "x?", "3"), ("1", "2", "3")], "a string, b string, c string")
    safe = [r[0] for r in df.select(add_parts(["a", "b", "c"])).collect()]
    strict = [r[0] for r in df.select(add_parts(["a", "b", "c"], strict=True)).collect()]
    assert safe == [3.0, None, 6.0]
    assert strict == [None, None, 6.0]
    # property: strict is NULL or equal to the null-safe sum
    assert all(s is None or s == n for s, n in zip(strict, safe))


def test_functions_stay_in_jvm(spark):
    df = _one_col(spark, NUMBERS).select(to_number("v"), strip("v"), strip_zeros("v"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_text_and_column_forms_agree(spark):
    from carelens.functions.numeric import add_parts_columns
    vals = KEYS + NUMBERS
    df = spark.createDataFrame([(v, v, v) for v in vals], "v string, a string, b string")
    pairs = [
        (strip("v"), strip(F.col("v"))),
        (strip_zeros("v"), strip_zeros(F.col("v"))),
        (to_text("v", "nan"), to_text(F.col("v"), "nan")),
        (num("v", "0"), num(F.col("v"), "0")),
        (to_number("v"), to_number(F.col("v"))),
        (add_parts(["a", "b"]), add_parts_columns(["a", "b"])),
        (add_parts(["a", "b"], strict=True), add_parts_columns(["a", "b"], strict=True)),
    ]
    for i, (x, y) in enumerate(pairs):
        got = df.select(x.alias("x"), y.alias("y")).collect()
        for r in got:
            same = (r["x"] == r["y"]) or (r["x"] != r["x"] and r["y"] != r["y"])  # NaN == NaN
            assert same, (i, r)
