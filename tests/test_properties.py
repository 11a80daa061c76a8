"""Property tests: pandas-style numeric parsing, strip, NA tokens."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from carelens.functions.numeric import to_number
from carelens.functions.text import PY_WHITESPACE, strip

_parts = st.sampled_from(["", "+", "-", " ", "\t", "0", "7", "12", "3.", ".5", "1.25", "e", "E", "e-2", "E+3",
                          "inf", "Infinity", "nan", "NaN", "d", "f", ",", "_", "x", "1,000", "0x1p3", "٣"])
numeric_like = st.lists(_parts, min_size=1, max_size=5).map("".join)


def _pandas(values):
    out = pd.to_numeric(pd.Series(values, dtype=object), errors="coerce").tolist()
    return [None if (v is None or (isinstance(v, float) and math.isnan(v))) else float(v) for v in out]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(numeric_like, min_size=20, max_size=40))
def test_to_number_agrees_with_pandas(spark, values):
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(to_number("v")).collect()]
    for v, g, w in zip(values, got, _pandas(values)):
        assert (g is None and w is None) or (g is not None and w is not None and (g == w or abs(g - w) <= 1e-12 * abs(w))), (v, g, w)


_ws = st.sampled_from(list(PY_WHITESPACE) + ["a", "b", "0", " ", "​"])


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(_ws, max_size=6).map("".join), min_size=10, max_size=30))
def test_strip_agrees_with_python(spark, values):
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(strip("v")).collect()]
    assert got == [v.strip() for v in values]
