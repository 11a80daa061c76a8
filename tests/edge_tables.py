"""Hand-written landing rows for the traps of FIXTURES.md §4."""

from carelens.schemas import (
    CCN, CERTIFIED_BEDS, OVERALL_RATING, PERM_PARTS, PROV_STATE, PROVIDER_INFO_COLS, ST_AVG_NURSE_HRS,
    ST_AVG_RESIDENTS, STATE_AVG_COLS, STATE_KEY, TEMP_PARTS, TOTAL_PARTS,
)

FACT_COLS = ["PROVNUM", "PROVNAME", "STATE", "MDScensus", *TOTAL_PARTS, *PERM_PARTS, *TEMP_PARTS]

# (CCN, State, beds, rating)
PROVIDERS = [
    (" 015009", "AL", "100", "5"),
    ("015010", "al", "0", "3"),       # provider state not upper-cased -> no state match (T11); zero beds (T9)
    ("15011", "XX", None, None),      # missing beds / rating
    ("015012", None, "abc", "4"),     # malformed beds, no state
    ("000000", "AL", "50", "2"),      # all-zero key -> NULL (T3)
    ("15013", "AL", "80", "1"),       # duplicate key (T12) ...
    ("015013", "AL", "90", "2"),      # ... after zero stripping
]

# (State or Nation, residents/day, nurse hrs/resident/day)
STATES = [(" al ", "50", "3"), ("Nation", "60", "4"), (None, "1", "1"), ("tx", "55", "3.5")]


def fact(provnum, name="F", state=" al ", census="50", rn="8", lpn="4.5", cna="2", emp="1", ctr=None):
    return (provnum, name, state, census, rn, lpn, cna, *([emp] * 7), *([ctr] * 7))


STAFFING = [
    fact(" 15009 "),
    fact(" 15009 ", census=None),                 # missing census: rate 0, skipped by mean (T21)
    fact("15009", census="abc", rn="x?"),         # malformed census and RN (T8, T21)
    fact("015009"),                               # zero-padded fact key: no provider (T2)
    fact("15010", state="\tal ", lpn="NA"),  # zero beds; NA token; unicode blanks in state
    fact("15011", ctr="2"),
    fact("15012", rn=None, lpn=None, cna=None),
    fact("15013"),                                # duplicate provider: two gold rows
    fact(None, name=None, state=None),            # missing keys render as 'nan' (T5)
    fact("99999", census="7", emp="NaN"),         # unknown provider; NaN token
]


def _full(rows, known_cols, order):
    out = []
    for r in rows:
        m = dict(zip(known_cols, r))
        out.append(tuple(m.get(c) for c in order))
    return out


def provider_rows():
    return _full(PROVIDERS, [CCN, PROV_STATE, CERTIFIED_BEDS, OVERALL_RATING], PROVIDER_INFO_COLS)


def state_rows():
    return _full(STATES, [STATE_KEY, ST_AVG_RESIDENTS, ST_AVG_NURSE_HRS], STATE_AVG_COLS)


def spark_frames(spark):
    from pyspark.sql import types as T

    def schema(cols):
        return T.StructType([T.StructField(c, T.StringType()) for c in cols])
    return (spark.createDataFrame(STAFFING, schema(FACT_COLS)),
            spark.createDataFrame(provider_rows(), schema(PROVIDER_INFO_COLS)),
            spark.createDataFrame(state_rows(), schema(STATE_AVG_COLS)))


def pandas_frames():
    import pandas as pd
    return (pd.DataFrame(STAFFING, columns=FACT_COLS, dtype=object),
            pd.DataFrame(provider_rows(), columns=list(PROVIDER_INFO_COLS), dtype=object),
            pd.DataFrame(state_rows(), columns=list(STATE_AVG_COLS), dtype=object))
