"""Driver tables in the roles of the pipeline's inputs (FIXTURES.md §3).

lineitem -> staffing landing, supplier -> provider-info landing,
nation -> state-averages landing, pages -> a file manifest, events -> files
arriving by day.  Every role is a lazy projection of the driver's parquet,
so its size grows with the scale factor.  The matching DuckDB text lives in
:mod:`carelens.fixtures_sql`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.sources.scan import spread
from carelens.utils import q
from carelens.schemas import (
    CCN, CERTIFIED_BEDS, MIME_CSV, MIME_FOLDER, MIME_SHEET, OVERALL_RATING, PERM_PARTS, PROV_STATE,
    PROVIDER_INFO_COLS, ST_AVG_NURSE_HRS, ST_AVG_RESIDENTS, STATE_AVG_COLS, STATE_KEY, TEMP_PARTS,
)


# Tables whose rows the pipeline works through one by one (the fact side).
FACT_TABLES = ("lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in FACT_TABLES else df


def _s(c: Column) -> Column:
    return c.cast("string")


def staffing_landing(lineitem: DataFrame) -> DataFrame:
    """Daily staffing facts, all text: padded keys (every 5th supplier also
    zero-padded), a malformed RN value, missing parts.  Facilities share names
    (key % 40) and have a second one on some lines; some lines name the next
    state; some censuses are missing tokens."""
    qty = "CAST(l_quantity AS INT)"
    sk = "CAST(l_suppkey AS STRING)"
    cols = [
        f"concat(' ', CASE WHEN l_suppkey % 5 = 0 THEN lpad({sk}, 6, '0') ELSE {sk} END, ' ') AS PROVNUM",
        "concat('Provider ', CAST(l_suppkey % 40 AS STRING), CASE WHEN l_linenumber = 6 THEN ' West' ELSE '' END) "
        "AS PROVNAME",
        "concat(' st', CAST((l_suppkey + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) % 25 AS STRING), ' ') AS STATE",
        f"CASE WHEN l_linenumber = 2 THEN NULL WHEN l_orderkey % 89 = 0 THEN 'N/A' WHEN l_orderkey % 83 = 0 THEN 'null' "
        f"ELSE CAST({qty} AS STRING) END AS MDScensus",
        f"CASE WHEN l_linenumber = 3 THEN NULL WHEN l_orderkey % 97 = 0 THEN 'x?' "
        f"ELSE CAST({qty} AS STRING) END AS Hrs_RN",
        "CASE WHEN l_linenumber <> 4 THEN CAST(l_tax AS STRING) END AS Hrs_LPN",
        "CAST(l_discount AS STRING) AS Hrs_CNA",
    ]
    cols += [f"CAST({qty} % {m} AS STRING) AS {n}" for m, n in zip(range(2, 9), PERM_PARTS)]
    cols += [f"CAST(l_linenumber % {m} AS STRING) AS {n}" for m, n in zip(range(2, 8), TEMP_PARTS[:-1])]
    cols.append(f"CASE WHEN l_returnflag <> 'R' THEN CAST(l_linenumber % 8 AS STRING) END AS {TEMP_PARTS[-1]}")
    return lineitem.selectExpr(*cols)


def _fill(df: DataFrame, known: dict[str, str], order, extra: dict[str, str]) -> DataFrame:
    """One ``selectExpr``: every name of ``order`` (its SQL from ``known``, else
    NULL text), then ``extra``."""
    out = [f"{known.get(c, 'CAST(NULL AS STRING)')} AS {q(c)}" for c in order]
    out += [f"{e} AS {q(c)}" for c, e in extra.items()]
    return df.selectExpr(*out)


def provider_landing(supplier: DataFrame, extra: bool = False) -> DataFrame:
    """Provider info, 63 text columns (unused ones NULL).  Suppliers with key
    % 7 = 0 have a key of another kind, so their facts find no provider; beds are
    '0' or missing for some, rating missing for some.  ``extra`` appends raw
    columns not on the retention list."""
    known = {
        CCN: "concat(' ', CASE WHEN s_suppkey % 7 = 0 THEN 'X' ELSE '' END, lpad(CAST(s_suppkey AS STRING), 6, '0'))",
        "Provider Name": "s_name",
        PROV_STATE: "concat('ST', CAST(s_nationkey AS STRING))",
        CERTIFIED_BEDS: "CASE WHEN s_suppkey % 11 = 0 THEN '0' WHEN s_suppkey % 13 = 0 THEN NULL "
                        "ELSE CAST(20 + s_suppkey AS STRING) END",
        OVERALL_RATING: "CASE WHEN s_suppkey % 9 <> 0 THEN CAST(1 + s_suppkey % 5 AS STRING) END",
    }
    extra_cols = {"Account Balance": "CAST(s_acctbal AS STRING)", "Source Row": "CAST(s_suppkey AS STRING)"}
    return _fill(supplier, known, PROVIDER_INFO_COLS, extra_cols if extra else {})


def state_landing(nation: DataFrame, extra: bool = False) -> DataFrame:
    """State averages, 42 text columns: one row per nation, the last one's
    under a key that no provider has, plus one national row."""
    known = {
        STATE_KEY: "concat(' st', CAST(n_nationkey AS STRING), CASE WHEN n_nationkey = 24 THEN 'x ' ELSE ' ' END)",
        ST_AVG_RESIDENTS: "CAST(50 + n_nationkey AS STRING)",
        ST_AVG_NURSE_HRS: "CAST(3 + n_nationkey % 4 AS STRING)",
    }
    national = {STATE_KEY: "'Nation'", ST_AVG_RESIDENTS: "'60'", ST_AVG_NURSE_HRS: "'4'"}
    states = _fill(nation, known, STATE_AVG_COLS,
                   {"Region Key": "CAST(n_regionkey AS STRING)"} if extra else {})
    # The national row: one global aggregate over nation yields exactly one row.
    nation_row = _fill(nation.agg(F.count(F.lit(1)).alias("_n")), national, STATE_AVG_COLS,
                       {"Region Key": "CAST(NULL AS STRING)"} if extra else {})
    return states.unionByName(nation_row)


def file_manifest(pages: DataFrame) -> DataFrame:
    """A drive-style file listing: page_id % 4 picks folder / sheet / csv / other;
    every third entry is a shortcut to the next page id."""
    pid = F.col("page_id")
    sid = _s(pid)
    kind = pid % 4
    leaf = F.regexp_extract(F.col("url"), r"/([^/?#]+)(?:[?#].*)?$", 1)
    name = (F.when(kind == 0, F.concat(F.lit("folder_"), sid))
            .when(kind == 1, F.when(pid % 8 == 1, F.concat(F.lit("sheet_"), sid, F.lit(".CSV")))
                  .otherwise(F.concat(F.lit("sheet_"), sid)))
            .when(kind == 2, F.when(pid % 8 == 2, F.concat(F.lit("table_"), leaf, F.lit(".Csv")))
                  .otherwise(F.concat(F.lit("table_"), leaf)))
            .otherwise(F.concat(F.lit("page_"), leaf, F.lit(".html"))))
    mime = (F.when(kind == 0, F.lit(MIME_FOLDER))
            .when(kind == 1, F.lit(MIME_SHEET))
            .when(kind == 2, F.when(pid % 8 == 2, F.lit("application/octet-stream")).otherwise(F.lit(MIME_CSV)))
            .otherwise(F.lit("text/html")))
    target_kind = (pid + 1) % 4
    target_mime = (F.when(target_kind == 0, F.lit(MIME_FOLDER)).when(target_kind == 1, F.lit(MIME_SHEET))
                   .when(target_kind == 2, F.lit(MIME_CSV)).otherwise(F.lit("text/html")))
    shortcut = F.when(pid % 3 == 0, F.struct(_s(pid + 1).alias("targetId"), target_mime.alias("targetMimeType")))
    return pages.select(sid.alias("id"), name.alias("name"), mime.alias("mimeType"),
                        shortcut.alias("shortcutDetails"))


ROLE_SOURCES = {"staffing": ("lineitem", staffing_landing), "provider": ("supplier", provider_landing),
                "state": ("nation", state_landing)}


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One landing role ('staffing', 'provider' or 'state')."""
    src, build = ROLE_SOURCES[name]
    return build(table(spark, sf_dir, src))


def roles(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: role(spark, sf_dir, name) for name in ROLE_SOURCES}
