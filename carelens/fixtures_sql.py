"""DuckDB text for the fixture roles and the pipeline steps (oracle side).

Each named CTE mirrors one Spark step; :func:`sql` stitches the CTEs a
statement needs in dependency order.  The driver runs these against its
pre-registered views (lineitem, supplier, nation, pages, events, ...).
"""

from __future__ import annotations

from carelens.schemas import (
    CCN, CENSUS, CERTIFIED_BEDS, MIME_CSV, MIME_FOLDER, MIME_SHEET, NA_TOKENS, OVERALL_RATING, PERM_PARTS,
    PROV_STATE, PROVIDER_INFO_COLS, PROVNAME, PROVNUM, ROLLUP_MEASURES, ST_AVG_NURSE_HRS, ST_AVG_RESIDENTS,
    STATE, STATE_AVG_COLS, STATE_KEY, TEMP_PARTS, TOTAL_PARTS,
)


def dq(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def na(x: str) -> str:
    toks = ", ".join(lit(t) for t in NA_TOKENS)
    return f"CASE WHEN {x} IN ({toks}) THEN NULL ELSE {x} END"


def num(x: str, default: str | None = None) -> str:
    inner = f"COALESCE({x}, {lit(default)})" if default is not None else x
    return f"TRY_CAST({inner} AS DOUBLE)"


def nan_null(x: str) -> str:
    return f"CASE WHEN isnan({x}) THEN NULL ELSE {x} END"


def to_number(x: str) -> str:
    """What pandas reads as a number: DuckDB's own cast, less what it takes beyond that (digit separators)."""
    t = f"CAST({x} AS VARCHAR)"
    return nan_null(f"CASE WHEN NOT contains({t}, '_') THEN TRY_CAST(trim({t}) AS DOUBLE) END")


def _s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


NULL_S = "CAST(NULL AS VARCHAR)"

# --- roles -----------------------------------------------------------------


def _staffing_role() -> str:
    qty = "CAST(l_quantity AS INTEGER)"
    cols = [
        f"concat(' ', CASE WHEN l_suppkey % 5 = 0 THEN lpad({_s('l_suppkey')}, 6, '0') ELSE {_s('l_suppkey')} END, ' ') AS PROVNUM",
        f"concat('Provider ', {_s('l_suppkey % 40')}, CASE WHEN l_linenumber = 6 THEN ' West' ELSE '' END) AS PROVNAME",
        f"concat(' st', {_s('(l_suppkey + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) % 25')}, ' ') AS STATE",
        f"CASE WHEN l_linenumber = 2 THEN NULL WHEN l_orderkey % 89 = 0 THEN 'N/A' WHEN l_orderkey % 83 = 0 THEN 'null' "
        f"ELSE {_s(qty)} END AS MDScensus",
        f"CASE WHEN l_linenumber = 3 THEN NULL WHEN l_orderkey % 97 = 0 THEN 'x?' ELSE {_s(qty)} END AS Hrs_RN",
        f"CASE WHEN l_linenumber <> 4 THEN {_s('l_tax')} END AS Hrs_LPN",
        f"{_s('l_discount')} AS Hrs_CNA",
    ]
    cols += [f"{_s(f'{qty} % {m}')} AS {n}" for m, n in zip(range(2, 9), PERM_PARTS)]
    cols += [f"{_s(f'l_linenumber % {m}')} AS {n}" for m, n in zip(range(2, 8), TEMP_PARTS[:-1])]
    cols.append(f"CASE WHEN l_returnflag <> 'R' THEN {_s('l_linenumber % 8')} END AS {TEMP_PARTS[-1]}")
    return "SELECT " + ",\n  ".join(cols) + "\nFROM lineitem"


def _provider_role(extra: bool) -> str:
    known = {
        CCN: f"concat(' ', CASE WHEN s_suppkey % 7 = 0 THEN 'X' ELSE '' END, lpad({_s('s_suppkey')}, 6, '0'))",
        "Provider Name": "s_name",
        PROV_STATE: f"concat('ST', {_s('s_nationkey')})",
        CERTIFIED_BEDS: f"CASE WHEN s_suppkey % 11 = 0 THEN '0' WHEN s_suppkey % 13 = 0 THEN NULL ELSE {_s('20 + s_suppkey')} END",
        OVERALL_RATING: f"CASE WHEN s_suppkey % 9 <> 0 THEN {_s('1 + s_suppkey % 5')} END",
    }
    cols = [f"{known.get(c, NULL_S)} AS {dq(c)}" for c in PROVIDER_INFO_COLS]
    if extra:
        cols += [f"{_s('s_acctbal')} AS {dq('Account Balance')}", f"{_s('s_suppkey')} AS {dq('Source Row')}"]
    return "SELECT " + ",\n  ".join(cols) + "\nFROM supplier"


def _state_role(extra: bool) -> str:
    known = {
        STATE_KEY: f"concat(' st', {_s('n_nationkey')}, CASE WHEN n_nationkey = 24 THEN 'x ' ELSE ' ' END)",
        ST_AVG_RESIDENTS: _s("50 + n_nationkey"),
        ST_AVG_NURSE_HRS: _s("3 + n_nationkey % 4"),
    }
    national = {STATE_KEY: "'Nation'", ST_AVG_RESIDENTS: "'60'", ST_AVG_NURSE_HRS: "'4'"}
    a = [f"{known.get(c, NULL_S)} AS {dq(c)}" for c in STATE_AVG_COLS]
    b = [f"{national.get(c, NULL_S)} AS {dq(c)}" for c in STATE_AVG_COLS]
    if extra:
        a.append(f"{_s('n_regionkey')} AS {dq('Region Key')}")
        b.append(f"{NULL_S} AS {dq('Region Key')}")
    return ("SELECT " + ", ".join(a) + " FROM nation\nUNION ALL\nSELECT "
            + ", ".join(b))


def _manifest() -> str:
    sid = _s("page_id")
    leaf = "regexp_extract(url, '/([^/?#]+)(?:[?#].*)?$', 1)"
    name = (f"CASE page_id % 4 WHEN 0 THEN concat('folder_', {sid}) "
            f"WHEN 1 THEN CASE WHEN page_id % 8 = 1 THEN concat('sheet_', {sid}, '.CSV') ELSE concat('sheet_', {sid}) END "
            f"WHEN 2 THEN CASE WHEN page_id % 8 = 2 THEN concat('table_', {leaf}, '.Csv') ELSE concat('table_', {leaf}) END "
            f"ELSE concat('page_', {leaf}, '.html') END")
    mime = (f"CASE page_id % 4 WHEN 0 THEN {lit(MIME_FOLDER)} WHEN 1 THEN {lit(MIME_SHEET)} "
            f"WHEN 2 THEN CASE WHEN page_id % 8 = 2 THEN 'application/octet-stream' ELSE {lit(MIME_CSV)} END "
            f"ELSE 'text/html' END")
    tmime = (f"CASE (page_id + 1) % 4 WHEN 0 THEN {lit(MIME_FOLDER)} WHEN 1 THEN {lit(MIME_SHEET)} "
             f"WHEN 2 THEN {lit(MIME_CSV)} ELSE 'text/html' END")
    sc = f"CASE WHEN page_id % 3 = 0 THEN struct_pack(targetId := {_s('page_id + 1')}, targetMimeType := {tmime}) END"
    return f"SELECT {sid} AS id, {name} AS name, {mime} AS mimeType, {sc} AS shortcutDetails FROM pages"


# --- pipeline steps ----------------------------------------------------------

STAFFING_COLS = (PROVNUM, PROVNAME, STATE, CENSUS, *TOTAL_PARTS, *PERM_PARTS, *TEMP_PARTS)


def _b_staffing() -> str:
    cols = []
    for c in STAFFING_COLS:
        e = na(dq(c))
        if c == PROVNUM:
            e = strip(f"({e})")
        cols.append(f"{e} AS {dq(c)}")
    return "SELECT " + ",\n  ".join(cols) + "\nFROM staffing"


def _b_provider() -> str:
    cols = []
    for c in PROVIDER_INFO_COLS:
        e = na(dq(c))
        if c == CCN:
            e = f"NULLIF(ltrim({strip(f'({e})')}, '0'), '')"
        cols.append(f"{e} AS {dq(c)}")
    return "SELECT " + ",\n  ".join(cols) + "\nFROM provider"


def _b_state() -> str:
    cols = []
    for c in STATE_AVG_COLS:
        e = na(dq(c))
        if c == STATE_KEY:
            e = f"upper({strip(f'CAST(({na(dq(c))}) AS VARCHAR)')})"
        cols.append(f"{e} AS {dq(c)}")
    return "SELECT " + ",\n  ".join(cols) + "\nFROM state_avg"


def sum_parts(parts, strict: bool = False, prefix: str = "s.") -> str:
    return "(" + " + ".join(num(prefix + dq(p), None if strict else "0") for p in parts) + ")"


def occup_rate_sql(census: str, beds: str) -> str:
    return f"100 * ({num(census, '0')} / NULLIF({num(beds)}, 0))"


def _joined() -> str:
    return ("SELECT s.*, p." + dq(CCN) + " AS _p_ccn, p." + dq(PROV_STATE) + " AS _p_state, p."
            + dq(CERTIFIED_BEDS) + " AS _p_beds, p." + dq(OVERALL_RATING) + " AS _p_rating\n"
            "FROM b_staffing s LEFT JOIN b_provider p ON s.PROVNUM = p." + dq(CCN))


def _joined_state() -> str:
    return ("SELECT j.*, st." + dq(STATE_KEY) + " AS _st_key, st." + dq(ST_AVG_RESIDENTS)
            + " AS _st_avg_residents, st." + dq(ST_AVG_NURSE_HRS) + " AS _st_avg_nurse_hrs\n"
            "FROM j_provider j LEFT JOIN b_state st ON j._p_state = st." + dq(STATE_KEY))


def gold_select(strict: bool = False) -> str:
    fact = ", ".join(f"s.{dq(c)}" for c in STAFFING_COLS)
    return (f"SELECT {fact},\n"
            f"  {sum_parts(TOTAL_PARTS, strict)} AS Tot_Nurse_hrs,\n"
            f"  {sum_parts(PERM_PARTS, strict)} AS perm_staff,\n"
            f"  {sum_parts(TEMP_PARTS, strict)} AS temp_staff,\n"
            f"  {num('s._p_beds')} AS occup_limit,\n"
            f"  {num('s._st_avg_residents')} AS Avg_residents_per_day,\n"
            f"  {num('s._st_avg_nurse_hrs')} AS Avg_tot_nurse_hrs_per_resident_per_day,\n"
            f"  {occup_rate_sql('s.MDScensus', 's._p_beds')} AS occup_rate,\n"
            f"  {num('s._p_rating')} AS overall_rating\n"
            "FROM j_state s")


def _dash() -> str:
    def key(c, up=False):
        t = f"COALESCE(CAST({dq(c)} AS VARCHAR), 'nan')"
        return strip(f"upper({t})" if up else t) + f" AS {dq(c)}"
    meas = []
    for m, _ in ROLLUP_MEASURES:
        meas.append(f"{to_number(dq(m)) if m == CENSUS else nan_null(f'CAST({dq(m)} AS DOUBLE)')} AS {dq(m)}")
    return "SELECT " + ", ".join([key(PROVNUM), key(PROVNAME), key(STATE, True)] + meas) + " FROM gold"


def _rollup() -> str:
    agg = {"mean": "avg", "max": "max"}
    ms = ", ".join(f"{agg[how]}({dq(m)}) AS {dq(m)}" for m, how in ROLLUP_MEASURES)
    return f"SELECT PROVNUM, PROVNAME, STATE, {ms} FROM dash GROUP BY PROVNUM, PROVNAME, STATE"


ORDER_ROLLUP = "Tot_Nurse_hrs DESC NULLS LAST, PROVNUM ASC NULLS LAST, PROVNAME ASC NULLS LAST, STATE ASC NULLS LAST"


def top_select(k: int, source: str = "rollup") -> str:
    return f"SELECT * FROM {source} ORDER BY {ORDER_ROLLUP} LIMIT {k}"


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "staffing": ((), _staffing_role()),
    "provider": ((), _provider_role(False)),
    "provider_x": ((), _provider_role(True)),
    "state_avg": ((), _state_role(False)),
    "state_x": ((), _state_role(True)),
    "manifest": ((), _manifest()),
    "b_staffing": (("staffing",), _b_staffing()),
    "b_provider": (("provider",), _b_provider()),
    "b_state": (("state_avg",), _b_state()),
    "j_provider": (("b_staffing", "b_provider"), _joined()),
    "j_state": (("j_provider", "b_state"), _joined_state()),
    "gold": (("j_state",), gold_select(False)),
    "gold_strict": (("j_state",), gold_select(True)),
    "dash": (("gold",), _dash()),
    "rollup": (("dash",), _rollup()),
    "top20": (("rollup",), top_select(20)),
}


def sql(body: str, *needs: str) -> str:
    """``WITH <needed CTEs in dependency order> <body>``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order) + "\n" + body
