"""Registered queries of summaries and comparisons: sketches, subtotals, analytic windows, snapshot differences; and their
DuckDB text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.event_queries import CENTS
from carelens.fixtures import table
from carelens.functions.semistructured import items, parse_json, quality
from carelens.operators.difference import except_all, intersect_all, snapshot_diff
from carelens.operators.frames import ranks, running, top_per_key
from carelens.operators.history import history, with_extract
from carelens.operators.grouping import cube_sets, rollup_sets, subtotals
from carelens.operators.sketches import Distinct, Quantiles, answer, sketch, unite
from carelens.operators.temporal import asof_join
from carelens.session import scratch_path

# ---------------------------------------------------------------- sketches

EVENT_SKETCHES = (Distinct("users", "user_id"), Quantiles("value", "value"))


def _event_sketches(spark, d) -> DataFrame:
    """Sketches of three loads of events, stored one after the other and united by event type."""
    events = table(spark, d, "events")
    path = scratch_path(spark, "event_sketches")
    for load in range(3):
        sketch(events.where(F.expr(f"event_id % 3 = {load}")), ["event_type"], EVENT_SKETCHES).write.mode("append").parquet(path)
    return unite(spark.read.parquet(path), ["event_type"], EVENT_SKETCHES)


def q_sketch_distinct(spark, d):
    """Users by event type: the exact number, and whether the estimate is within three standard errors of it."""
    found = answer(_event_sketches(spark, d), ["event_type"], EVENT_SKETCHES)
    exact = table(spark, d, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users_exact"))
    within = F.abs(F.col("users") - F.col("users_exact")) <= F.ceil(F.col("users_exact") * EVENT_SKETCHES[0].bound)
    return found.join(exact, "event_type").select("event_type", "rows", "users_exact", within.alias("within"))


def q_sketch_quantiles(spark, d):
    """Quantiles of the values by event type: how many values, and whether each estimate's true rank is within the bound."""
    probabilities = (0.01, 0.25, 0.5, 0.9, 0.99)
    spec = EVENT_SKETCHES[1]
    found = answer(_event_sketches(spark, d), ["event_type"], EVENT_SKETCHES, probabilities)
    pairs = ", ".join(f"struct({p}D AS p, value_p{100 * p:g} AS v)" for p in probabilities)
    asked = found.selectExpr("event_type", "value_n", f"inline(array({pairs}))")
    ranked = (table(spark, d, "events").select("event_type", "value").join(F.broadcast(asked), "event_type")  # types times five rows
              .groupBy("event_type", "value_n", "p").agg(F.avg((F.col("value") < F.col("v")).cast("double")).alias("below"),
                                                         F.avg((F.col("value") <= F.col("v")).cast("double")).alias("upto")))
    slack = 2 * spec.bound
    within = (F.col("below") <= F.col("p") + slack) & (F.col("upto") >= F.col("p") - slack)
    return ranked.groupBy("event_type", "value_n").agg(F.count(F.lit(1)).alias("asked"), F.min(within).alias("within"))


# ---------------------------------------------------------------- subtotals

EVENT_KEYS = ["event_type", "day", "band"]
EVENT_AGGS = {"n": "count(1)", "cents": "sum(cents)", "users": "count(DISTINCT user_id)"}
_BAND = "CASE WHEN event_id % 11 = 0 THEN NULL WHEN value < 10 THEN 'low' ELSE 'high' END"


def _banded(spark, d) -> DataFrame:
    return table(spark, d, "events").selectExpr("event_type", "to_date(ts) AS day", f"{_BAND} AS band", "user_id", f"{CENTS} AS cents")


def q_grouping_rollup(spark, d):
    return subtotals(_banded(spark, d), EVENT_KEYS, rollup_sets(EVENT_KEYS), {k: EVENT_AGGS[k] for k in ("n", "cents")})


def q_grouping_cube(spark, d):
    return subtotals(_banded(spark, d), EVENT_KEYS, cube_sets(EVENT_KEYS), {k: EVENT_AGGS[k] for k in ("n", "cents")})


def q_grouping_sets(spark, d):
    """Two groupings that share no key, and the total; with distinct users."""
    return subtotals(_banded(spark, d), EVENT_KEYS, [("event_type", "band"), ("day",), ()], EVENT_AGGS)


def _subtotals_sql(sets: str, users: bool = False) -> str:
    label = "concat_ws('+', " + ", ".join(f"CASE WHEN grouping({k}) = 0 THEN '{k}' END" for k in EVENT_KEYS) + ")"
    more = ", count(DISTINCT user_id) AS users" if users else ""
    return (f"SELECT event_type, day, band, CASE WHEN {label} = '' THEN 'total' ELSE {label} END AS \"grouping\", count(*) AS n, "
            f"CAST(sum(cents) AS BIGINT) AS cents{more} FROM (SELECT event_type, CAST(ts AS DATE) AS day, {_BAND} AS band, user_id, {CENTS} AS cents "
            f"FROM events) x GROUP BY {sets}")


# ---------------------------------------------------------------- analytic windows


def q_rank_within(spark, d):
    """Ranks of line items by price within their supplier's nation; the nation of a third of the suppliers is one."""
    lines = table(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE l_suppkey % 25 END AS nation",
                                                   "l_quantity")
    return ranks(lines, ["nation"], "l_quantity")


def q_top_per_key(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice")
    return top_per_key(lines, ["l_returnflag"], "l_extendedprice", 25)


def q_running_mean(spark, d):
    """Of each event, what the same user did in the 36 hours up to it."""
    events = table(spark, d, "events").selectExpr("event_id", "user_id", "ts", f"{CENTS} AS cents")
    return running(events, ["user_id"], "ts", 36 * 3600, {"n": ("count", "cents"), "total": ("sum", "cents"), "mean": ("avg", "cents"), "most": ("max", "cents")})


# ---------------------------------------------------------------- differences


def _extracts(spark, d) -> tuple[DataFrame, DataFrame]:
    """Two extracts of orders: some rows gone, some new, some changed, some given twice, some without a priority."""
    orders = table(spark, d, "orders").selectExpr("o_orderkey", "o_custkey", "o_orderstatus", "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS priority")
    old = orders.where("o_orderkey % 10 <> 7")
    new = orders.where("o_orderkey % 10 <> 3").withColumn("o_orderstatus", F.expr("CASE WHEN o_orderkey % 17 = 0 THEN 'X' ELSE o_orderstatus END"))
    return old.unionByName(old.where("o_orderkey % 29 = 0")), new.unionByName(new.where("o_orderkey % 31 = 0"))


def q_except_all(spark, d):
    old, new = _extracts(spark, d)
    return except_all(new.drop("o_orderkey"), old.drop("o_orderkey"))


def q_intersect_all(spark, d):
    old, new = _extracts(spark, d)
    return intersect_all(new.drop("o_orderkey"), old.drop("o_orderkey"))


def q_snapshot_diff(spark, d):
    old, new = _extracts(spark, d)
    found = snapshot_diff(old, new, ["o_orderkey"])
    first = lambda side: F.expr(f"get({side}, 0).o_orderstatus").alias(f"{side}_status")
    return found.select("o_orderkey", "change", first("old"), first("new"), F.expr("aggregate(old, 0L, (s, x) -> s + x.n)").alias("gone"),
                        F.expr("aggregate(new, 0L, (s, x) -> s + x.n)").alias("come"))


_ORDERS = "(SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS priority FROM orders)"
_OLD_SQL = f"""old AS (SELECT * FROM {_ORDERS} WHERE o_orderkey % 10 <> 7 UNION ALL SELECT * FROM {_ORDERS} WHERE o_orderkey % 10 <> 7 AND o_orderkey % 29 = 0)"""
_CHANGED = f"""(SELECT * REPLACE (CASE WHEN o_orderkey % 17 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus) FROM {_ORDERS} WHERE o_orderkey % 10 <> 3)"""
_NEW_SQL = f"""new AS (SELECT * FROM {_CHANGED} UNION ALL SELECT * FROM {_CHANGED} WHERE o_orderkey % 31 = 0)"""
_BOTH_SQL = f"WITH {_OLD_SQL}, {_NEW_SQL}"

# ---------------------------------------------------------------- dimension history

#: Extracts of customers: when, which are in it, and their segment.
EXTRACTS = (("1996-01-01", "true", "c_mktsegment"),
            ("1997-06-01", "c_custkey % 7 <> 0", "CASE WHEN c_custkey % 5 = 0 THEN 'X' WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment END"),
            ("1999-01-01", "c_custkey % 6 <> 1", "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment END"),
            ("2001-01-01", "true", "CASE WHEN c_custkey % 11 = 0 THEN 'Y' ELSE c_mktsegment END"))


def _customer_extracts(spark, d) -> list[DataFrame]:
    customers = table(spark, d, "customer")
    return [customers.where(which).selectExpr("c_custkey", f"{segment} AS segment", f"TIMESTAMP_NTZ '{day} 00:00:00' AS t") for day, which, segment in EXTRACTS]


def _all_of(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def q_dimension_history(spark, d):
    return history(_all_of(_customer_extracts(spark, d)), ["c_custkey"], "t")


def q_dimension_backfill(spark, d):
    """The second extract comes last and is given twice: the history is that of the extracts in order."""
    first, late, *others = _customer_extracts(spark, d)
    versions, times = history(_all_of([first, *others]), ["c_custkey"], "t"), _all_of([first, *others]).select("t").distinct()
    for _ in range(2):
        versions, times = with_extract(versions, times, late, ["c_custkey"], "t")
    return versions


def q_history_asof(spark, d):
    """Each order with its customer's segment of that day, if the customer was known then."""
    versions = q_dimension_history(spark, d).select("c_custkey", "segment", "valid_from", "valid_to")
    orders = table(spark, d, "orders").selectExpr("o_orderkey", "o_custkey AS c_custkey", "o_orderdate")
    found = asof_join(orders, versions, ["c_custkey"], "o_orderdate", "valid_from", ["segment", "valid_to"], 400 * 86_400)
    known = F.col("valid_to").isNull() | (F.col("o_orderdate") < F.col("valid_to"))
    return found.select("o_orderkey", "c_custkey", "o_orderdate", F.when(known, F.col("segment")).alias("segment"), F.when(known, F.col("valid_from")).alias("since"))


_HISTORY_SQL = "WITH e AS (" + " UNION ALL ".join(f"SELECT c_custkey, {s} AS segment, TIMESTAMP '{t}' AS t FROM customer WHERE {w}" for t, w, s in EXTRACTS) + """),
times AS (SELECT t, row_number() OVER (ORDER BY t) AS i, lead(t) OVER (ORDER BY t) AS nxt FROM (SELECT DISTINCT t FROM e) x),
p AS (SELECT *, lag(segment) OVER w AS before, lag(i) OVER w AS j FROM e JOIN times USING (t) WINDOW w AS (PARTITION BY c_custkey ORDER BY t)),
n AS (SELECT *, sum(CASE WHEN j IS NULL OR i <> j + 1 OR segment IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (PARTITION BY c_custkey ORDER BY t) AS v FROM p),
h AS (SELECT c_custkey, any_value(segment) AS segment, min(t) AS valid_from, CASE WHEN count(nxt) = count(*) THEN max(nxt) END AS valid_to, count(*) AS extracts
  FROM n GROUP BY c_custkey, v)"""

# ---------------------------------------------------------------- semi-structured columns

#: Event properties as they might land: some cut, some with another type or further fields, some empty.
_PROPS = ("CASE WHEN event_id % 41 = 0 THEN substr(props, 1, 5) WHEN event_id % 43 = 0 THEN replace(props, '}', ', \"src\": \"app\"}') "
          "WHEN event_id % 47 = 0 THEN '{\"k\": \"many\"}' WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 59 = 0 THEN '[1]' ELSE props END")


def _parsed(spark, d) -> DataFrame:
    events = table(spark, d, "events").selectExpr("event_id", "event_type", f"{_PROPS} AS props")
    return parse_json(events, "props", "k BIGINT")


def q_json_parse(spark, d):
    return _parsed(spark, d).selectExpr("event_id", "k", "_malformed AS malformed", "_extra['src'] AS src")


def q_json_quality(spark, d):
    return quality(_parsed(spark, d), ["event_type"])


def q_array_items(spark, d):
    """The sentences of each turn, as an array and unnested again: place and length."""
    turns = table(spark, d, "conversations").selectExpr("conv_id", "turn", "split(text, '[.] ') AS sentences")
    return items(turns, "sentences", "sentence").selectExpr("conv_id", "turn", "at", "length(sentence) AS n")


_PARSED_SQL = f"""WITH e AS (SELECT event_id, event_type, {_PROPS} AS p FROM events),
j AS (SELECT *, CASE WHEN json_valid(p) AND json_type(p) = 'OBJECT' THEN p END AS o FROM e),
x AS (SELECT *, TRY_CAST(json_extract_string(o, '$.k') AS BIGINT) AS k,
  CASE WHEN p IS NOT NULL AND (o IS NULL OR json_type(o, '$.k') = 'VARCHAR') THEN p END AS malformed, json_extract_string(o, '$.src') AS src FROM j)"""

QUERIES = {
    "sketch_distinct": q_sketch_distinct,
    "sketch_quantiles": q_sketch_quantiles,
    "grouping_rollup": q_grouping_rollup,
    "grouping_cube": q_grouping_cube,
    "grouping_sets": q_grouping_sets,
    "rank_within": q_rank_within,
    "top_per_key": q_top_per_key,
    "running_frame": q_running_mean,
    "except_all": q_except_all,
    "intersect_all": q_intersect_all,
    "snapshot_diff": q_snapshot_diff,
    "dimension_history": q_dimension_history,
    "dimension_backfill": q_dimension_backfill,
    "history_asof": q_history_asof,
    "json_parse": q_json_parse,
    "json_quality": q_json_quality,
    "array_items": q_array_items,
}

ORACLE = {
    "sketch_distinct": 'SELECT event_type, count(*) AS "rows", count(DISTINCT user_id) AS users_exact, true AS "within" FROM events GROUP BY event_type',
    "sketch_quantiles": 'SELECT event_type, count(value) AS value_n, CAST(5 AS BIGINT) AS asked, true AS "within" FROM events GROUP BY event_type',
    "grouping_rollup": _subtotals_sql("ROLLUP (event_type, day, band)"),
    "grouping_cube": _subtotals_sql("CUBE (event_type, day, band)"),
    "grouping_sets": _subtotals_sql("GROUPING SETS ((event_type, band), (day), ())", users=True),
    "rank_within": "SELECT l_orderkey, l_linenumber, l_partkey, nation, l_quantity, CAST(rank() OVER w AS BIGINT) AS rank, CAST(dense_rank() OVER w AS BIGINT) AS dense_rank "
                   "FROM (SELECT *, CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE l_suppkey % 25 END AS nation FROM lineitem) x WINDOW w AS (PARTITION BY nation ORDER BY l_quantity DESC NULLS LAST)",
    "top_per_key": "SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_extendedprice, CAST(rank() OVER w AS BIGINT) AS rank, "
                   "CAST(dense_rank() OVER w AS BIGINT) AS dense_rank FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC NULLS LAST)) x WHERE rank <= 25",
    "running_frame": f"SELECT event_id, user_id, ts, cents, count(cents) OVER w AS n, CAST(sum(cents) OVER w AS BIGINT) AS total, avg(cents) OVER w AS mean, max(cents) OVER w AS most "
                     f"FROM (SELECT *, {CENTS} AS cents FROM events) x WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 36 HOUR PRECEDING AND CURRENT ROW)",
    "except_all": f"{_BOTH_SQL} SELECT * EXCLUDE (o_orderkey) FROM new EXCEPT ALL SELECT * EXCLUDE (o_orderkey) FROM old",
    "intersect_all": f"{_BOTH_SQL} SELECT * EXCLUDE (o_orderkey) FROM new INTERSECT ALL SELECT * EXCLUDE (o_orderkey) FROM old",
    "snapshot_diff": f"""{_BOTH_SQL},
c AS (SELECT o_orderkey, o_custkey, o_orderstatus, priority, CAST(sum(a) AS BIGINT) AS a, CAST(sum(b) AS BIGINT) AS b
  FROM (SELECT *, 1 AS a, 0 AS b FROM old UNION ALL SELECT *, 0, 1 FROM new) x GROUP BY ALL)
SELECT o_orderkey, CASE WHEN sum(a) = 0 THEN 'added' WHEN sum(b) = 0 THEN 'removed' ELSE 'changed' END AS change,
  min(CASE WHEN a > b THEN o_orderstatus END) AS old_status, min(CASE WHEN b > a THEN o_orderstatus END) AS new_status,
  CAST(sum(greatest(a - b, 0)) AS BIGINT) AS gone, CAST(sum(greatest(b - a, 0)) AS BIGINT) AS come
FROM c GROUP BY o_orderkey HAVING bool_or(a <> b)""",
    "dimension_history": f"{_HISTORY_SQL} SELECT * FROM h",
    "dimension_backfill": f"{_HISTORY_SQL} SELECT * FROM h",
    "history_asof": f"""{_HISTORY_SQL} SELECT o_orderkey, o_custkey AS c_custkey, o_orderdate, segment, valid_from AS since FROM orders
LEFT JOIN h ON h.c_custkey = o_custkey AND o_orderdate >= valid_from AND (valid_to IS NULL OR o_orderdate < valid_to)""",
    "json_parse": f"{_PARSED_SQL} SELECT event_id, k, malformed, src FROM x",
    "json_quality": f"{_PARSED_SQL} SELECT event_type, count(*) AS documents, count(malformed) AS malformed, count(src) AS with_extra FROM x GROUP BY event_type",
    "array_items": "SELECT conv_id, turn, CAST(i AS INTEGER) AS at, CAST(length(s[i + 1]) AS INTEGER) AS n FROM (SELECT conv_id, turn, s, unnest(generate_series(0, len(s) - 1)) AS i "
                   "FROM (SELECT conv_id, turn, string_split(text, '. ') AS s FROM conversations) a) b",
}
