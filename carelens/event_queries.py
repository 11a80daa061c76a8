"""Registered queries over event time: windows of a stream, sessions, as-of and range joins; and their DuckDB text.

Sums are of whole cents, so they are exact in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.fixtures import table
from carelens.operators.intervals import overlap_join, range_join, range_parts
from carelens.operators.sessions import Agg, sessions
from carelens.operators.temporal import asof_join
from carelens.session import scratch_path
from carelens.streaming.windows import Windows, current_windows, final_windows, late_rows, run_windows

CENTS = "CAST(round(value * 100) AS BIGINT)"
#: State partitions of the registered streams (few keys).
STATE_PARTITIONS = 8

# ---------------------------------------------------------------- streams

#: When an event lands: in the six days it happened in, or one or two such periods later.
LANDS = "CAST(floor(epoch_day / 6) AS INT) + CASE WHEN event_id % 10 = 3 THEN 1 WHEN event_id % 37 = 5 THEN 2 ELSE 0 END"
AGGS = (("n", "count(1)"), ("cents", "sum(cents)"))
TUMBLING = Windows(("event_type",), AGGS, every="1 day")
SLIDING = Windows(("event_type",), AGGS, every="2 days", slide="12 hours")
SESSIONS = Windows(("user_id",), AGGS, gap="3 hours")


def _landed(spark, d) -> DataFrame:
    """Events with the period in which they land."""
    events = table(spark, d, "events").withColumn("epoch_day", F.unix_date(F.to_date("ts")))
    return events.selectExpr("event_id", "ts", "user_id", "event_type", f"{CENTS} AS cents", f"{LANDS} AS lands")


def _stream(spark, d, name: str, windows: Windows, delay: str, emit: str) -> str:
    """Land one period after the other, with a run after each that continues from the checkpoint."""
    landed = _landed(spark, d).where("ts IS NOT NULL")
    base = scratch_path(spark, name)
    periods = [r["lands"] for r in landed.select("lands").distinct().orderBy("lands").collect()]  # some periods of days
    for period in periods:
        landed.where(F.col("lands") == period).write.mode("append").parquet(f"{base}/landing")
        run_windows(spark, f"{base}/landing", f"{base}/sink", f"{base}/_checkpoint", landed.schema, windows, delay, emit, partitions=STATE_PARTITIONS)
    return f"{base}/sink"


def q_stream_tumbling(spark, d):
    return final_windows(spark, _stream(spark, d, "stream_tumbling", TUMBLING, "2 days", "final"), TUMBLING)


def q_stream_sliding(spark, d):
    return final_windows(spark, _stream(spark, d, "stream_sliding", SLIDING, "2 days", "final"), SLIDING)


def q_stream_current(spark, d):
    return current_windows(spark, _stream(spark, d, "stream_current", TUMBLING, "2 days", "changes"), TUMBLING)


def q_stream_late_rows(spark, d):
    current = current_windows(spark, _stream(spark, d, "stream_late_rows", TUMBLING, "2 days", "changes"), TUMBLING)
    return late_rows(_landed(spark, d), current, TUMBLING)


def q_stream_sessions(spark, d):
    """No row comes later than the delay, so the sessions are those of the table, as far as the watermark has come."""
    return final_windows(spark, _stream(spark, d, "stream_sessions", SESSIONS, "18 days", "final"), SESSIONS)


_LANDED_SQL = f"""landed AS (SELECT *, {CENTS} AS cents, {LANDS} AS lands
  FROM (SELECT *, datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS epoch_day FROM events WHERE ts IS NOT NULL) x),
marks AS (SELECT lands, max(m) OVER (ORDER BY lands ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 DAY AS mark
  FROM (SELECT lands, date_trunc('millisecond', max(ts)) AS m FROM landed GROUP BY lands) x),
final AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 DAY AS mark FROM landed)"""


def _windows_sql(hours: int, slide: int) -> str:
    """On-time rows by window: a row is late for a window that ended at or before the watermark when it landed."""
    starts = (f"unnest(generate_series(time_bucket(INTERVAL {slide} HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL {hours - slide} HOUR, "
              f"time_bucket(INTERVAL {slide} HOUR, ts, TIMESTAMP '1970-01-01'), INTERVAL {slide} HOUR))")
    return f"""WITH {_LANDED_SQL},
spread AS (SELECT *, {starts} AS window_start FROM landed),
on_time AS (SELECT window_start, window_start + INTERVAL {hours} HOUR AS window_end, event_type, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
  FROM spread JOIN marks USING (lands) WHERE mark IS NULL OR window_start + INTERVAL {hours} HOUR > mark GROUP BY ALL)"""


def _sessions_sql(gap: str, keys: str, source: str, order: str) -> str:
    return f"""SELECT {keys}, min({order}) AS session_start, max({order}) AS session_last, count(*) AS n, CAST(sum(x) AS BIGINT) AS total
FROM (SELECT *, sum(cut) OVER (PARTITION BY {keys} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS s
  FROM (SELECT *, CASE WHEN {order} - lag({order}) OVER (PARTITION BY {keys} ORDER BY {order}) > {gap} THEN 1 ELSE 0 END AS cut FROM {source}) a) b
GROUP BY {keys}, s"""


# ---------------------------------------------------------------- sessions


def q_sessions_user(spark, d):
    """Each user's sessions, three hours without an event apart; in buckets of a day."""
    events = table(spark, d, "events")
    return sessions(events, ["user_id"], "ts", 3 * 3600, 24 * 3600, (Agg("total", "sum", CENTS),))


def q_sessions_turns(spark, d):
    """Stretches of a conversation's turns without a missing one."""
    turns = table(spark, d, "conversations").where("(turn + conv_id) % 5 <> 2")
    return sessions(turns, ["conv_id"], "turn", 1, 4, (Agg("total", "sum", "length(text)"),))


# ---------------------------------------------------------------- as-of join


def _of_type(spark, d, kind: str) -> DataFrame:
    return table(spark, d, "events").where(F.col("event_type") == kind)


def _purchases(spark, d) -> DataFrame:
    return _of_type(spark, d, "purchase").selectExpr("event_id", "user_id", "ts", f"{CENTS} AS cents")


def _clicks(spark, d) -> DataFrame:
    return _of_type(spark, d, "click").selectExpr("event_id AS click_id", "user_id", "ts AS click_ts", f"{CENTS} AS click_cents")


def q_asof_join(spark, d):
    """Each purchase with the user's last click not later than it."""
    return asof_join(_purchases(spark, d), _clicks(spark, d), ["user_id"], "ts", "click_ts", ["click_id", "click_cents"], 2 * 86_400)


def q_asof_tolerance(spark, d):
    """The same, clicks of the last six hours only."""
    return asof_join(_purchases(spark, d), _clicks(spark, d), ["user_id"], "ts", "click_ts", ["click_id"], 86_400, tolerance_seconds=6 * 3600)


def q_asof_previous(spark, d):
    """Each event with the user's event before it: strictly earlier."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts")
    before = table(spark, d, "events").selectExpr("user_id", "ts AS before_ts", "event_id AS before_id", "event_type AS before_type")
    return asof_join(events, before, ["user_id"], "ts", "before_ts", ["before_id", "before_type"], 5 * 86_400, strict=True)


_FACTS_SQL = f"SELECT event_id, user_id, ts, {CENTS} AS cents FROM events WHERE event_type = 'purchase'"
_CLICKS_SQL = f"SELECT event_id AS click_id, user_id, ts AS click_ts, {CENTS} AS click_cents FROM events WHERE event_type = 'click'"

# ---------------------------------------------------------------- range joins

FOUND = (Agg("n", "count"), Agg("first_id", "min", "event_id"), Agg("last_id", "max", "event_id"))
_HOURS = "CASE WHEN event_id % 50 = 0 THEN 240 ELSE 1 + event_id % 12 END"


def _outages(spark, d, kind: str = "error") -> DataFrame:
    """Intervals from events of a type: some hours long, every fiftieth ten days, every 97th without an end."""
    return _of_type(spark, d, kind).selectExpr(
        "event_id AS id", "user_id", "ts AS t0", f"CASE WHEN event_id % 97 <> 0 THEN ts + make_dt_interval(0, {_HOURS}) END AS t1", "value")


def _matched(pairs: DataFrame, one: str, other: str) -> DataFrame:
    return pairs.groupBy(F.col(f"{one}.id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min(other).alias("first_id"), F.max(other).alias("last_id"))


def q_range_join(spark, d):
    """Purchases of a user within the user's outages, by outage."""
    points = _of_type(spark, d, "purchase").select("event_id", "user_id", "ts")
    return _matched(range_join(points, _outages(spark, d), "ts", "t0", "t1", on=["user_id"]), "i", "p.event_id")


def q_range_join_all(spark, d):
    """Sign-ups within large outages of anyone: no equality but the bins', so pairs would grow with the square of the table."""
    points = _of_type(spark, d, "signup").select("event_id", "ts")
    parts = range_parts(points, _outages(spark, d).where("value > 45").select("id", "t0", "t1"), "ts", "t0", "t1", FOUND)
    return parts.groupBy(F.col("i.id").alias("id")).agg(*[a.merged() for a in FOUND])


def q_overlap_join(spark, d):
    """Outages and views of a user that overlap, by outage."""
    views = _outages(spark, d, "view")
    return _matched(overlap_join(_outages(spark, d), views, "t0", "t1", on=["user_id"]), "l", "r.id")


def _outages_sql(kind: str = "error") -> str:
    return (f"(SELECT event_id AS id, user_id, ts AS t0, value, CASE WHEN event_id % 97 <> 0 THEN ts + to_hours(CAST({_HOURS} AS INTEGER)) END AS t1 "
            f"FROM events WHERE event_type = '{kind}')")


def _matched_sql(one: str, other: str, source: str) -> str:
    return f"SELECT {one}.id, count(*) AS n, min({other}) AS first_id, max({other}) AS last_id FROM {source} GROUP BY {one}.id"


_INSIDE = "p.ts >= i.t0 AND (i.t1 IS NULL OR p.ts < i.t1)"

QUERIES = {
    "stream_tumbling": q_stream_tumbling,
    "stream_sliding": q_stream_sliding,
    "stream_current": q_stream_current,
    "stream_late_rows": q_stream_late_rows,
    "stream_sessions": q_stream_sessions,
    "sessions_user": q_sessions_user,
    "sessions_turns": q_sessions_turns,
    "asof_join": q_asof_join,
    "asof_tolerance": q_asof_tolerance,
    "asof_previous": q_asof_previous,
    "range_join": q_range_join,
    "range_join_all": q_range_join_all,
    "overlap_join": q_overlap_join,
}

ORACLE = {
    "stream_tumbling": _windows_sql(24, 24) + " SELECT o.* FROM on_time o, final f WHERE window_end <= f.mark",
    "stream_sliding": _windows_sql(48, 12) + " SELECT o.* FROM on_time o, final f WHERE window_end <= f.mark",
    "stream_current": _windows_sql(24, 24) + " SELECT * FROM on_time",
    "stream_late_rows": _windows_sql(24, 24) + """ SELECT event_type, landed, CAST(coalesce(on_time, 0) AS BIGINT) AS on_time,
 CAST(landed - coalesce(on_time, 0) AS BIGINT) AS late
FROM (SELECT event_type, count(*) AS landed FROM landed GROUP BY 1) a LEFT JOIN (SELECT event_type, sum(n) AS on_time FROM on_time GROUP BY 1) b USING (event_type)""",
    "stream_sessions": f"""WITH s AS ({_sessions_sql("INTERVAL 3 HOUR", "user_id", f"(SELECT *, {CENTS} AS x FROM events)", "ts")})
SELECT session_start AS window_start, session_last + INTERVAL 3 HOUR AS window_end, user_id, n, total AS cents
FROM s WHERE session_last + INTERVAL 3 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 18 DAY FROM events)""",
    "sessions_user": _sessions_sql("INTERVAL 3 HOUR", "user_id", f"(SELECT *, {CENTS} AS x FROM events WHERE ts IS NOT NULL)", "ts"),
    "sessions_turns": _sessions_sql("1", "conv_id", "(SELECT *, length(text) AS x FROM conversations WHERE (turn + conv_id) % 5 <> 2)", "turn"),
    "asof_join": f"SELECT f.*, v.click_ts, v.click_id, v.click_cents FROM ({_FACTS_SQL}) f ASOF LEFT JOIN ({_CLICKS_SQL}) v "
                 "ON f.user_id = v.user_id AND f.ts >= v.click_ts",
    "asof_tolerance": "SELECT event_id, user_id, ts, cents, CASE WHEN ok THEN click_ts END AS click_ts, CASE WHEN ok THEN click_id END AS click_id FROM ("
                      f"SELECT f.*, v.click_ts, v.click_id, f.ts - v.click_ts <= INTERVAL 6 HOUR AS ok FROM ({_FACTS_SQL}) f "
                      f"ASOF LEFT JOIN ({_CLICKS_SQL}) v ON f.user_id = v.user_id AND f.ts >= v.click_ts) x",
    "asof_previous": "SELECT f.event_id, f.user_id, f.ts, v.ts AS before_ts, v.event_id AS before_id, v.event_type AS before_type FROM events f "
                     "ASOF LEFT JOIN events v ON f.user_id = v.user_id AND f.ts > v.ts",
    "range_join": _matched_sql("i", "p.event_id", f"events p JOIN {_outages_sql()} i ON p.user_id = i.user_id AND {_INSIDE} WHERE p.event_type = 'purchase'"),
    "range_join_all": _matched_sql("i", "p.event_id", f"events p JOIN {_outages_sql()} i ON {_INSIDE} WHERE p.event_type = 'signup' AND i.value > 45"),
    "overlap_join": _matched_sql("l", "r.id", f"{_outages_sql()} l JOIN {_outages_sql('view')} r ON l.user_id = r.user_id "
                                 "AND (r.t1 IS NULL OR l.t0 < r.t1) AND (l.t1 IS NULL OR r.t0 < l.t1)"),
}
