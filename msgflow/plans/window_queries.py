"""Window, early-result, session, accumulator and watermark queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from msgflow import constants as C
from msgflow.functions import scalars as S
from msgflow.operators import accumulate as A
from msgflow.operators import early as EA
from msgflow.operators import envelope as E
from msgflow.operators import reduce as RD
from msgflow.operators import session as SE
from msgflow.operators import watermarks as WM
from msgflow.operators import windows as W
from msgflow.plans.registry import cents, event_messages, query, time_text
from msgflow.sources.tables import read_table


def _bounds():
    return time_text("window.start").alias("window_start"), time_text("window.end").alias("window_end")


@query(
    "reduce_fixed_keyed",
    """
    WITH r AS (SELECT date_trunc('hour', ts) AS w, event_type AS key, count(*) AS counter,
                      CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
               FROM events GROUP BY ALL)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start,
           strftime(w + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS window_end, key, counter, cents FROM r
    """,
)
def reduce_fixed_keyed(spark, base):
    rows = event_messages(spark, base, "cents")
    out = RD.reduce_window(rows, "1 hour", F.count(F.lit(1)).alias("counter"), F.sum("cents").alias("cents"))
    return out.select(*_bounds(), F.element_at("keys", 1).alias("key"), "counter", "cents")


@query(
    "reduce_fixed_unkeyed",
    """
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S.%f') AS window_start, count(*) AS counter,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
           CAST(min(user_id) AS BIGINT) AS first_user, CAST(max(user_id) AS BIGINT) AS last_user
    FROM events GROUP BY ALL
    """,
)
def reduce_fixed_unkeyed(spark, base):
    rows = event_messages(spark, base, "cents", "user_id")
    out = RD.reduce_window(
        rows,
        "1 day",
        F.count(F.lit(1)).alias("counter"),
        F.sum("cents").alias("cents"),
        F.min("user_id").alias("first_user"),
        F.max("user_id").alias("last_user"),
        by=(),
    )
    return out.select(time_text("window.start").alias("window_start"), "counter", "cents", "first_user", "last_user")


@query(
    "reduce_counter_text",
    """
    WITH r AS (SELECT date_trunc('minute', ts) AS w, user_id, count(*) AS n FROM events GROUP BY ALL)
    SELECT CAST(user_id AS VARCHAR) AS key,
           'counter:' || n || ' interval_window_start:' || strftime(w, '%Y-%m-%d %H:%M:%S') || '+00:00'
             || ' interval_window_end:' || strftime(w + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') || '+00:00' AS payload
    FROM r
    """,
)
def reduce_counter_text(spark, base):
    rows = event_messages(spark, base, "user_id")
    out = RD.reduce_counter(rows, "1 minute", by=("user_id",))
    return out.select(F.col("user_id").cast("string").alias("key"), S.bytes_to_text("value").alias("payload"))


@query(
    "lineitem_weekly",
    """
    WITH r AS (SELECT time_bucket(INTERVAL 7 DAY, l_shipdate, TIMESTAMP '1970-01-01') AS w, l_returnflag, l_linestatus,
                      count(*) AS counter, CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS BIGINT) AS quantity,
                      CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
               FROM lineitem GROUP BY ALL)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start, l_returnflag, l_linestatus, counter, quantity, cents FROM r
    """,
)
def lineitem_weekly(spark, base):
    lines = read_table(spark, base, "lineitem")
    out = RD.reduce_window(
        lines,
        "7 days",
        F.count(F.lit(1)).alias("counter"),
        F.sum(F.round("l_quantity").cast("bigint")).alias("quantity"),
        F.sum(cents("l_extendedprice")).alias("cents"),
        by=("l_returnflag", "l_linestatus"),
        time="l_shipdate",
    )
    return out.select(
        time_text("window.start").alias("window_start"), "l_returnflag", "l_linestatus", "counter", "quantity", "cents"
    )


@query(
    "window_eof",
    """
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start,
           strftime(w + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS window_end, true AS eof
    FROM (SELECT DISTINCT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS w FROM events)
    """,
)
def window_eof(spark, base):
    reduced = RD.reduce_window(event_messages(spark, base), "6 hours", F.count(F.lit(1)).alias("counter"))
    return W.window_eof(reduced).select(*_bounds(), "eof")


@query(
    "open_windows",
    """
    WITH w AS (SELECT DISTINCT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS w FROM events)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start FROM w
    WHERE w + INTERVAL 1 HOUR > (SELECT max(ts) - INTERVAL 2 DAY FROM events)
    """,
)
def open_windows(spark, base):
    rows = event_messages(spark, base)
    watermark = rows.agg((F.max("event_time") - F.expr("interval 2 days")).alias("wm")).scalar()
    return W.open_windows(rows, "1 hour", watermark).select(time_text("window.start").alias("window_start"))


_GROUPED = "date_trunc('day', ts) AS w, event_type AS key"


@query(
    "early_counter",
    f"""
    WITH n AS (SELECT {_GROUPED}, count(*) AS n FROM events GROUP BY ALL),
    r AS (SELECT {_GROUPED}, row_number() OVER (PARTITION BY date_trunc('day', ts), event_type ORDER BY ts, event_id) AS rn
          FROM events)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start, key, rn // 11 AS emit, CAST(11 AS BIGINT) AS counter, false AS final
    FROM r WHERE rn % 11 = 0
    UNION ALL
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f'), key, n // 11 + 1, n % 11, true FROM n
    """,
)
def early_counter(spark, base):
    rows = W.with_window(event_messages(spark, base), "1 day")
    out = EA.early_counter(rows, ["window", "keys"], threshold=10)
    return out.select(
        time_text("window.start").alias("window_start"), F.element_at("keys", 1).alias("key"), "emit", "counter", "final"
    )


@query(
    "early_every_ten",
    f"""
    WITH n AS (SELECT {_GROUPED}, count(*) AS n FROM events GROUP BY ALL),
    r AS (SELECT {_GROUPED}, row_number() OVER (PARTITION BY date_trunc('day', ts), event_type ORDER BY ts, event_id) AS rn
          FROM events),
    e AS (SELECT w, key, rn AS counter, '' AS mark FROM r WHERE rn % 10 = 0
          UNION ALL SELECT w, key, n, ' (FINAL)' FROM n)
    SELECT key, counter, 'counter:' || counter || mark || ' interval_window_start:' || strftime(w, '%Y-%m-%d %H:%M:%S')
           || '+00:00 interval_window_end:' || strftime(w + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') || '+00:00' AS payload
    FROM e
    """,
)
def early_every_ten(spark, base):
    rows = W.with_window(event_messages(spark, base), "1 day")
    out = EA.early_every(rows, ["window", "keys"], every=10)
    plain = S.window_text(C.COUNTER_FORMAT, F.col("counter"), F.col("window"))
    last = S.window_text(C.FINAL_COUNTER_FORMAT, F.col("counter"), F.col("window"))
    text = F.when(F.col("final"), last).otherwise(plain)
    return out.select(F.element_at("keys", 1).alias("key"), "counter", text.alias("payload"))


@query(
    "early_running",
    """
    SELECT event_id, row_number() OVER (PARTITION BY date_trunc('hour', ts), event_type ORDER BY ts, event_id) AS counter
    FROM events
    """,
)
def early_running(spark, base):
    rows = W.with_window(event_messages(spark, base, "event_id"), "1 hour")
    return EA.early_running(rows, ["window", "keys"], ["event_time", "event_id"]).select("event_id", "counter")


_RUNNING_SQL = "SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS counter FROM events"


@query("running_counter", _RUNNING_SQL)
def running_counter(spark, base):
    rows = event_messages(spark, base, "event_id")
    return A.running_counter(rows, ["keys"], ["event_time", "event_id"]).select("event_id", "counter")


@query("running_counter_hot_keys", _RUNNING_SQL)
def running_counter_hot_keys(spark, base):
    # A low bound on a hot group, so that every key here takes the segmented way.
    rows = event_messages(spark, base, "event_id")
    return A.running_counter(rows, ["keys"], ["event_time", "event_id"], hot_rows=300).select("event_id", "counter")


_SUM_SQL = """
    WITH RECURSIVE r AS (
        SELECT {group} AS g, CAST(round(value) AS BIGINT) AS v,
               row_number() OVER (PARTITION BY {group} ORDER BY ts, event_id) AS rn FROM events),
    f AS (SELECT g, rn, v, v >= {t} AS hit, CASE WHEN v >= {t} THEN 0 ELSE v END AS acc, v AS total FROM r WHERE rn = 1
          UNION ALL
          SELECT r.g, r.rn, r.v, f.acc + r.v >= {t}, CASE WHEN f.acc + r.v >= {t} THEN 0 ELSE f.acc + r.v END, f.acc + r.v
          FROM f JOIN r ON r.g = f.g AND r.rn = f.rn + 1),
    last AS (SELECT g, max(rn) AS rn FROM r GROUP BY g)
    SELECT CAST(g AS VARCHAR) AS key, row_number() OVER (PARTITION BY g ORDER BY rn) AS emit,
           CAST(total AS BIGINT) AS total, false AS final FROM f WHERE hit
    UNION ALL
    SELECT CAST(f.g AS VARCHAR), 1 + (SELECT count(*) FROM f h WHERE h.hit AND h.g = f.g), CAST(f.acc AS BIGINT), true
    FROM f JOIN last ON f.g = last.g AND f.rn = last.rn
"""


def _sums(rows, group, key, **opts):
    out = EA.early_sum(rows, group, ["event_time", "event_id"], "whole", **opts)
    return out.select(key.alias("key"), "emit", "total", "final")


@query("early_sum", _SUM_SQL.format(group="strftime(date_trunc('day', ts), '%Y-%m-%d') || event_type", t=100))
def early_sum(spark, base):
    rows = W.with_window(_whole(spark, base), "1 day")
    key = F.concat(F.date_format("window.start", "yyyy-MM-dd"), F.element_at("keys", 1))
    return _sums(rows, ["window", "keys"], key)


@query("early_sum_hot_keys", _SUM_SQL.format(group="event_type", t=1000))
def early_sum_hot_keys(spark, base):
    # Low bounds on a hot group, so that every key here takes the segmented way.
    rows = _whole(spark, base)
    return _sums(rows, ["keys"], F.element_at("keys", 1), threshold=1000, hot_rows=300)


def _whole(spark, base):
    events = read_table(spark, base, "events").withColumn("whole", F.round("value").cast("bigint"))
    return E.to_envelope(
        events, keep=["event_id", "whole"], keys=E.strings(F.col("event_type")), event_time=F.col("ts")
    )


SESSION_SQL = """
    WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL {gap} THEN 1 ELSE 0 END AS new
               FROM events WINDOW w AS (PARTITION BY {key} ORDER BY ts, event_id)),
    s AS (SELECT *, sum(new) OVER (PARTITION BY {key} ORDER BY ts, event_id) AS no FROM g)
    SELECT {key} AS key, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS window_start,
           strftime(max(ts) + INTERVAL {gap}, '%Y-%m-%d %H:%M:%S.%f') AS window_end, count(*) AS counter,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
           min(event_id) AS first_id, max(event_id) AS last_id
    FROM s GROUP BY {key}, no
"""


def _session_aggs():
    return {
        "counter": SE.Mergeable("count"),
        "cents": SE.Mergeable("sum", F.col("cents")),
        "first_id": SE.Mergeable("min", F.col("event_id")),
        "last_id": SE.Mergeable("max", F.col("event_id")),
    }


@query("session_counts", SESSION_SQL.format(key="user_id", gap="6 HOUR"))
def session_counts(spark, base):
    rows = event_messages(spark, base, "user_id", "event_id", "cents")
    out = SE.session_reduce(rows, "6 hours", _session_aggs(), by=["user_id"])
    return out.select(F.col("user_id").alias("key"), *_bounds(), *_session_aggs())


@query("session_hot_keys", SESSION_SQL.format(key="event_type", gap="40 MINUTE"))
def session_hot_keys(spark, base):
    # Five keys hold everything; a small block makes sessions cross blocks.
    rows = event_messages(spark, base, "event_type", "event_id", "cents")
    out = SE.session_reduce(rows, "40 minutes", _session_aggs(), by=["event_type"], block=4)
    return out.select(F.col("event_type").alias("key"), *_bounds(), *_session_aggs())


@query(
    "accumulate_window",
    """
    WITH a AS (SELECT *, ts + to_seconds((event_id * 7919) % 10800) AS arrival FROM events),
    w AS (SELECT *, max(ts) OVER (PARTITION BY event_id % 4 ORDER BY arrival, event_id) - INTERVAL 1 HOUR AS wm FROM a)
    SELECT event_id, '1970-01-01 00:00:00.000000' AS window_start,
           strftime(max(wm) OVER (PARTITION BY event_type ORDER BY ts, event_id), '%Y-%m-%d %H:%M:%S.%f') AS window_end
    FROM w
    """,
)
def accumulate_window(spark, base):
    rows = WM.with_watermark_column(_arrivals(spark, base), ["source"], ["arrival", "event_id"], "1 hour")
    out = A.output_window(rows, ["keys"], ["event_time", "event_id"])
    return out.select("event_id", *_bounds())


def _arrivals(spark, base):
    """Events with an arrival time up to three hours after the event time, on four sources."""
    rows = event_messages(spark, base, "event_id")
    delay = F.make_dt_interval(secs=((F.col("event_id") * 7919) % 10800).cast("decimal(18,6)"))
    return rows.withColumns({"arrival": F.col("event_time") + delay, "source": F.col("offset.partition_id")})


@query(
    "accumulator_timeout",
    """
    WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 2 DAY THEN 1 ELSE 0 END AS new
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM g)
    SELECT user_id, strftime(max(ts) + INTERVAL 2 DAY, '%Y-%m-%d %H:%M:%S.%f') AS closed_at, count(*) AS n_rows, true AS eof
    FROM s GROUP BY user_id, no
    """,
)
def accumulator_timeout(spark, base):
    out = A.close_on_timeout(event_messages(spark, base, "user_id"), "2 days", by=["user_id"])
    return out.select(
        "user_id", time_text("window.end").alias("closed_at"), F.col("rows").alias("n_rows"), "eof"
    )


@query(
    "sorted_stream",
    """
    SELECT CAST(user_id AS VARCHAR) AS key, event_id,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position
    FROM events
    """,
)
def sorted_stream(spark, base):
    rows = event_messages(spark, base, "event_id", "user_id")
    placed = A.stream_position(rows, ["user_id"], ["event_time", "event_id"])
    ordered = A.sort_stream(placed, ["user_id"], ["event_time", "event_id"])
    return ordered.select(F.col("user_id").cast("string").alias("key"), "event_id", "position")


@query(
    "late_split",
    """
    WITH a AS (SELECT *, ts + to_seconds((event_id * 7919) % 10800) AS arrival FROM events),
    w AS (SELECT *, max(ts) OVER (PARTITION BY event_id % 4 ORDER BY arrival, event_id) - INTERVAL 1 HOUR AS wm FROM a)
    SELECT event_id, CAST(event_id % 4 AS INTEGER) AS source, strftime(wm, '%Y-%m-%d %H:%M:%S.%f') AS watermark, ts < wm AS late FROM w
    """,
)
def late_split(spark, base):
    rows = WM.with_watermark_column(_arrivals(spark, base), ["source"], ["arrival", "event_id"], "1 hour")
    return rows.select("event_id", "source", time_text("watermark").alias("watermark"), WM.is_late().alias("late"))


@query(
    "late_counts",
    """
    WITH a AS (SELECT *, ts + to_seconds((event_id * 7919) % 10800) AS arrival FROM events),
    w AS (SELECT *, max(ts) OVER (PARTITION BY event_id % 4 ORDER BY arrival, event_id) - INTERVAL 1 HOUR AS wm FROM a)
    SELECT CASE WHEN ts < wm THEN 'late' ELSE 'on time' END AS part, event_type AS key, count(*) AS n FROM w GROUP BY ALL
    """,
)
def late_counts(spark, base):
    rows = WM.with_watermark_column(_arrivals(spark, base), ["source"], ["arrival", "event_id"], "1 hour")
    parts = rows.withColumn("part", F.when(WM.is_late(), "late").otherwise("on time"))
    return parts.groupBy("part", F.element_at("keys", 1).alias("key")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "idle_heartbeats",
    """
    WITH l AS (SELECT event_id % 4 AS source, ts, lag(ts) OVER (PARTITION BY event_id % 4 ORDER BY ts, event_id) AS last FROM events),
    g AS (SELECT source, ts, last, epoch_us(ts) - epoch_us(last) AS idle FROM l WHERE last IS NOT NULL),
    b AS (SELECT source, ts, last, unnest(range(0, (idle - 1200000000) // 300000000 + 1)) AS k FROM g WHERE idle >= 1200000000)
    SELECT CAST(source AS INTEGER) AS source, strftime(last + INTERVAL 20 MINUTE + k * INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS heartbeat_at,
           strftime(least(last + (k + 1) * INTERVAL 3 MINUTE, ts), '%Y-%m-%d %H:%M:%S.%f') AS watermark
    FROM b
    """,
)
def idle_heartbeats(spark, base):
    rows = event_messages(spark, base, "event_id").withColumn("source", F.col("offset.partition_id"))
    beats = WM.idle_heartbeats(
        rows, ["source"], ["event_time", "event_id"], threshold="20 minutes", step="5 minutes", increment="3 minutes"
    )
    return beats.select("source", time_text("heartbeat_at").alias("heartbeat_at"), time_text("watermark").alias("watermark"))
