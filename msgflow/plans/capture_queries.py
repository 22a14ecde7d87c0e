"""Handlers that fail for some groups, and sessions in the form that reads rows one by one."""

from __future__ import annotations

from pyspark.sql import functions as F

from msgflow.functions import scalars as S
from msgflow.message import Message, Response
from msgflow.operators import group_handlers as G
from msgflow.operators import sinks as SK
from msgflow.operators.session_form import session_form
from msgflow.plans.handler_queries import _user_messages
from msgflow.plans.registry import event_messages, query, time_text
from msgflow.plans.stream_state_queries import _SessionCounter
from msgflow.plans.window_queries import SESSION_SQL
from msgflow.streaming import sinks


def _refuse(datum):
    if int(datum.id) % 97 == 0:
        raise ValueError(f"event {datum.id}")


def _thirds(keys, datums, window):
    for count, d in enumerate(datums, 1):
        _refuse(d)
        if count % 3 == 0:
            yield Message(str(count).encode(), keys=keys)


_FAILING_SQL = """
    WITH r AS (SELECT *, {w} AS w, row_number() OVER (PARTITION BY {w}, {key} ORDER BY ts, event_id) AS rn FROM events),
    b AS (SELECT w, {key}, min(rn) AS bad, arg_min(event_id, rn) AS event_id FROM r WHERE event_id % 97 = 0 GROUP BY ALL)
"""


@query(
    "reduce_capture_errors",
    _FAILING_SQL.format(w="date_trunc('day', ts)", key="event_type")
    + """
    SELECT strftime(r.w, '%Y-%m-%d %H:%M:%S.%f') AS window_start, r.event_type AS key, rn AS counter, '' AS error
    FROM r LEFT JOIN b USING (w, event_type) WHERE rn % 3 = 0 AND (bad IS NULL OR rn < bad)
    UNION ALL
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f'), event_type, -1, 'ValueError: event ' || event_id FROM b
    """,
)
def reduce_capture_errors(spark, base):
    out = G.reduce_handler(event_messages(spark, base, "event_id"), "1 day", _thirds, columns=("id",), order=("event_time", "event_id"), on_error="capture")
    return out.select(
        time_text("window.start").alias("window_start"), F.element_at("keys", 1).alias("key"),
        F.coalesce(S.text_to_int("value", strict=False), F.lit(-1)).alias("counter"),
        F.coalesce("error.message", F.lit("")).alias("error"),
    )


async def _numbered(datums):
    count = 0
    async for d in datums:
        _refuse(d)
        count += 1
        yield Message(str(count).encode(), keys=d.keys, id=d.id)


@query(
    "accumulate_capture_errors",
    _FAILING_SQL.format(w="0", key="user_id")
    + """
    SELECT CAST(r.user_id AS VARCHAR) AS key, CAST(r.event_id AS VARCHAR) AS id, rn AS counter, '' AS error
    FROM r LEFT JOIN b USING (user_id) WHERE bad IS NULL OR rn < bad
    UNION ALL
    SELECT CAST(user_id AS VARCHAR), '', -1, 'ValueError: event ' || event_id FROM b
    """,
)
def accumulate_capture_errors(spark, base):
    rows = _user_messages(spark, base)
    out = G.accumulate_handler(rows, _numbered, columns=("id", "keys"), order=("event_time", "event_id"), on_error="capture")
    return out.select(
        F.element_at("keys", 1).alias("key"), F.coalesce("id", F.lit("")).alias("id"),
        F.coalesce(S.text_to_int("value", strict=False), F.lit(-1)).alias("counter"),
        F.coalesce("error.message", F.lit("")).alias("error"),
    )


def _answers_all_but_errors(datums):
    failed = 0
    for d in datums:
        if d.keys[0] == "error":
            failed += 1
        else:
            yield Response.fallback(d.id) if d.keys[0] == "view" else Response.success(d.id)
    if failed:
        raise RuntimeError("the sink broke down")


@query(
    "sink_capture_errors",
    """
    SELECT event_id, CASE event_type WHEN 'error' THEN 'retry' WHEN 'view' THEN 'fallback' ELSE 'primary' END AS destination,
           CASE event_type WHEN 'error' THEN 'RuntimeError: the sink broke down' ELSE '' END AS error
    FROM events
    """,
)
def sink_capture_errors(spark, base):
    out = sinks.sink_handler(event_messages(spark, base, "event_id").select("id", "keys", "value", "event_id"), _answers_all_but_errors, on_error="capture")
    routed = SK.destinations(out)
    return routed.select("event_id", "destination", F.coalesce("error.message", F.lit("")).alias("error"))


@query("session_reduce_handler", f"SELECT CAST(key AS VARCHAR) AS key, window_start, window_end, counter FROM ({SESSION_SQL.format(key='user_id', gap='6 HOUR')})")
def session_reduce_handler(spark, base):
    out = G.session_handler(_user_messages(spark, base), "6 hours", session_form(_SessionCounter), columns=("id",))
    return out.select(
        F.element_at("keys", 1).alias("key"), time_text("window.start").alias("window_start"),
        time_text("window.end").alias("window_end"), S.text_to_int("value").alias("counter"),
    )
