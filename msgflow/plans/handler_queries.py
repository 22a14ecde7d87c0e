"""Queries that run user Python: map-like handlers, and handlers over windows, sessions and keys."""

from __future__ import annotations

import asyncio
from datetime import datetime, timezone

from pyspark.sql import functions as F

from msgflow.functions import metadata as M
from msgflow.functions import scalars as S
from msgflow.message import BatchResponse, Message
from msgflow.operators import envelope as E
from msgflow.operators import group_handlers as G
from msgflow.operators import handlers as H
from msgflow.plans.registry import event_messages, query, time_text
from msgflow.plans.window_queries import SESSION_SQL
from msgflow.sources.tables import read_table

_V = "CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)"


def _annotate(keys, datum):
    note = {"processing": {"handler": b"annotate", "length": str(len(datum.value)).encode()}}
    return [Message(b"payload:" + datum.value, keys=[*keys, datum.headers["user"]], user_metadata=note)]


@query(
    "map_handler",
    f"""
    SELECT CAST(event_id AS VARCHAR) AS id, 'payload:' || {_V} AS value_text, event_type || '/' || user_id AS key,
           'processing{{handler=annotate,length=' || length({_V}) || '}}' AS metadata
    FROM events
    """,
)
def map_handler(spark, base):
    out = H.map_handler(event_messages(spark, base), _annotate, columns=("id", "keys", "value", "headers"))
    return out.select(
        "id",
        S.bytes_to_text("value").alias("value_text"),
        F.array_join("keys", "/").alias("key"),
        M.meta_text("user_metadata").alias("metadata"),
    )


async def _later(keys, datum):
    await asyncio.sleep(0)
    if keys == ["error"]:
        return [Message.drop()]
    return [Message(datum.value, keys=keys), Message(datum.value[::-1], keys=keys)]


@query(
    "map_async_handler",
    f"""
    SELECT CAST(event_id AS VARCHAR) AS id, u.pos AS pos, CASE u.pos WHEN 0 THEN {_V} ELSE reverse({_V}) END AS value_text
    FROM events, (VALUES (0), (1)) AS u(pos) WHERE event_type <> 'error'
    """,
)
def map_async_handler(spark, base):
    out = H.map_handler(event_messages(spark, base), _later, columns=("id", "keys", "value"))
    return E.drop_marked(out).select("id", "pos", S.bytes_to_text("value").alias("value_text"))


def _strict_number(keys, datum):
    number = int(datum.value)
    if number % 7 == 0:
        raise ValueError(f"bad number {number}")
    return [Message(str(number * 2).encode(), keys=keys)]


@query(
    "map_capture_errors",
    """
    WITH e AS (SELECT event_id, CAST(round(value * 100) AS BIGINT) AS n FROM events)
    SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN n % 7 <> 0 THEN n * 2 ELSE -1 END AS doubled,
           CASE WHEN n % 7 = 0 THEN 'ValueError: bad number ' || n ELSE '' END AS message,
           CASE WHEN n % 7 = 0 THEN 'Internal error' ELSE '' END AS code
    FROM e
    """,
)
def map_capture_errors(spark, base):
    out = H.map_handler(
        event_messages(spark, base), _strict_number, columns=("id", "keys", "value"), on_error="capture"
    )
    # One pass over the output; split_errors would run the handler for each of its two results.
    return out.select(
        "id",
        F.coalesce(S.text_to_int("value"), F.lit(-1)).alias("doubled"),
        F.coalesce("error.message", F.lit("")).alias("message"),
        F.coalesce("error.code", F.lit("")).alias("code"),
    )


def _parts(keys, datum):
    for part in datum.value.split(b","):
        yield Message(part, keys=keys)


_PARTS_SQL = """
    WITH parts AS (SELECT doc_id, unnest(string_split(text, ',')) AS part FROM documents)
    SELECT doc_id, count(*) AS n_parts, CAST(sum(strlen(part)) AS BIGINT) AS n_bytes FROM parts GROUP BY doc_id
"""


def _documents(spark, base):
    docs = read_table(spark, base, "documents")
    return E.to_envelope(docs, id=F.col("doc_id").cast("string"), value=S.text_to_bytes("text"))


@query("map_stream_handler", _PARTS_SQL)
def map_stream_handler(spark, base):
    out = H.map_stream_handler(_documents(spark, base), _parts, columns=("id", "value"))
    return out.groupBy(F.col("id").cast("bigint").alias("doc_id")).agg(
        F.count(F.lit(1)).alias("n_parts"), F.sum(F.octet_length("value").cast("bigint")).alias("n_bytes")
    )


@query("map_stream_table_function", _PARTS_SQL)
def map_stream_table_function(spark, base):
    H.register_map_stream(spark, "split_parts", lambda value: value.split(b","))
    docs = _documents(spark, base).select("id", "value")
    out = spark.sql("SELECT id, p.pos, p.value FROM {docs}, LATERAL split_parts(value) AS p", docs=docs)
    return out.groupBy(F.col("id").cast("bigint").alias("doc_id")).agg(
        F.count(F.lit(1)).alias("n_parts"), F.sum(F.octet_length("value").cast("bigint")).alias("n_bytes")
    )


def _batch(rows):
    out = []
    for d in rows:
        answer = BatchResponse(d.id)
        answer.messages = [Message(part, keys=d.keys) for part in d.headers["user"].encode().split(b"1")]
        out.append(answer)
    return out


@query(
    "batch_map_handler",
    """
    WITH p AS (SELECT event_id, string_split(CAST(user_id AS VARCHAR), '1') AS l FROM events)
    SELECT CAST(event_id AS VARCHAR) AS id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS value_text FROM p
    """,
)
def batch_map_handler(spark, base):
    out = H.batch_map_handler(event_messages(spark, base), _batch, columns=("id", "keys", "headers"))
    return out.select("id", "pos", S.bytes_to_text("value").alias("value_text"))


class _Lookup:
    """Stands for a client of an outside service."""

    def __init__(self):
        self.calls = 0

    def price(self, number: int) -> int:
        self.calls += 1
        return number * 3


def _priced(client, datum):
    return [Message(str(client.price(int(datum.value))).encode(), keys=datum.keys)]


@query(
    "concurrent_enrichment",
    """
    SELECT CAST(event_id AS VARCHAR) AS id, CAST(round(value * 100) AS BIGINT) * 3 AS price FROM events
    """,
)
def concurrent_enrichment(spark, base):
    out = H.map_concurrent(
        event_messages(spark, base), _priced, _Lookup, columns=("id", "keys", "value"), max_in_flight=16
    )
    return out.select("id", S.text_to_int("value").alias("price"))


_MIDDLE = datetime(2024, 1, 15, tzinfo=timezone.utc)


def _by_half(keys, datum):
    if keys == ["error"]:
        return [Message.drop(datum.event_time)]
    half = "second" if datum.event_time >= _MIDDLE else "first"
    when = _MIDDLE if half == "second" else None
    return [Message(datum.value, keys=keys, tags=[half], event_time=when)]


@query(
    "source_transform_handler",
    """
    SELECT CAST(event_id AS VARCHAR) AS id,
           CASE WHEN event_type = 'error' THEN 'dropped' WHEN ts >= TIMESTAMP '2024-01-15' THEN 'second' ELSE 'first' END AS tag,
           CASE WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
                WHEN ts >= TIMESTAMP '2024-01-15' THEN '2024-01-15 00:00:00.000000'
                ELSE '0001-01-01 00:00:00.000000' END AS event_time
    FROM events
    """,
)
def source_transform_handler(spark, base):
    out = H.source_transform_handler(
        event_messages(spark, base), _by_half, columns=("id", "keys", "value", "event_time")
    )
    tag = F.when(E.is_dropped(), "dropped").otherwise(F.element_at("tags", 1))
    return out.select("id", tag.alias("tag"), time_text("event_time").alias("event_time"))


class _CountAndSum:
    """Mergeable: row count and total of the payload numbers."""

    def __init__(self):
        self.count = self.total = 0

    def add(self, datum):
        self.count += 1
        self.total += int(datum.value)

    def state(self):
        return f"{self.count},{self.total}".encode()

    def merge(self, state):
        count, total = state.split(b",")
        self.count += int(count)
        self.total += int(total)

    def result(self, keys, window):
        yield Message(self.state(), keys=keys)


def _count_total(value):
    parts = F.split(S.bytes_to_text(value), ",")
    return F.get(parts, 0).cast("bigint").alias("counter"), F.get(parts, 1).cast("bigint").alias("cents")


@query(
    "reduce_mergeable_handler",
    """
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S.%f') AS window_start, event_type AS key,
           count(*) AS counter, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM events GROUP BY ALL
    """,
)
def reduce_mergeable_handler(spark, base):
    out = G.reduce_mergeable(event_messages(spark, base), "1 day", _CountAndSum, columns=("value",))
    return out.select(
        time_text("window.start").alias("window_start"), F.element_at("keys", 1).alias("key"), *_count_total("value")
    )


@query(
    "session_mergeable_handler",
    f"SELECT key, window_start, window_end, counter, cents FROM ({SESSION_SQL.format(key='event_type', gap='40 MINUTE')})",
)
def session_mergeable_handler(spark, base):
    out = G.session_handler(event_messages(spark, base), "40 minutes", _CountAndSum, columns=("value",))
    return out.select(
        F.element_at("keys", 1).alias("key"),
        time_text("window.start").alias("window_start"),
        time_text("window.end").alias("window_end"),
        *_count_total("value"),
    )


async def _first_and_count(keys, datums, window):
    count, first = 0, None
    async for d in datums:
        count += 1
        first = first or d.id
    return [Message(f"{first},{count}".encode(), keys=keys)]


def _user_messages(spark, base):
    rows = event_messages(spark, base, "user_id", "event_id")
    return E.rekey(rows, F.col("user_id").cast("string"))


@query(
    "reduce_handler",
    """
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S.%f') AS window_start, CAST(user_id AS VARCHAR) AS key,
           arg_min(event_id, ts) AS first_id, count(*) AS counter
    FROM events GROUP BY ALL
    """,
)
def reduce_handler(spark, base):
    out = G.reduce_handler(
        _user_messages(spark, base), "1 day", _first_and_count, columns=("id",), order=("event_time", "event_id")
    )
    first, count = _count_total("value")
    return out.select(
        time_text("window.start").alias("window_start"), F.element_at("keys", 1).alias("key"),
        first.alias("first_id"), count.alias("counter"),
    )


class _EveryThree:
    def __init__(self, start):
        self.count = start

    async def handler(self, keys, datums, window):
        async for _ in datums:
            self.count += 1
            if self.count % 3 == 0:
                yield Message(f"{self.count},0".encode(), keys=keys)
        yield Message(f"{self.count},1".encode(), keys=keys)


@query(
    "reduce_stream_handler",
    """
    WITH r AS (SELECT date_trunc('day', ts) AS w, user_id, row_number() OVER (PARTITION BY date_trunc('day', ts), user_id ORDER BY ts) AS rn FROM events),
    n AS (SELECT w, user_id, max(rn) AS n FROM r GROUP BY ALL)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start, CAST(user_id AS VARCHAR) AS key, CAST(rn // 3 - 1 AS INTEGER) AS pos, rn AS counter, CAST(0 AS BIGINT) AS final FROM r WHERE rn % 3 = 0
    UNION ALL
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f'), CAST(user_id AS VARCHAR), CAST(n // 3 AS INTEGER), n, 1 FROM n
    """,
)
def reduce_stream_handler(spark, base):
    out = G.reduce_handler(
        _user_messages(spark, base), "1 day", _EveryThree, init_args=(0,), columns=("id",), order=("event_time",)
    )
    count, final = _count_total("value")
    return out.select(
        time_text("window.start").alias("window_start"), F.element_at("keys", 1).alias("key"), "pos",
        count.alias("counter"), final.alias("final"),
    )


class _Counter:
    """Counts the rows of its key, which arrive in event-time order, and passes each on."""

    def __init__(self):
        self.seen = 0

    def handler(self, datums):
        for d in datums:
            self.seen += 1
            yield Message.of(d, value=f"{self.seen},{len(d.keys)}".encode())


@query(
    "accumulate_handler",
    """
    SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS key,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS counter,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time, '1970-01-01 00:00:00.000000' AS window_start,
           strftime(max(ts - INTERVAL 1 HOUR) OVER (PARTITION BY user_id ORDER BY ts, event_id), '%Y-%m-%d %H:%M:%S.%f') AS window_end
    FROM events
    """,
)
def accumulate_handler(spark, base):
    rows = _user_messages(spark, base).withColumn("watermark", F.col("event_time") - F.expr("interval 1 hour"))
    out = G.accumulate_handler(
        rows, _Counter, columns=("id", "keys", "event_time", "watermark"), order=("event_time", "event_id")
    )
    return out.select(
        "id", F.element_at("keys", 1).alias("key"), _count_total("value")[0],
        time_text("event_time").alias("event_time"),
        time_text("window.start").alias("window_start"), time_text("window.end").alias("window_end"),
    )
