"""Streaming queries: the events table read as a stream and processed to its current end.

Streams emit a window, session or bucket once the watermark has passed it; the SQL states that.
"""

from __future__ import annotations

import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from msgflow.functions import scalars as S
from msgflow.message import Message, Response
from msgflow.operators import envelope as E
from msgflow.operators import reduce as RD
from msgflow.operators import session as SE
from msgflow.operators import transform as TR
from msgflow.operators import watermarks as WM
from msgflow.plans.handler_queries import _CountAndSum, _count_total, _first_and_count
from msgflow.plans.registry import cents, query, time_text
from msgflow.plans.window_queries import SESSION_SQL
from msgflow.session import shared_dir
from msgflow.sources import custom
from msgflow.streaming import run, sinks, stateful

# The watermark after the last batch: the highest event time, in whole milliseconds, less the delay.
_WM = "(SELECT make_timestamp(epoch_us(max(ts)) // 1000 * 1000) - INTERVAL 1 HOUR FROM events)"


def _stream(spark, base, *keep, key="user_id"):
    events = run.read_table_stream(spark, base, "events")
    events = events.withColumn("cents", cents())
    rows = E.to_envelope(
        events,
        keep=keep,
        id=F.col("event_id").cast("string"),
        keys=E.strings(F.col(key).cast("string")),
        value=S.text_to_bytes(F.col("cents").cast("string")),
        event_time=F.col("ts"),
    )
    return WM.max_delay(rows, "1 hour")


@query(
    "stream_reduce",
    f"""
    WITH r AS (SELECT date_trunc('hour', ts) AS w, event_type AS key, count(*) AS counter,
                      CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY ALL)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start, key, counter, cents FROM r WHERE w + INTERVAL 1 HOUR <= {_WM}
    """,
)
def stream_reduce(spark, base):
    rows = _stream(spark, base, "cents", key="event_type")
    out = RD.reduce_window(rows, "1 hour", F.count(F.lit(1)).alias("counter"), F.sum("cents").alias("cents"))
    done = run.run_to_table(out)
    return done.select(
        time_text("window.start").alias("window_start"), F.element_at("keys", 1).alias("key"), "counter", "cents"
    )


@query(
    "stream_transform",
    f"""
    WITH r AS (SELECT date_trunc('day', ts) AS w, count(*) AS counter FROM events WHERE event_type <> 'error' GROUP BY ALL)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start, counter FROM r WHERE w + INTERVAL 1 DAY <= {_WM}
    """,
)
def stream_transform(spark, base):
    events = run.read_table_stream(spark, base, "events")
    rows = E.to_envelope(events, keep=["event_type", "ts"])
    timed = TR.assign_event_time(rows, F.col("ts"))
    marked = E.to_drop(timed, F.col("event_type") == "error")
    # Dropped rows advance the watermark, so they leave only after it is set.
    live = WM.drop_marked(WM.max_delay(marked, "1 hour"))
    out = RD.reduce_window(live, "1 day", F.count(F.lit(1)).alias("counter"), by=())
    done = run.run_to_table(out)
    return done.select(time_text("window.start").alias("window_start"), "counter")


@query(
    "stream_sessions",
    f"""
    WITH s AS ({SESSION_SQL.format(key='user_id', gap='6 HOUR')})
    SELECT CAST(key AS VARCHAR) AS key, window_start, window_end, counter, cents FROM s
    WHERE strptime(window_end, '%Y-%m-%d %H:%M:%S.%f') <= {_WM}
    """,
)
def stream_sessions(spark, base):
    out = SE.session_reduce_stream(
        _stream(spark, base, "cents"), "6 hours", F.count(F.lit(1)).alias("counter"), F.sum("cents").alias("cents")
    )
    done = run.run_to_table(out)
    return done.select(
        F.element_at("keys", 1).alias("key"), time_text("window.start").alias("window_start"),
        time_text("window.end").alias("window_end"), "counter", "cents",
    )


@query(
    "stream_session_handler",
    f"""
    WITH s AS ({SESSION_SQL.format(key='user_id', gap='6 HOUR')})
    SELECT CAST(key AS VARCHAR) AS key, window_start, window_end, counter, cents FROM s
    WHERE strptime(window_end, '%Y-%m-%d %H:%M:%S.%f') <= {_WM}
    """,
)
def stream_session_handler(spark, base):
    out = stateful.session_handler_stream(_stream(spark, base), "6 hours", _CountAndSum, columns=("value",))
    done = run.run_to_table(out)
    return done.select(
        F.element_at("keys", 1).alias("key"), time_text("window.start").alias("window_start"),
        time_text("window.end").alias("window_end"), *_count_total("value"),
    )


@query(
    "stream_sorter",
    f"""
    WITH b AS (SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS w FROM events)
    SELECT event_id, strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS bucket_start,
           CAST(row_number() OVER (PARTITION BY event_type, w ORDER BY ts, event_id) - 1 AS INTEGER) AS pos
    FROM b WHERE w + INTERVAL 6 HOUR <= {_WM}
    """,
)
def stream_sorter(spark, base):
    rows = _stream(spark, base, "event_id", key="event_type").select("keys", "event_time", "event_id")
    out = stateful.sort_stream(rows, ["keys"], ["event_time", "event_id"], bucket="6 hours")
    done = run.run_to_table(out)
    return done.select("event_id", time_text("bucket_start").alias("bucket_start"), "pos")


@query(
    "stream_early_counter",
    f"""
    WITH r AS (SELECT date_trunc('day', ts) AS w, user_id AS key,
                      row_number() OVER (PARTITION BY date_trunc('day', ts), user_id ORDER BY ts, event_id) AS rn FROM events),
    n AS (SELECT w, key, max(rn) AS n FROM r GROUP BY ALL)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start, CAST(key AS VARCHAR) AS key, rn // 3 AS emit, CAST(3 AS BIGINT) AS counter, false AS final
    FROM r WHERE rn % 3 = 0
    UNION ALL
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f'), CAST(key AS VARCHAR), n // 3 + 1, n % 3, true FROM n WHERE w + INTERVAL 1 DAY <= {_WM}
    """,
)
def stream_early_counter(spark, base):
    done = run.run_to_table(stateful.early_counter_stream(_stream(spark, base), "1 day", threshold=2))
    return done.select(
        time_text("window.start").alias("window_start"), F.element_at("keys", 1).alias("key"), "emit", "counter", "final"
    )


@query(
    "stream_reduce_handler",
    f"""
    WITH r AS (SELECT date_trunc('day', ts) AS w, user_id, arg_min(event_id, ts) AS first_id, count(*) AS counter FROM events GROUP BY ALL)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start, CAST(user_id AS VARCHAR) AS key, first_id, counter
    FROM r WHERE w + INTERVAL 1 DAY <= {_WM}
    """,
)
def stream_reduce_handler(spark, base):
    out = stateful.reduce_handler_stream(
        _stream(spark, base), "1 day", _first_and_count, columns=("id",), order=("event_time",)
    )
    first, count = _count_total("value")
    return run.run_to_table(out).select(
        time_text("window.start").alias("window_start"), F.element_at("keys", 1).alias("key"),
        first.alias("first_id"), count.alias("counter"),
    )


class _Counter(stateful.StreamAccumulator):
    def __init__(self):
        self.count = 0

    def add(self, datum):
        self.count += 1
        return [Message(str(self.count).encode(), keys=datum.keys, id=datum.id, event_time=datum.event_time)]


@query(
    "stream_accumulator",
    f"""
    WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 2 DAY THEN 1 ELSE 0 END AS new
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM g),
    m AS (SELECT user_id, max(no) AS last_no FROM s GROUP BY user_id)
    SELECT CAST(user_id AS VARCHAR) AS key, CAST(event_id AS VARCHAR) AS id, false AS eof,
           row_number() OVER (PARTITION BY user_id, no ORDER BY ts, event_id) AS counter FROM s
    UNION ALL
    SELECT CAST(s.user_id AS VARCHAR), '', true, -1 FROM s JOIN m ON s.user_id = m.user_id
    GROUP BY s.user_id, s.no, m.last_no HAVING s.no < m.last_no OR max(s.ts) + INTERVAL 2 DAY <= {_WM}
    """,
)
def stream_accumulator(spark, base):
    out = stateful.accumulate_stream(
        _stream(spark, base), _Counter, timeout="2 days", columns=("id", "keys"), order=("event_time",)
    )
    done = run.run_to_table(out)
    number = F.when(F.col("eof"), F.lit(-1)).otherwise(S.text_to_int("value", strict=False))
    return done.select(
        F.element_at("keys", 1).alias("key"), F.coalesce("id", F.lit("")).alias("id"), "eof", number.alias("counter")
    )


async def _answer(datums):
    out = []
    async for d in datums:
        kind = d.keys[0]
        if kind == "error":
            out.append(Response.failure(d.id, "the sink refused it"))
        elif kind == "view":
            out.append(Response.fallback(d.id))
        elif kind == "purchase":
            out.append(Response.on_success(d.id, Message(b"sold " + d.value, ["on_success"])))
        elif kind == "signup":
            out.append(Response.serve(d.id, b"served " + d.id.encode()))
        else:
            out.append(Response.success(d.id))
    return out


@query(
    "stream_sink_routes",
    """
    WITH e AS (SELECT CAST(event_id AS VARCHAR) AS id, event_type AS t, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS v FROM events)
    SELECT 'primary' AS destination, id, v AS value_text FROM e WHERE t IN ('click', 'purchase')
    UNION ALL SELECT 'fallback', id, v FROM e WHERE t = 'view'
    UNION ALL SELECT 'retry', id, v FROM e WHERE t = 'error'
    UNION ALL SELECT 'serving', id, 'served ' || id FROM e WHERE t = 'signup'
    UNION ALL SELECT 'on_success', id, 'sold ' || v FROM e WHERE t = 'purchase'
    """,
)
def stream_sink_routes(spark, base):
    folder = shared_dir(spark, "sink")
    rows = _stream(spark, base, key="event_type").select("id", "keys", "value", "event_time")
    write = sinks.sink_batches(lambda batch: sinks.sink_handler(batch, _answer), f"{folder}/data")
    run.run_each_batch(rows, write, f"{folder}/checkpoint")
    out = spark.read.parquet(f"{folder}/data")
    return out.select("destination", "id", S.bytes_to_text("value").alias("value_text"))


class EventLog(custom.Source):
    """The rows of a Parquet file, or of a folder's files by name, as four partitions of consecutive offsets."""

    parts = 4

    def __init__(self, options):
        super().__init__(options)
        self.files = sorted(ds.dataset(options["path"], format="parquet").files)
        self.rows = [pq.read_metadata(name).num_rows for name in self.files]
        self.size = sum(self.rows)

    def partitions(self):
        return list(range(self.parts))

    def total_partitions(self):
        return self.parts

    def _begin(self, partition):
        return self.size * partition // self.parts

    def latest(self, partition):
        return self._begin(partition + 1) - self._begin(partition)

    def prune(self, partition, start, end, bounds):
        """Row groups whose event times are all outside the bounds are left out, by the statistics in the footers."""
        low, high = self._begin(partition) + start, self._begin(partition) + end
        out, at = [], 0
        for name, held in zip(self.files, self.rows):
            if at < high and at + held > low:
                footer = pq.read_metadata(name)
                time = footer.schema.names.index("ts")
                first = at
                for group in map(footer.row_group, range(footer.num_row_groups)):
                    last = first + group.num_rows
                    known = group.column(time).statistics
                    sure = known is not None and known.has_min_max and known.null_count == 0
                    if not sure or bounds.overlaps(known.min, known.max):
                        out.append((max(first, low) - self._begin(partition), min(last, high) - self._begin(partition)))
                    first = last
            at += held
        return out

    def read(self, partition, start, end):
        low, high = self._begin(partition) + start, self._begin(partition) + end
        at = 0
        for name, held in zip(self.files, self.rows):
            if at < high and at + held > low:
                yield from self._rows(pq.ParquetFile(name), at, low, high)
            at += held

    def _rows(self, file, at, low, high):
        for group in range(file.num_row_groups):
            rows = file.metadata.row_group(group).num_rows
            if at < high and at + rows > low:
                for batch in file.iter_batches(row_groups=[group], columns=["ts", "user_id", "event_type", "props"]):
                    keep = batch.slice(max(low - at, 0), max(min(high, at + batch.num_rows) - max(low, at), 0))
                    for row in keep.to_pylist():
                        yield custom.SourceRow(
                            row["props"].encode(),
                            event_time=row["ts"],
                            keys=[row["event_type"]],
                            headers={"user": str(row["user_id"])},
                        )
                    at += batch.num_rows
            else:
                at += rows


_SOURCE_SQL = """
    WITH n AS (SELECT count(*) AS n FROM events),
    r AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events),
    p AS (SELECT r.*, n.n, q.p FROM r, n, (VALUES (0), (1), (2), (3)) AS q(p)
          WHERE i >= n.n * q.p // 4 AND i < n.n * (q.p + 1) // 4)
    SELECT p || '-' || (i - n * p // 4) AS id, CAST(p AS INTEGER) AS partition_id, CAST(i - n * p // 4 AS VARCHAR) AS offset_text,
           event_type AS key, CAST(user_id AS VARCHAR) AS user_header, props AS payload, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time
    FROM p
"""


def _source_rows(rows):
    return rows.select(
        "id",
        "offset.partition_id",
        S.bytes_to_text("offset.offset").alias("offset_text"),
        F.element_at("keys", 1).alias("key"),
        E.header("user").alias("user_header"),
        S.bytes_to_text("value").alias("payload"),
        time_text("event_time").alias("event_time"),
    )


@query("source_read", _SOURCE_SQL)
def source_read(spark, base):
    custom.register_source(spark, "event_log", EventLog)
    reader = spark.read.format("event_log").option("path", f"{base}/events.parquet").option("rows_per_task", 50_000)
    return _source_rows(reader.load())


@query("source_stream", _SOURCE_SQL)
def source_stream(spark, base):
    custom.register_source(spark, "event_log", EventLog)
    reader = spark.readStream.format("event_log").option("path", f"{base}/events.parquet")
    return _source_rows(run.run_to_table(reader.option("rows_per_task", 50_000).load()))


@query(
    "source_pushdown",
    f"""
    SELECT * FROM ({_SOURCE_SQL})
    WHERE partition_id IN (1, 2) AND event_time >= '2024-01-10 12:00:00.000000' AND event_time < '2024-01-20 00:00:00.000000'
    """,
)
def source_pushdown(spark, base):
    """Filters on partition and event time reach the source, which then leaves out what it knows not to match."""
    spark.conf.set(custom.PUSHDOWN, "true")
    custom.register_source(spark, "event_log", EventLog)
    rows = spark.read.format("event_log").option("path", f"{base}/events.parquet").option("rows_per_task", 50_000).load()
    at = F.col("event_time")
    asked = (at >= F.lit("2024-01-10 12:00:00").cast("timestamp")) & (at < F.lit("2024-01-20").cast("timestamp"))
    return _source_rows(rows.filter(F.col("offset.partition_id").isin(1, 2) & asked))
