"""Streaming queries over several micro-batches: the events table replayed in parts, state carried from one to the next."""

from __future__ import annotations

from pyspark.sql import functions as F

from msgflow.functions import scalars as S
from msgflow.message import Message, Response
from msgflow.operators import envelope as E
from msgflow.operators import reduce as RD
from msgflow.operators import watermarks as WM
from msgflow.operators.session_form import session_form
from msgflow.plans.handler_queries import _CountAndSum, _count_total
from msgflow.plans.registry import cents, query, time_text
from msgflow.plans.stream_queries import _WM
from msgflow.plans.window_queries import SESSION_SQL
from msgflow.session import shared_dir
from msgflow.sources.tables import read_table
from msgflow.streaming import late, run, stateful
from msgflow.streaming.acks import OffsetLog, acknowledging
from msgflow.streaming import reduce as SR
from msgflow.streaming.redelivery import redeliver, run_until_empty
from msgflow.streaming.replay import replay, time_slices


def _messages(df, *keep, key="user_id"):
    return E.to_envelope(
        df.withColumns({"cents": cents(), "amount": F.round("value").cast("long")}),
        keep=keep,
        id=F.col("event_id").cast("string"),
        keys=E.strings(F.col(key).cast("string")),
        value=S.text_to_bytes(F.col("cents").cast("string")),
        event_time=F.col("ts"),
    )


def _replayed(spark, base, *keep, key="user_id", parts=4):
    """The events in time order, ``parts`` micro-batches."""
    events = read_table(spark, base, "events")
    return WM.max_delay(_messages(replay(events, time_slices(events, "ts", parts)), *keep, key=key), "1 hour")


class _Thirds(SR.StreamReducer):
    """Speaks at every third row, and at the end."""

    def __init__(self):
        self.count = 0

    async def add(self, datum):
        self.count += 1
        if self.count % 3 == 0:
            yield Message(f"{self.count}".encode(), keys=datum.keys)

    async def close(self):
        return [Message(f"{self.count}".encode())]


@query(
    "stream_reduce_stream_handler",
    f"""
    WITH r AS (SELECT date_trunc('day', ts) AS w, user_id, row_number() OVER (PARTITION BY date_trunc('day', ts), user_id ORDER BY ts) AS rn FROM events),
    n AS (SELECT w, user_id, max(rn) AS n FROM r GROUP BY ALL)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start, CAST(user_id AS VARCHAR) AS key, rn // 3 - 1 AS pos, rn AS counter, false AS final
    FROM r WHERE rn % 3 = 0
    UNION ALL
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f'), '', n // 3, n, true FROM n WHERE w + INTERVAL 1 DAY <= {_WM}
    """,
)
def stream_reduce_stream_handler(spark, base):
    out = SR.reduce_resumable_stream(_replayed(spark, base), "1 day", _Thirds, columns=("id",))
    done = run.run_to_table(out)
    key = F.coalesce(F.get("keys", 0), F.lit("")).alias("key")
    return done.select(time_text("window.start").alias("window_start"), key, "pos", S.text_to_int("value").alias("counter"), "final")


_MERGED_SQL = """
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start, key, count(*) AS counter,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM (SELECT date_trunc('day', ts) AS w, {key} AS key, value FROM events) WHERE w + INTERVAL 1 DAY <= {wm} GROUP BY ALL
"""


def _merged(spark, base, keyed):
    rows = _replayed(spark, base, key="event_type")
    done = run.run_to_table(SR.reduce_mergeable_stream(rows, "1 day", _CountAndSum, keyed=keyed, columns=("value",)))
    key = F.coalesce(F.get("keys", 0), F.lit("")).alias("key")
    return done.select(time_text("window.start").alias("window_start"), key, *_count_total("value"))


@query("stream_reduce_mergeable", _MERGED_SQL.format(key="event_type", wm=_WM))
def stream_reduce_mergeable(spark, base):
    return _merged(spark, base, True)


@query("stream_reduce_mergeable_unkeyed", _MERGED_SQL.format(key="''", wm=_WM))
def stream_reduce_mergeable_unkeyed(spark, base):
    return _merged(spark, base, False)


@query(
    "stream_early_sum",
    f"""
    WITH RECURSIVE r AS (
        SELECT date_trunc('day', ts) AS w, event_type AS key, CAST(round(value) AS BIGINT) AS v,
               row_number() OVER (PARTITION BY date_trunc('day', ts), event_type ORDER BY ts, event_id) AS rn FROM events),
    f AS (SELECT w, key, rn, v >= 100 AS hit, CASE WHEN v >= 100 THEN 0 ELSE v END AS acc, v AS total FROM r WHERE rn = 1
          UNION ALL
          SELECT r.w, r.key, r.rn, f.acc + r.v >= 100, CASE WHEN f.acc + r.v >= 100 THEN 0 ELSE f.acc + r.v END, f.acc + r.v
          FROM f JOIN r ON r.w = f.w AND r.key = f.key AND r.rn = f.rn + 1),
    m AS (SELECT w, key, max(rn) AS rn, count(*) FILTER (WHERE hit) AS hits FROM f WHERE w + INTERVAL 1 DAY <= {_WM} GROUP BY ALL)
    SELECT strftime(f.w, '%Y-%m-%d %H:%M:%S.%f') AS window_start, f.key, row_number() OVER (PARTITION BY f.w, f.key ORDER BY f.rn) AS emit,
           CAST(f.total AS BIGINT) AS total, false AS final FROM f JOIN m USING (w, key) WHERE f.hit
    UNION ALL
    SELECT strftime(f.w, '%Y-%m-%d %H:%M:%S.%f'), f.key, m.hits + 1, CAST(f.acc AS BIGINT), true FROM f JOIN m USING (w, key, rn)
    """,
)
def stream_early_sum(spark, base):
    """Of closed windows; an open one has emitted up to the watermark's hour."""
    rows = _replayed(spark, base, "amount", "event_id", key="event_type")
    out = SR.early_sum_stream(rows, "1 day", F.col("amount"), F.col("event_id"), 100)
    done = run.run_to_table(out)
    closed = done.filter("final").select("window", "keys")
    out = done.join(closed, ["window", "keys"], "left_semi")
    return out.select(time_text("window.start").alias("window_start"), F.element_at("keys", 1).alias("key"), "emit", "total", "final")


@query(
    "stream_late_rows",
    """
    WITH e AS (SELECT event_id, ts, event_id % 3 AS part FROM events),
    m AS (SELECT part, make_timestamp(epoch_us(max(ts)) // 1000 * 1000) - INTERVAL 10 DAY AS mark FROM e GROUP BY part)
    SELECT event_id, CAST(part AS INTEGER) AS batch_id, coalesce(ts <= (SELECT max(mark) FROM m WHERE m.part < e.part), false) AS late FROM e
    """,
)
def stream_late_rows(spark, base):
    """Three micro-batches that all span the whole time: the second and third have late rows."""
    events = read_table(spark, base, "events")
    rows = replay(events, [F.col("event_id") % 3 == i for i in range(3)])
    folder = shared_dir(spark, "late")
    run.run_each_batch(rows.select("event_id", F.col("ts").alias("event_time")), late.late_batches(folder, "10 days"), f"{folder}/checkpoint")
    on_time, behind = late.split_rows(spark, folder)
    both = on_time.withColumn("late", F.lit(False)).unionByName(behind.withColumn("late", F.lit(True)))
    return both.select("event_id", "batch_id", "late")


@query(
    "stream_open_windows",
    f"""
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start, key, count(*) AS counter, CAST(sum(cents) AS BIGINT) AS cents
    FROM (SELECT time_bucket(INTERVAL 10 DAY, ts, TIMESTAMP '1970-01-01') AS w, event_type AS key, CAST(round(value * 100) AS BIGINT) AS cents FROM events)
    WHERE w + INTERVAL 10 DAY > {_WM} GROUP BY ALL
    """,
)
def stream_open_windows(spark, base):
    rows = _replayed(spark, base, "cents", key="event_type")
    out = RD.reduce_window(rows, "10 days", F.count(F.lit(1)).alias("counter"), F.sum("cents").alias("cents"))
    checkpoint = shared_dir(spark, "open")
    run.run_to_table(out, checkpoint=checkpoint)
    held = late.open_windows(spark, checkpoint)
    return held.select(
        time_text("window.start").alias("window_start"), F.element_at("keys", 1).alias("key"),
        F.col("buffer.count").alias("counter"), F.col("buffer.sum").alias("cents"),
    )


class _SessionCounter:
    """Counts the rows of its session; what it has can be handed over midway."""

    def __init__(self):
        self.count = 0

    async def session_reduce(self, keys, datums):
        async for _ in datums:
            self.count += 1
        yield Message(str(self.count).encode(), keys=keys)

    async def accumulator(self):
        return str(self.count).encode()

    async def merge_accumulator(self, held):
        self.count += int(held)


@query(
    "stream_session_reduce",
    f"""
    SELECT CAST(key AS VARCHAR) AS key, window_start, window_end, counter FROM ({SESSION_SQL.format(key='user_id', gap='6 HOUR')})
    WHERE strptime(window_end, '%Y-%m-%d %H:%M:%S.%f') <= {_WM}
    """,
)
def stream_session_reduce(spark, base):
    out = stateful.session_handler_stream(_replayed(spark, base), "6 hours", session_form(_SessionCounter), columns=("id",))
    done = run.run_to_table(out)
    return done.select(
        F.element_at("keys", 1).alias("key"), time_text("window.start").alias("window_start"),
        time_text("window.end").alias("window_end"), S.text_to_int("value").alias("counter"),
    )


@query(
    "stream_acknowledged",
    """
    SELECT CAST(event_id % 4 AS INTEGER) AS partition_id, max(event_id) AS "offset", count(*) AS n_rows,
           count(*) FILTER (WHERE event_type = 'error') AS n_written FROM events GROUP BY ALL
    """,
)
def stream_acknowledged(spark, base):
    """Six micro-batches acknowledge their offsets as they are written; the log folds every two."""
    events = read_table(spark, base, "events")
    rows = replay(events, time_slices(events, "ts", 6))
    folder = shared_dir(spark, "acknowledged")
    log = OffsetLog(spark, f"{folder}/log", every=2)

    def write(batch, batch_id):
        batch.filter("event_type = 'error'").write.mode("overwrite").parquet(f"{folder}/out/batch_id={batch_id}")

    partition, offset = F.col("event_id") % 4, F.col("event_id")
    run.run_each_batch(rows, acknowledging(write, log, partition, offset), f"{folder}/checkpoint")
    written = spark.read.parquet(f"{folder}/out").groupBy((F.col("event_id") % 4).cast("int").alias("partition_id"))
    return log.acknowledged().join(written.agg(F.count(F.lit(1)).alias("n_written")), "partition_id")


def _refuses_twice(datums):
    for d in datums:
        number = int(d.id)
        if number % 97 == 0 and (d.attempt < 2 or number % 291 == 0):
            yield Response.failure(d.id, f"refused {d.attempt}")
        else:
            yield Response.success(d.id)


@query(
    "stream_redelivery",
    """
    SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 97 = 0 THEN 3 ELSE 1 END AS attempts,
           CASE WHEN event_id % 291 = 0 THEN 'dead' ELSE 'taken' END AS outcome, CASE WHEN event_id % 291 = 0 THEN 'refused 2' ELSE '' END AS err_msg
    FROM events
    """,
)
def stream_redelivery(spark, base):
    """Refused rows come again until taken; some never are."""
    events = read_table(spark, base, "events")
    rows = _messages(replay(events, time_slices(events, "ts", 3))).select("id", "keys", "event_time")
    done = run_until_empty(redeliver(rows, _refuses_twice, tries=3, pause_ms=50), at_most=900)
    return done.select("id", "attempts", "outcome", F.coalesce("err_msg", F.lit("")).alias("err_msg"))
