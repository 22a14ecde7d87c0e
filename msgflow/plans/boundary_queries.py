"""What happens at the edge of a batch: sink batches, side inputs retrieved between batches, maps spread over processes."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from msgflow.functions import scalars as S
from msgflow.message import Message, Response
from msgflow.operators import handlers as H
from msgflow.operators import side_inputs as SI
from msgflow.plans.registry import event_messages, query
from msgflow.plans.stream_state_queries import _messages
from msgflow.session import shared_dir
from msgflow.sources.tables import read_table
from msgflow.streaming import run, sinks
from msgflow.streaming.replay import replay, time_slices
from msgflow.streaming.side_inputs import with_refreshed_side_input

PARTS = 4

# The micro-batch of each event: its slice of the time that all events span.
_BATCHES = f"""
    WITH b AS (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events),
    e AS (SELECT events.*, CAST(floor((epoch_us(ts) - low) * {PARTS} / (high - low + 1)) AS INTEGER) AS batch FROM events, b)
"""


def _in_batches(spark, base):
    events = read_table(spark, base, "events")
    return _messages(replay(events, time_slices(events, "ts", PARTS)), "event_id", key="event_type")


def _answer(datums):
    for d in datums:
        kind = d.keys[0]
        if kind == "error":
            yield Response.failure(d.id, "the sink refused it")
        elif kind == "view":
            yield Response.fallback(d.id)
        elif kind == "purchase":
            yield Response.on_success(d.id, None)
        else:
            yield Response.success(d.id)


@query(
    "stream_sink_batches",
    _BATCHES
    + """
    , d AS (SELECT batch, event_id, 'primary' AS destination FROM e WHERE event_type NOT IN ('view', 'error')
            UNION ALL SELECT batch, event_id, 'fallback' FROM e WHERE event_type = 'view'
            UNION ALL SELECT batch, event_id, 'retry' FROM e WHERE event_type = 'error'
            UNION ALL SELECT batch, event_id, 'on_success' FROM e WHERE event_type = 'purchase')
    SELECT batch, destination, CAST(event_id AS VARCHAR) AS id FROM d
    """,
)
def stream_sink_batches(spark, base):
    """A plain (not async) sink handler; each batch ends, and all of its responses follow, before the next one."""
    folder = shared_dir(spark, "sink")
    rows = _in_batches(spark, base).select("id", "keys", "value", "event_time")
    run.run_each_batch(rows, sinks.sink_batches(lambda batch: sinks.sink_handler(batch, _answer), f"{folder}/data"), f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/data").select(F.col("batch_id").alias("batch"), "destination", "id")


@query(
    "side_input_retrieved",
    """
    WITH v AS (SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS version, count(*) AS n FROM orders GROUP BY 1),
    k AS (SELECT version, CASE WHEN version % 2 = 1 THEN CAST(n AS VARCHAR) ELSE '' END AS value_text, version % 2 = 0 AS kept FROM v),
    last AS (SELECT arg_max(value_text, version) AS value_text, max(version) AS version FROM k WHERE NOT kept)
    SELECT k.version, k.value_text, kept, coalesce(last.value_text, 'no_value') AS current_text, coalesce(last.version, -1) AS current_version
    FROM k, last
    """,
)
def side_input_retrieved(spark, base):
    """One retrieval per order priority: its count, broadcast for odd ones; even ones keep the value before."""
    orders = read_table(spark, base, "orders")
    first = F.substring("o_orderpriority", 1, 1).cast("bigint")
    counts = {r.v: r.n for r in orders.groupBy(first.alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()}  # five at most
    table = spark.createDataFrame([], SI.SCHEMA)
    for v, n in sorted(counts.items()):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(days=v)
        table = table.unionByName(SI.retrieve(spark, "orders", v, at, lambda v=v, n=n: str(n).encode() if v % 2 else None))
    rows = SI.with_side_input(table.withColumnRenamed("version", "asked"), table, "orders", "current", "current_version")
    return rows.select(
        F.col("asked").alias("version"),
        F.coalesce(S.bytes_to_text("value"), F.lit("")).alias("value_text"),
        F.col("no_broadcast").alias("kept"),
        S.bytes_to_text("current").alias("current_text"),
        F.coalesce("current_version", F.lit(-1)).alias("current_version"),
    )


@query(
    "stream_side_input_refresh",
    _BATCHES
    + """
    , n AS (SELECT batch, count(*) AS n FROM e GROUP BY batch)
    SELECT e.event_id, CAST(coalesce(n.batch, -1) AS BIGINT) AS version, coalesce(CAST(n.n AS VARCHAR), 'no_value') AS value_text
    FROM e LEFT JOIN n ON n.batch = e.batch - 1
    """,
)
def stream_side_input_refresh(spark, base):
    """After each micro-batch a retrieval stores how many rows it had; the next one sees that value."""
    folder = shared_dir(spark, "side")
    spark.createDataFrame([], SI.SCHEMA).write.parquet(f"{folder}/table/of=start")

    def read_table_now():
        return spark.read.schema(SI.SCHEMA).parquet(f"{folder}/table/*")

    def write(batch, batch_id):
        out = f"{folder}/rows/batch={batch_id}"
        batch.select("event_id", "side_input", "side_input_version").write.mode("overwrite").parquet(out)
        n = spark.read.parquet(out).count()
        at = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=batch_id)
        retrieved = SI.retrieve(spark, "rows", batch_id, at, lambda: str(n).encode())
        retrieved.write.mode("overwrite").parquet(f"{folder}/table/of={batch_id}")

    run.run_each_batch(_in_batches(spark, base), with_refreshed_side_input(read_table_now, "rows", write), f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/rows").select(
        "event_id",
        F.coalesce("side_input_version", F.lit(-1).cast("bigint")).alias("version"),
        S.bytes_to_text("side_input").alias("value_text"),
    )


def _divisors(keys, datum):
    n = int(datum.headers["user"])
    found = sum((1 if d * d == n else 2) for d in range(1, math.isqrt(n) + 1) if n % d == 0)
    return [Message(str(found).encode(), keys=keys)]


@query(
    "map_spread",
    """
    WITH u AS (SELECT DISTINCT user_id FROM events), d AS (SELECT user_id, unnest(range(1, user_id + 1)) AS d FROM u),
    n AS (SELECT user_id, count(*) AS n FROM d WHERE user_id % d = 0 GROUP BY user_id)
    SELECT CAST(event_id AS VARCHAR) AS id, event_type AS key, coalesce(n, 0) AS divisors FROM events LEFT JOIN n USING (user_id)
    """,
)
def map_spread(spark, base):
    """A CPU-heavy map over as many even partitions as there are cores, whatever the input's own split."""
    rows = H.spread(event_messages(spark, base), spark.sparkContext.defaultParallelism)
    out = H.map_handler(rows, _divisors, columns=("id", "keys", "headers"))
    return out.select("id", F.element_at("keys", 1).alias("key"), S.text_to_int("value").alias("divisors"))
