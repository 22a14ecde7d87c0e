"""Sink, side input, error and source-shape queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from msgflow.functions import scalars as S
from msgflow.operators import envelope as E
from msgflow.operators import errors as ER
from msgflow.operators import side_inputs as SI
from msgflow.operators import sinks as SK
from msgflow.plans.registry import event_messages, query, time_text
from msgflow.sources import progress
from msgflow.sources import shapes
from msgflow.sources.tables import read_table

_STATUS_SQL = """
    CASE WHEN event_type = 'error' THEN 'FAILURE' WHEN event_type = 'view' THEN 'FALLBACK'
         WHEN event_type = 'purchase' THEN 'ON_SUCCESS' WHEN event_type = 'signup' THEN 'SERVE'
         ELSE 'SUCCESS' END
"""


def _responded(spark, base):
    rows = event_messages(spark, base, "event_type", "event_id", "user_id", "cents")
    kind = F.col("event_type")
    replaced = E.message(S.text_to_bytes(F.concat(F.lit("sold "), F.col("id"))), keys=E.strings("on_success"))
    no_message = F.lit(None).cast(E.MESSAGE.simpleString())
    answer = (
        F.when(kind == "error", SK.respond_failure("the sink refused it"))
        .when(kind == "view", SK.respond_fallback())
        .when(kind == "purchase", SK.respond_on_success(F.when(F.col("user_id") % 2 == 0, replaced).otherwise(no_message)))
        .when(kind == "signup", SK.respond_serve(S.text_to_bytes(F.concat(F.lit("served "), F.col("id")))))
        .otherwise(SK.respond_success())
    )
    return SK.sink(rows, answer)


@query(
    "sink_status",
    f"""
    SELECT {_STATUS_SQL} AS status,
           CASE WHEN event_type = 'error' THEN 'the sink refused it' ELSE '' END AS err_msg, count(*) AS n,
           CAST(sum(CASE WHEN event_type = 'purchase' AND user_id % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS replaced
    FROM events GROUP BY ALL
    """,
)
def sink_status(spark, base):
    return _responded(spark, base).groupBy("status", F.coalesce("err_msg", F.lit("")).alias("err_msg")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("message").isNotNull()).alias("replaced")
    )


@query(
    "sink_precedence",
    """
    WITH f AS (SELECT event_id % 2 = 0 AS s, event_id % 3 = 0 AS f, event_id % 5 = 0 AS o, event_id % 7 = 0 AS v FROM events)
    SELECT CASE WHEN s THEN 'SUCCESS' WHEN f THEN 'FALLBACK' WHEN o THEN 'ON_SUCCESS' WHEN v THEN 'SERVE'
                ELSE 'FAILURE' END AS status, count(*) AS n
    FROM f GROUP BY 1
    """,
)
def sink_precedence(spark, base):
    rows = event_messages(spark, base, "event_id")

    def flag(n):
        return F.col("event_id") % n == 0

    status = SK.resolve_status(flag(2), flag(3), flag(5), flag(7))
    return rows.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "sink_split",
    f"""
    WITH e AS (SELECT CAST(event_id AS VARCHAR) AS id, event_type, user_id, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS v,
                      {_STATUS_SQL} AS status FROM events)
    SELECT 'primary' AS destination, id, v AS value_text, event_type AS key FROM e WHERE status IN ('SUCCESS', 'ON_SUCCESS')
    UNION ALL SELECT 'fallback', id, v, event_type FROM e WHERE status = 'FALLBACK'
    UNION ALL SELECT 'retry', id, v, event_type FROM e WHERE status = 'FAILURE'
    UNION ALL SELECT 'serving', id, 'served ' || id, event_type FROM e WHERE status = 'SERVE'
    UNION ALL SELECT 'on_success', id, CASE WHEN user_id % 2 = 0 THEN 'sold ' || id ELSE v END,
                     CASE WHEN user_id % 2 = 0 THEN 'on_success' ELSE event_type END FROM e WHERE status = 'ON_SUCCESS'
    """,
)
def sink_split(spark, base):
    return SK.destinations(_responded(spark, base)).select(
        "destination", "id", S.bytes_to_text("value").alias("value_text"), F.element_at("keys", 1).alias("key")
    )


@query(
    "sink_log",
    """
    SELECT CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || ' {"user":"' || user_id || '"} '
           || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS line FROM events
    """,
)
def sink_log(spark, base):
    return event_messages(spark, base).select(SK.log_text().alias("line"))


def _versions(spark, base):
    """Orders as side input versions: one input per priority, NOT SPECIFIED ones are not broadcast."""
    orders = read_table(spark, base, "orders")
    return orders.select(
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderkey").alias("version"),
        F.col("o_orderdate").alias("version_time"),
        F.col("o_custkey").cast("string").cast("binary").alias("value"),
        (F.col("o_orderstatus") == "P").alias("no_broadcast"),
    )


@query(
    "side_input_latest",
    """
    SELECT o_orderpriority AS name, max(o_orderkey) AS version, CAST(arg_max(o_custkey, o_orderkey) AS VARCHAR) AS value_text
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1
    """,
)
def side_input_latest(spark, base):
    return SI.latest(_versions(spark, base)).select("name", "version", S.bytes_to_text("value").alias("value_text"))


@query(
    "side_input_rows",
    """
    SELECT event_id, (SELECT CAST(arg_max(o_custkey, o_orderkey) AS VARCHAR) FROM orders
                      WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P') AS current_text, 'no_value' AS initial_text
    FROM events
    """,
)
def side_input_rows(spark, base):
    versions = _versions(spark, base)
    rows = SI.with_side_input(event_messages(spark, base, "event_id"), versions, "1-URGENT", "current")
    rows = SI.with_side_input(rows, versions, "never broadcast", "initial")
    return rows.select(
        "event_id", S.bytes_to_text("current").alias("current_text"), S.bytes_to_text("initial").alias("initial_text")
    )


@query(
    "side_input_keyed",
    """
    SELECT n_name, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name
    """,
)
def side_input_keyed(spark, base):
    orders = read_table(spark, base, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    customers = read_table(spark, base, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nations = read_table(spark, base, "nation").select("n_nationkey", "n_name")
    side = SI.join_side_table(customers, nations, ["n_nationkey"])
    rows = SI.join_side_table(orders, side, ["c_custkey"])
    return rows.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents")
    )


@query(
    "side_input_asof",
    """
    WITH v AS (SELECT event_type AS name, ts AS version_time, event_id AS version, user_id FROM events WHERE user_id % 3 = 0),
    q AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'click' ELSE event_type END AS name, ts FROM events)
    SELECT q.event_id, coalesce(v.version, -1) AS version, coalesce('u' || v.user_id, 'no_value') AS value_text
    FROM q ASOF LEFT JOIN v ON q.name = v.name AND q.ts >= v.version_time
    """,
)
def side_input_asof(spark, base):
    events = read_table(spark, base, "events")
    versions = events.select(
        F.col("event_type").alias("name"),
        F.col("event_id").alias("version"),
        F.col("ts").alias("version_time"),
        S.text_to_bytes(F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("value"),
        (F.col("user_id") % 3 != 0).alias("no_broadcast"),
    )
    rows = event_messages(spark, base, "event_id", "event_type")
    name = F.when(F.col("event_type") == "view", "click").otherwise(F.col("event_type"))
    out = SI.side_input_asof(rows.withColumn("name", name), versions, order=("event_time", "event_id"))
    return out.select("event_id", F.coalesce("version", F.lit(-1)).alias("version"), S.bytes_to_text("side_input").alias("value_text"))


@query(
    "error_rows",
    """
    SELECT 'map' AS container, epoch_us(ts) // 1000000 AS "timestamp", 'Internal error' AS code,
           'bad number: ' || event_type AS message, 'id ' || event_id AS details
    FROM events WHERE event_type = 'error'
    UNION ALL
    SELECT 'good', user_id, '', '', '' FROM events WHERE event_type <> 'error'
    """,
)
def error_rows(spark, base):
    rows = event_messages(spark, base, "event_id", "event_type", "user_id")
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("user_id").cast("string"))
    rows = rows.withColumn("value", S.text_to_bytes(text))
    number = S.text_to_int("value", strict=False)
    good, bad = ER.capture(
        rows,
        number.isNull(),
        F.concat(F.lit("bad number: "), S.bytes_to_text("value")),
        timestamp=F.unix_seconds("event_time"),
        details=F.concat(F.lit("id "), F.col("id")),
        container="map",
    )
    empty = F.lit("")
    numbers = good.select(
        F.lit("good").alias("container"), number.alias("timestamp"),
        empty.alias("code"), empty.alias("message"), empty.alias("details"),
    )
    return bad.unionByName(numbers)


@query(
    "first_error",
    """
    WITH e AS (SELECT 'source-' || (event_id % 4) AS container, epoch_us(ts) // 1000000 AS t, 'failed on ' || props AS message,
                      'id ' || event_id AS details FROM events WHERE event_type = 'error'),
    r AS (SELECT *, row_number() OVER (PARTITION BY container ORDER BY t, message, details) AS rn FROM e)
    SELECT container, t AS "timestamp", 'Internal error' AS code, message, details FROM r WHERE rn = 1
    """,
)
def first_error(spark, base):
    rows = event_messages(spark, base, "event_type", "props")
    failed = rows.filter(F.col("event_type") == "error")
    _, *described = ER.error_columns(
        F.concat(F.lit("failed on "), F.col("props")),
        timestamp=F.unix_seconds("event_time"),
        details=F.concat(F.lit("id "), F.col("id")),
    )
    source = F.concat(F.lit("source-"), F.col("offset.partition_id")).alias("container")
    return ER.first_critical(failed.select(source, *described))


@query(
    "source_partitions",
    """
    SELECT CAST(event_id % 4 AS INTEGER) AS partition_id, count(*) AS n_rows, max(event_id) AS last_offset,
           count(*) - sum(CASE WHEN event_id <= 5000 THEN 1 ELSE 0 END)::BIGINT AS pending
    FROM events GROUP BY 1
    """,
)
def source_partitions(spark, base):
    rows = event_messages(spark, base)
    # What the reader has committed in each of its four partitions.
    committed = spark.range(4).select(F.col("id").cast("int").alias("partition_id"), F.lit(5000).cast("bigint").alias("committed"))
    return progress.backlog(rows, committed)


@query(
    "posted_event_time",
    """
    SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S.%f') AS event_time,
           'user-' || user_id AS key, props AS payload FROM events
    """,
)
def posted_event_time(spark, base):
    events = read_table(spark, base, "events")
    posted = events.select(
        "event_id",
        S.text_to_bytes("props").alias("body"),
        F.create_map(
            F.lit("event-time-ms"), F.unix_millis("ts").cast("string"),
            F.lit("key"), F.concat(F.lit("user-"), F.col("user_id").cast("string")),
        ).alias("headers"),
    )
    rows = shapes.from_posted(posted, time_header="event-time-ms", key_header="key", keep=["event_id"])
    return rows.select(
        "event_id", time_text("event_time").alias("event_time"), F.element_at("keys", 1).alias("key"),
        S.bytes_to_text("value").alias("payload"),
    )


@query(
    "kafka_shape",
    """
    SELECT 'events-' || (event_id % 4) || '-' || event_id AS id, event_type AS key, props AS payload,
           CAST(user_id AS VARCHAR) AS user_header, CAST(event_id % 4 AS INTEGER) AS partition_id, CAST(event_id AS VARCHAR) AS offset_text,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time
    FROM events
    """,
)
def kafka_shape(spark, base):
    events = read_table(spark, base, "events")
    records = events.select(
        S.text_to_bytes("event_type").alias("key"),
        S.text_to_bytes("props").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.array(
            F.struct(F.lit("user").alias("key"), S.text_to_bytes(F.col("user_id").cast("string")).alias("value"))
        ).alias("headers"),
    )
    rows = shapes.from_kafka(records)
    return rows.select(
        "id",
        F.element_at("keys", 1).alias("key"),
        S.bytes_to_text("value").alias("payload"),
        E.header("user").alias("user_header"),
        "offset.partition_id",
        S.bytes_to_text("offset.offset").alias("offset_text"),
        time_text("event_time").alias("event_time"),
    )
