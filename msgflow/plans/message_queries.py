"""Envelope, metadata, scalar, map and routing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from msgflow.functions import metadata as M
from msgflow.functions import scalars as S
from msgflow.operators import envelope as E
from msgflow.operators import mapping as MP
from msgflow.operators import routing as R
from msgflow.operators import transform as TR
from msgflow.operators import reduce as RD
from msgflow.plans.registry import cents, event_messages, query, time_text
from msgflow.sources.tables import read_table


@query(
    "envelope_defaults",
    """
    SELECT CAST(event_id AS VARCHAR) AS id,
           CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS n_keys,
           CASE WHEN event_type = 'view' THEN '' ELSE props END AS value_text,
           CASE WHEN event_type = 'signup' THEN '0001-01-01 00:00:00.000000'
                ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS event_time,
           0 AS n_tags, 0 AS n_headers, 0 AS n_groups,
           'copy-' || CAST(event_id AS VARCHAR) AS copied_value, 1 AS copied_keys
    FROM events
    """,
)
def envelope_defaults(spark, base):
    events = read_table(spark, base, "events")
    kind = F.col("event_type")
    rows = E.to_envelope(
        events,
        id=F.col("event_id").cast("string"),
        keys=F.when(kind != "error", E.strings(kind)),
        value=F.when(kind != "view", S.text_to_bytes("props")),
        event_time=F.when(kind != "signup", F.col("ts")),
    )
    copied = E.from_datum(
        rows.withColumn("value0", F.col("value")).withColumn("keys0", F.col("keys")),
        value=S.text_to_bytes(F.concat(F.lit("copy-"), F.col("id"))),
        keys=E.strings("copied"),
    )
    return copied.select(
        "id",
        F.size("keys0").alias("n_keys"),
        S.bytes_to_text("value0").alias("value_text"),
        time_text("event_time").alias("event_time"),
        F.size("tags").alias("n_tags"),
        F.size("headers").alias("n_headers"),
        M.meta_len("user_metadata").alias("n_groups"),
        S.bytes_to_text("value").alias("copied_value"),
        F.size("keys").alias("copied_keys"),
    )


@query(
    "message_lists",
    """
    SELECT CAST(event_id AS VARCHAR) AS id, u.pos AS pos, u.value_text AS value_text, u.n_keys AS n_keys, 3 AS n_messages,
           event_type AS first_text, 'tail' AS last_text
    FROM events, (VALUES (0), (1), (2)) AS p(pos),
    LATERAL (SELECT p.pos AS pos,
                    CASE p.pos WHEN 0 THEN event_type WHEN 1 THEN props ELSE 'tail' END AS value_text,
                    CASE p.pos WHEN 0 THEN 1 ELSE 0 END AS n_keys) AS u
    """,
)
def message_lists(spark, base):
    events = read_table(spark, base, "events").withColumn("id", F.col("event_id").cast("string"))
    pair = E.messages(
        E.message(S.text_to_bytes("event_type"), keys=E.strings(F.col("event_type"))),
        E.message(S.text_to_bytes("props")),
    )
    rows = events.withColumn("items", E.messages_append(pair, E.message(F.lit("tail").cast("binary"))))
    rows = rows.withColumns(
        {
            "n_messages": E.messages_len("items"),
            "first_text": S.bytes_to_text(E.message_at("items", 0)["value"]),
            "last_text": S.bytes_to_text(E.message_at("items", -1)["value"]),
        }
    )
    out = MP.map_messages(rows, F.col("items"), keep=("id", "n_messages", "first_text", "last_text"))
    return out.select(
        "id", "pos", S.bytes_to_text("value").alias("value_text"), F.size("keys").alias("n_keys"),
        "n_messages", "first_text", "last_text",
    )


@query(
    "validate_rows",
    """
    SELECT event_type, user_id % 10 <> 0 AS valid, count(*) AS n FROM events GROUP BY ALL
    """,
)
def validate_rows(spark, base):
    events = read_table(spark, base, "events")
    maybe_null = F.when(F.col("user_id") % 10 != 0, F.col("user_id").cast("string"))
    rows = E.to_envelope(events, keep=["event_type"], keys=E.strings(F.col("event_type"), maybe_null))
    return rows.groupBy("event_type", E.is_valid(rows).alias("valid")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "drop_and_keep",
    """
    SELECT CAST(event_id AS VARCHAR) AS id, event_type AS value_text FROM events
    WHERE event_type NOT IN ('error', 'view')
    """,
)
def drop_and_keep(spark, base):
    rows = event_messages(spark, base, "event_type").withColumn("value", S.text_to_bytes("event_type"))
    marked = E.to_drop(rows, F.col("event_type") == "error")
    kept = MP.filter_value(E.drop_marked(marked), "view")
    return MP.forward(kept).select("id", S.bytes_to_text("value").alias("value_text"))


@query(
    "rekey_tag_route",
    """
    SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS edge,
           CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS key,
           CAST(event_id AS VARCHAR) AS id, event_id AS number
    FROM events
    """,
)
def rekey_tag_route(spark, base):
    rows = event_messages(spark, base, "event_id").withColumn("value", S.int_to_le_bytes("event_id"))
    edges = R.route(R.even_odd(rows), {"even": ["even-tag"], "odd": ["odd-tag"]})
    labelled = [df.withColumn("edge", F.lit(name)) for name, df in edges.items()]
    return R.fan_in(*labelled).select(
        "edge", F.element_at("keys", 1).alias("key"), "id", S.le_bytes_to_int("value").alias("number")
    )


@query(
    "route_multi_tag",
    """
    WITH t AS (SELECT value, CASE WHEN value >= 100 THEN 1 ELSE 0 END AS big,
                      CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS paid
               FROM events WHERE event_type <> 'error'),
    e AS (SELECT 'alerts' AS edge, value FROM t WHERE big = 1 OR paid = 1
          UNION ALL SELECT 'paid', value FROM t WHERE paid = 1
          UNION ALL SELECT 'all', value FROM t)
    SELECT edge, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM e GROUP BY edge
    """,
)
def route_multi_tag(spark, base):
    rows = event_messages(spark, base, "event_type", "value", "cents").toDF(
        *E.ENVELOPE.names, "event_type", "amount", "cents"
    )
    tags = F.array_compact(
        F.array(
            F.when(F.col("amount") >= 100, F.lit("big")),
            F.when(F.col("event_type").isin("purchase", "signup"), F.lit("paid")),
        )
    )
    tagged = E.to_drop(E.with_tags(rows, tags), F.col("event_type") == "error")
    routed = R.route_labelled(tagged, {"alerts": ["big", "paid"], "paid": ["paid"], "all": None})
    return routed.groupBy("edge").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))


@query(
    "fan_in",
    """
    SELECT origin, count(*) AS n, sum(CASE WHEN cents IS NULL THEN 1 ELSE 0 END)::BIGINT AS without_cents,
           strftime(max(t), '%Y-%m-%d %H:%M:%S.%f') AS last_time
    FROM (SELECT 'events' AS origin, ts AS t, CAST(round(value * 100) AS BIGINT) AS cents FROM events
          UNION ALL SELECT 'orders', o_orderdate, NULL FROM orders)
    GROUP BY origin
    """,
)
def fan_in(spark, base):
    events = event_messages(spark, base, "cents").withColumn("origin", F.lit("events"))
    orders = read_table(spark, base, "orders")
    orders = E.to_envelope(orders, id=F.col("o_orderkey").cast("string"), event_time=F.col("o_orderdate"))
    merged = R.fan_in(events, orders.withColumn("origin", F.lit("orders")))
    return merged.groupBy("origin").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("cents").isNull()).alias("without_cents"),
        time_text(F.max("event_time")).alias("last_time"),
    )


@query(
    "meta_add_remove",
    """
    SELECT CAST(event_id AS VARCHAR) AS id,
           'audit{by=' || event_type || ',step=2};empty{};info{user=' || user_id || '}' AS written,
           'audit{step=2};info{user=' || user_id || '}' AS removed,
           'audit{by=' || event_type || ',step=2};empty{};info{user=' || user_id || '}' AS unchanged,
           'audit,empty,info' AS groups, 'by,step' AS audit_keys,
           CAST(user_id AS VARCHAR) AS user_text, true AS absent,
           true AS has_info, false AS has_other, 3 AS n_groups, 0 AS cleared,
           'info{user=' || user_id || '}' AS after_delete
    FROM events
    """,
)
def meta_add_remove(spark, base):
    events = read_table(spark, base, "events")
    md = M.meta_from_dict({"audit": {"by": F.lit("nobody"), "step": "1"}})
    md = M.meta_set_group(md, "audit", M.group_from({"by": F.col("event_type"), "step": "2"}))
    md = M.meta_add_key(md, "info", "user", F.col("user_id").cast("string"))
    md = M.meta_create_group(M.meta_create_group(md, "empty"), "info")
    rows = events.select(F.col("event_id").cast("string").alias("id"), md.alias("md"))
    removed = M.meta_remove_group(M.meta_remove_key("md", "audit", "by"), "empty")
    cut = M.meta_remove_key(M.meta_add_key("md", "tmp", "k", "v"), "tmp", "k")
    unchanged = M.meta_remove_key(M.meta_remove_group(cut, "no-group"), "info", "no-key")
    return rows.select(
        "id",
        M.meta_text("md").alias("written"),
        M.meta_text(removed).alias("removed"),
        M.meta_text(unchanged).alias("unchanged"),
        F.array_join(M.meta_groups("md"), ",").alias("groups"),
        F.array_join(M.meta_keys("md", "audit"), ",").alias("audit_keys"),
        S.bytes_to_text(M.meta_value("md", "info", "user")).alias("user_text"),
        M.meta_value("md", "info", "nothing").isNull().alias("absent"),
        M.meta_contains("md", "info").alias("has_info"),
        M.meta_contains("md", "other").alias("has_other"),
        M.meta_len("md").alias("n_groups"),
        M.meta_len(M.meta_clear()).alias("cleared"),
        M.meta_text(M.meta_del_group(M.meta_del_group("md", "audit"), "empty")).alias("after_delete"),
    )


@query(
    "from_props",
    """
    SELECT CAST(event_id AS VARCHAR) AS id, 'props{k=' || json_extract_string(props, '$.k') || '}' AS user_text,
           0 AS n_system, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events
    """,
)
def from_props(spark, base):
    events = read_table(spark, base, "events")
    k = F.get_json_object("props", "$.k")
    rows = E.to_envelope(
        events, id=F.col("event_id").cast("string"), user_metadata=M.meta_from_dict({"props": {"k": k}})
    )
    return rows.select(
        "id",
        M.meta_text("user_metadata").alias("user_text"),
        M.meta_len("system_metadata").alias("n_system"),
        S.text_to_int(M.meta_get_group("user_metadata", "props")["k"]).alias("k"),
    )


@query(
    "scalar_codec",
    """
    SELECT event_id, hex(encode(event_type)) AS type_hex, event_id AS le_number, user_id AS text_number,
           CAST(len(string_split(props, ':')) AS INTEGER) AS n_parts, string_split(props, ':')[1] AS first_part,
           contains(event_type, 'ew') AS has_ew, event_type = 'click' AS is_click,
           user_id % 2 = 0 AS even_user
    FROM events
    """,
)
def scalar_codec(spark, base):
    events = read_table(spark, base, "events")
    kind = S.text_to_bytes("event_type")
    parts = S.split_text("props", ":")
    return events.select(
        "event_id",
        F.hex(kind).alias("type_hex"),
        S.le_bytes_to_int(S.int_to_le_bytes("event_id")).alias("le_number"),
        S.text_to_int(S.text_to_bytes(F.col("user_id").cast("string"))).alias("text_number"),
        F.size(parts).alias("n_parts"),
        F.element_at(parts, 1).alias("first_part"),
        S.payload_contains(kind, "ew").alias("has_ew"),
        S.payload_equals(kind, "click").alias("is_click"),
        S.is_even("user_id").alias("even_user"),
    )


@query(
    "payload_format",
    """
    SELECT event_id, 'payload:' || props || ' event_time:' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '+00:00'
             || ' watermark:' || strftime(ts - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') || '+00:00' AS payload,
           epoch_us(ts) // 1000 AS millis, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S.%f') AS rounded,
           ts < TIMESTAMP '2024-01-15' AS early,
           CASE WHEN event_id % 2 = 0 THEN '9999-12-31 23:59:59.999999' ELSE '0001-01-01 00:00:00.000000' END AS clamped
    FROM events
    """,
)
def payload_format(spark, base):
    events = read_table(spark, base, "events")
    # Epoch seconds far outside the representable years.
    far = F.when(F.col("event_id") % 2 == 0, F.lit(8210266876799)).otherwise(F.lit(-8210266876799))
    return events.select(
        "event_id",
        S.payload_text(S.text_to_bytes("props"), "ts", F.col("ts") - F.expr("interval 1 hour")).alias("payload"),
        S.to_epoch_millis("ts").alias("millis"),
        time_text(S.from_epoch_millis(S.to_epoch_millis("ts"))).alias("rounded"),
        S.before("ts", "2024-01-15").alias("early"),
        time_text(S.clamp_epoch_seconds(far)).alias("clamped"),
    )


@query(
    "prime_filter",
    """
    SELECT p_partkey, p_size,
           NOT EXISTS (SELECT 1 FROM range(2, 51) r(d)
                       WHERE r.d < CAST(ceil(sqrt(p_size)) AS BIGINT) AND p_size % r.d = 0) AS loose_prime,
           p_size >= 2 AND NOT EXISTS (SELECT 1 FROM range(2, 51) r(d)
                       WHERE r.d < p_size AND r.d * r.d <= p_size AND p_size % r.d = 0) AS is_prime
    FROM part
    """,
)
def prime_filter(spark, base):
    part = read_table(spark, base, "part")
    return part.select(
        "p_partkey",
        "p_size",
        S.is_prime("p_size").alias("loose_prime"),
        S.is_prime("p_size", strict=True).alias("is_prime"),
    )


@query(
    "flat_map_documents",
    """
    WITH parts AS (SELECT doc_id, unnest(string_split(text, ',')) AS part FROM documents)
    SELECT doc_id, count(*) AS n_parts, sum(length(part))::BIGINT AS n_chars,
           sum(CASE WHEN part = '' THEN 1 ELSE 0 END)::BIGINT AS n_empty
    FROM parts GROUP BY doc_id
    """,
)
def flat_map_documents(spark, base):
    docs = read_table(spark, base, "documents").select("doc_id", "text")
    rows = docs.select("doc_id", S.text_to_bytes("text").alias("value"), E.strings().alias("tags"))
    parts = MP.flat_map(rows)
    text = S.bytes_to_text("value")
    return parts.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_parts"),
        F.sum(F.char_length(text).cast("bigint")).alias("n_chars"),
        F.count_if(text == "").alias("n_empty"),
    )


@query(
    "batch_pairing",
    """
    WITH req AS (SELECT CAST(event_id AS VARCHAR) AS id, event_type, event_id FROM events),
    resp AS (SELECT id FROM req WHERE event_type <> 'error'
             UNION ALL SELECT id FROM req WHERE event_type = 'view'
             UNION ALL SELECT 'x' || id FROM req WHERE event_type = 'signup'),
    a AS (SELECT id, count(*) AS n FROM req GROUP BY id),
    b AS (SELECT id, count(*) AS n FROM resp GROUP BY id),
    j AS (SELECT coalesce(a.n, 0) AS requests, coalesce(b.n, 0) AS responses FROM a FULL JOIN b ON a.id = b.id)
    SELECT CASE WHEN requests = 0 THEN 'UNKNOWN' WHEN responses = 0 THEN 'MISSING'
                WHEN responses > requests THEN 'DUPLICATE' ELSE 'OK' END AS verdict,
           count(*) AS n_ids, sum(responses)::BIGINT AS n_responses
    FROM j GROUP BY 1
    """,
)
def batch_pairing(spark, base):
    rows = event_messages(spark, base, "event_type").select("id", "event_type")
    kind = F.col("event_type")
    sent = F.array_compact(
        F.array(
            F.when(kind != "error", F.col("id")),
            F.when(kind == "view", F.col("id")),
            F.when(kind == "signup", F.concat(F.lit("x"), F.col("id"))),
        )
    )
    responses = rows.select(F.explode(sent).alias("id"))
    return (
        MP.pair_responses(rows, responses)
        .groupBy("verdict")
        .agg(F.count(F.lit(1)).alias("n_ids"), F.sum("responses").alias("n_responses"))
    )


_ORDER_BUCKETS = (
    TR.TimeBucket(until="1997-01-01", tag=None),
    TR.TimeBucket(until="1999-01-01", tag="within_1997_1998", event_time="1997-01-01"),
    TR.TimeBucket(until=None, tag="after_1998", event_time="1999-01-01"),
)


def _orders(spark, base):
    orders = read_table(spark, base, "orders")
    return E.to_envelope(
        orders,
        keep=["o_totalprice"],
        id=F.col("o_orderkey").cast("string"),
        keys=E.strings(F.col("o_orderpriority")),
        event_time=F.col("o_orderdate"),
    )


@query(
    "transform_years",
    """
    WITH t AS (SELECT CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'dropped'
                           WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'within_1997_1998'
                           ELSE 'after_1998' END AS tag,
                      CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN o_orderdate
                           WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN TIMESTAMP '1997-01-01'
                           ELSE TIMESTAMP '1999-01-01' END AS t, o_orderpriority, o_totalprice FROM orders)
    SELECT tag, strftime(t, '%Y-%m-%d %H:%M:%S.%f') AS event_time,
           CASE WHEN tag = 'dropped' THEN '' ELSE o_orderpriority END AS key, count(*) AS n,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM t GROUP BY ALL
    """,
)
def transform_years(spark, base):
    rows = TR.bucket_event_time(_orders(spark, base), _ORDER_BUCKETS)
    tag = F.when(E.is_dropped(), "dropped").otherwise(F.element_at("tags", 1))
    return rows.groupBy(
        tag.alias("tag"),
        time_text("event_time").alias("event_time"),
        F.coalesce(F.get("keys", 0), F.lit("")).alias("key"),
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(cents("o_totalprice")).alias("cents"))


@query(
    "transform_metadata",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS id,
           'filter_info{original_event_time=' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ',result='
             || CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'within_1997_1998' ELSE 'after_1998' END || '}' AS metadata,
           CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN '1997-01-01 00:00:00.000000'
                ELSE '1999-01-01 00:00:00.000000' END AS event_time
    FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
    """,
)
def transform_metadata(spark, base):
    result = (
        F.when(S.before("event_time", "1997-01-01"), "before")
        .when(S.before("event_time", "1999-01-01"), "within_1997_1998")
        .otherwise("after_1998")
    )
    noted = TR.record_decision(_orders(spark, base), result)
    rows = E.drop_marked(TR.bucket_event_time(noted, _ORDER_BUCKETS))
    return rows.select("id", M.meta_text("user_metadata").alias("metadata"), time_text("event_time").alias("event_time"))


@query(
    "assign_event_time",
    """
    SELECT CAST(event_id AS VARCHAR) AS id,
           CASE WHEN event_type = 'error' THEN '0001-01-01 00:00:00.000000'
                ELSE strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S.%f') END AS event_time
    FROM events
    """,
)
def assign_event_time(spark, base):
    rows = event_messages(spark, base, "event_type")
    day = F.when(F.col("event_type") != "error", F.date_trunc("day", "event_time"))
    return TR.assign_event_time(rows, day).select("id", time_text("event_time").alias("event_time"))


@query(
    "even_odd_daily",
    """
    SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS edge, event_type AS key,
           strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S.%f') AS window_start,
           count(*) AS counter, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM events GROUP BY ALL
    """,
)
def even_odd_daily(spark, base):
    rows = event_messages(spark, base, "event_id", "event_type", "cents")
    routed = R.route_labelled(
        R.even_odd(rows, F.col("event_id")), {"even": ["even-tag"], "odd": ["odd-tag"]}
    )
    reduced = RD.reduce_window(
        routed, "1 day", F.count(F.lit(1)).alias("counter"), F.sum("cents").alias("cents"), by=("edge", "event_type")
    )
    return reduced.select(
        "edge", F.col("event_type").alias("key"), time_text("window.start").alias("window_start"), "counter", "cents"
    )
