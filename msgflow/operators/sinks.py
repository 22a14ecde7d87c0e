"""Sink responses as columns, and routing of rows to destinations by their status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.operators import envelope as E

SUCCESS, FAILURE, FALLBACK, SERVE, ON_SUCCESS = "SUCCESS", "FAILURE", "FALLBACK", "SERVE", "ON_SUCCESS"

PRIMARY, FALLBACK_SINK, ON_SUCCESS_SINK, SERVING, RETRY = "primary", "fallback", "on_success", "serving", "retry"


def response(
    status: Column | str,
    *,
    err_msg: Column | None = None,
    payload: Column | None = None,
    message: Column | None = None,
) -> Column:
    """One response struct. ``message`` replaces the row for the on-success sink (NULL: the original
    row goes there); ``payload`` is what a serving response returns."""
    no_message = F.lit(None).cast(E.MESSAGE.simpleString())
    return F.struct(
        (F.lit(status) if isinstance(status, str) else status).alias("status"),
        (err_msg if err_msg is not None else F.lit(None)).cast("string").alias("err_msg"),
        (payload if payload is not None else F.lit(None)).cast("binary").alias("payload"),
        (message if message is not None else no_message).alias("message"),
    )


def respond_success() -> Column:
    return response(SUCCESS)


def respond_failure(err_msg: str | Column) -> Column:
    return response(FAILURE, err_msg=err_msg if isinstance(err_msg, Column) else F.lit(err_msg))


def respond_fallback() -> Column:
    return response(FALLBACK)


def respond_on_success(message: Column | None = None) -> Column:
    return response(ON_SUCCESS, message=message)


def respond_serve(payload: Column) -> Column:
    return response(SERVE, payload=payload)


def resolve_status(
    success: Column, fallback: Column, on_success: Column, serve: Column | None = None
) -> Column:
    """One status from flags: success wins over fallback, over on-success, over serve, over failure."""
    false = F.lit(False)
    out = (
        F.when(F.coalesce(success, false), SUCCESS)
        .when(F.coalesce(fallback, false), FALLBACK)
        .when(F.coalesce(on_success, false), ON_SUCCESS)
    )
    if serve is not None:
        out = out.when(F.coalesce(serve, false), SERVE)
    return out.otherwise(FAILURE)


def sink(df: DataFrame, responses: Column) -> DataFrame:
    """Attach the response of each row, flattened to ``status``, ``err_msg``, ``payload``, ``message``."""
    return df.withColumn("_r", responses).select(*df.columns, "_r.*")


def destinations(responded: DataFrame) -> DataFrame:
    """One row per destination of each responded row, in one pass.

    Successful rows are in the primary sink; on-success rows are there too and also go on to the
    on-success sink, replaced by their message if it has one. Failed rows go to the retry table.
    """
    status = F.col("status")
    takes = F.array_compact(
        F.array(
            F.when(status.isin(SUCCESS, ON_SUCCESS), F.lit(PRIMARY)),
            F.when(status == FALLBACK, F.lit(FALLBACK_SINK)),
            F.when(status == ON_SUCCESS, F.lit(ON_SUCCESS_SINK)),
            F.when(status == SERVE, F.lit(SERVING)),
            F.when(status == FAILURE, F.lit(RETRY)),
        )
    )
    out = responded.withColumn("destination", F.explode(takes))
    replaced = (F.col("destination") == ON_SUCCESS_SINK) & F.col("message").isNotNull()
    value = (
        F.when(replaced, F.col("message.value"))
        .when(F.col("destination") == SERVING, F.col("payload"))
        .otherwise(F.col("value"))
    )
    changes = {"value": value}
    for name in ("keys", "user_metadata"):
        if name in responded.columns:
            changes[name] = F.when(replaced, F.col(f"message.{name}")).otherwise(F.col(name))
    return out.withColumns(changes).drop("message", "payload")


def log_text() -> Column:
    """What the log sink prints for a row: payload, headers and event time."""
    headers = F.to_json("headers")
    return F.concat_ws(" ", F.decode("value", "UTF-8"), headers, F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
