"""Watermarks on batch tables and streams, late rows, and progress of idle sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.operators import envelope as E
from msgflow.operators import ordered as O
from msgflow.functions.scalars import interval_micros


CHUNK = 100_000  # heartbeats that one row is expanded to at once


def max_delay(df: DataFrame, delay: str, *, time: str = "event_time") -> DataFrame:
    """A stream's watermark: the highest event time seen, less ``delay``."""
    return df.withWatermark(time, delay)


def after_watermark(condition: Column, *, time: str = "event_time") -> Column:
    """A row condition that Spark applies only after the watermark has seen the row.

    Spark moves filters below ``withWatermark`` unless they read the event time, and a row filtered
    there would not advance the watermark. No time is before year 1, so the result is the condition.
    """
    return condition | (F.col(time) < E.missing_event_time())


def drop_marked(df: DataFrame, *, time: str = "event_time") -> DataFrame:
    """Remove dropped rows of a stream whose watermark is set: they count for it, and go no further."""
    return df.filter(after_watermark(~E.is_dropped(), time=time))


def with_watermark_column(
    df: DataFrame, source: Sequence[str], order: Sequence[str], delay: str, *, time: str = "event_time", **opts
) -> DataFrame:
    """The watermark each row saw on arrival: highest event time of its source so far, less ``delay``.

    ``order`` is the arrival order within a source, such as its offset.
    """
    seen = O.running(df.drop("watermark"), source, order, {"_max": O.Running("max", F.col(time))}, **opts)
    return seen.withColumn("watermark", F.col("_max") - F.expr(f"interval {delay}")).drop("_max")


def is_late(*, time: str = "event_time") -> Column:
    return F.coalesce(F.col(time) < F.col("watermark"), F.lit(False))


def split_late(df: DataFrame, *, time: str = "event_time") -> tuple[DataFrame, DataFrame]:
    """(on-time rows, late rows) of a table that has a watermark column."""
    return df.filter(~is_late(time=time)), df.filter(is_late(time=time))


def idle_heartbeats(
    df: DataFrame,
    source: Sequence[str],
    order: Sequence[str],
    *,
    threshold: str,
    step: str,
    increment: str,
    time: str = "event_time",
    **opts,
) -> DataFrame:
    """Watermark progress while a source is silent.

    Once a source has been idle for ``threshold``, its watermark moves by ``increment``, and again
    after every further ``step``. Rows are (source, ``heartbeat_at``, ``watermark``), never past the
    next row. Sources are told apart by ``source``; ``order`` starts with ``time``. Rows without an
    event time say nothing of idleness and are left out.
    """
    df = df.filter(F.col(time) > E.missing_event_time())
    seen = O.running(df, source, order, {"_last": O.Running("max", F.col(time))}, exclusive=True, **opts)
    idle = F.unix_micros(time) - F.unix_micros("_last")
    wait, every, plus = interval_micros(threshold), interval_micros(step), interval_micros(increment)
    # A long silence is generated in chunks, so that no row holds all of its heartbeats.
    silent = seen.filter(idle >= wait).withColumn("_n", F.floor((idle - wait) / every).cast("bigint"))
    chunks = silent.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"_n div {CHUNK}L"))))
    low, high = F.col("_c") * CHUNK, F.least(F.col("_n"), (F.col("_c") + 1) * CHUNK - 1)
    beats = chunks.withColumn("_k", F.explode(F.sequence(low, high)))
    last = F.unix_micros("_last")
    moved = F.least(last + (F.col("_k") + 1) * plus, F.unix_micros(time))
    return beats.select(
        *source,
        F.timestamp_micros(last + wait + F.col("_k") * every).alias("heartbeat_at"),
        F.timestamp_micros(moved).alias("watermark"),
    )
