"""Source transforms: event-time reassignment, filtering and tagging right after a source.

Run these before ``withWatermark`` and remove drops after it, on a stream with
:func:`msgflow.operators.watermarks.drop_marked`: a dropped row still counts as read and must advance
the watermark with its event time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.functions import metadata as M
from msgflow.functions import scalars as S
from msgflow.operators import envelope as E


def assign_event_time(df: DataFrame, event_time: Column) -> DataFrame:
    """Set a new event time; NULL becomes the missing-time value."""
    return df.withColumn("event_time", F.coalesce(event_time.cast("timestamp"), E.missing_event_time()))


@dataclass(frozen=True)
class TimeBucket:
    """Rows before ``until`` (None: all others) get ``tag`` and ``event_time``; a None tag drops them."""

    until: str | None
    tag: str | None
    event_time: str | None = None


# The bounds, tags and times of the event-time filter.
YEAR_2022 = (
    TimeBucket(until="2022-01-01", tag=None),
    TimeBucket(until="2023-01-01", tag="within_year_2022", event_time="2022-01-01"),
    TimeBucket(until=None, tag="after_year_2022", event_time="2023-01-01"),
)


def bucket_event_time(df: DataFrame, buckets: Sequence[TimeBucket] = YEAR_2022) -> DataFrame:
    """Filter and bucket rows by event time; the first bucket whose bound is not reached applies.

    Dropped rows are only marked, and keep their event time.
    """
    original = F.col("event_time")
    tags: Column | None = None
    times: Column | None = None
    dropped: Column | None = None
    for b in buckets:
        hit = F.lit(True) if b.until is None else S.before(original, b.until)
        tag = E.strings() if b.tag is None else E.strings(b.tag)
        new_time = original if b.event_time is None else F.lit(b.event_time).cast("timestamp")
        drop = F.lit(b.tag is None)
        tags = F.when(hit, tag) if tags is None else tags.when(hit, tag)
        times = F.when(hit, new_time) if times is None else times.when(hit, new_time)
        dropped = F.when(hit, drop) if dropped is None else dropped.when(hit, drop)
    if tags is None:
        return df
    # Rows after the last bound pass unchanged.
    marked = df.withColumns(
        {
            "tags": F.coalesce(tags, E.strings()),
            "_drop": F.coalesce(dropped, F.lit(False)),
            "event_time": F.coalesce(times, original),
        }
    )
    return E.to_drop(marked, F.col("_drop")).drop("_drop")


def record_decision(df: DataFrame, decision: Column, *, group: str = "filter_info") -> DataFrame:
    """Write the outcome and the original event time of a transform into user metadata."""
    original = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")
    md = M.meta_add_key("user_metadata", group, "result", decision)
    return df.withColumn("user_metadata", M.meta_add_key(md, group, "original_event_time", original))
