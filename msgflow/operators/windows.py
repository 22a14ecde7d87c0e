"""Fixed windows: each row belongs to exactly one window, aligned to the epoch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow import constants as C
from msgflow.functions.scalars import interval_micros


def fixed_window(length: str, *, time: str = "event_time", slide: str | None = None) -> Column:
    """The tumbling window of a row. A slide would give a row several windows and is refused."""
    if slide is not None and slide != length:
        raise ValueError("reduce needs exactly one window per row: sliding windows are not supported")
    return F.window(time, length)


def plain_window(length: str, *, time: str = "event_time") -> Column:
    """The same window as an ordinary column, without the watermark that ``window`` inherits."""
    width = interval_micros(length)
    start = F.floor(F.unix_micros(time) / width) * width
    return F.struct(F.timestamp_micros(start).alias("start"), F.timestamp_micros(start + width).alias("end"))


def with_window(df: DataFrame, length: str, *, time: str = "event_time", slot: str = C.DEFAULT_SLOT) -> DataFrame:
    """Attach ``window`` and ``slot`` to each row (no shuffle)."""
    window = fixed_window(length, time=time)
    return df.withColumn("window", window).withColumn("slot", F.lit(slot))


def window_eof(reduced: DataFrame) -> DataFrame:
    """One completion row per distinct window, whatever the number of keys."""
    return reduced.select("window").distinct().withColumn("eof", F.lit(True))


def open_windows(df: DataFrame, length: str, watermark: Column, *, time: str = "event_time") -> DataFrame:
    """Windows that hold rows and end after ``watermark`` (a literal or a scalar subquery)."""
    window = df.select(fixed_window(length, time=time).alias("window")).distinct()
    return window.filter(F.col("window.end") > watermark)
