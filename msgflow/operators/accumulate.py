"""Accumulators over one unaligned window per key: sorting, counting, output windows and timeouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow import constants as C
from msgflow.operators import ordered as O
from msgflow.operators import session as SE


def sort_stream(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of each key in order: partition after partition, and sorted inside each.

    The range partitioning includes the order columns, so a hot key spans several partitions.
    """
    return df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)


def stream_position(df: DataFrame, group: Sequence[str], order: Sequence[str], **opts) -> DataFrame:
    """The place of each row in its sorted key, from 1, in ``position``."""
    return O.running_count(df, group, order, "position", **opts)


def running_counter(df: DataFrame, group: Sequence[str], order: Sequence[str], **opts) -> DataFrame:
    return O.running_count(df, group, order, "counter", **opts)


def output_window(
    df: DataFrame, group: Sequence[str], order: Sequence[str], *, watermark: str = "watermark", **opts
) -> DataFrame:
    """The window on each emitted row: from epoch 0 to the highest watermark emitted so far.

    NULL watermarks are ignored; before the first one the window is empty at epoch 0.
    """
    epoch = F.lit(C.EPOCH).cast("timestamp")
    seen = O.running(df, group, order, {"_wm": O.Running("max", F.col(watermark))}, **opts)
    window = F.struct(epoch.alias("start"), F.greatest(epoch, F.coalesce("_wm", epoch)).alias("end"))
    return seen.withColumn("window", window).drop("_wm")


def close_on_timeout(
    df: DataFrame, timeout: str, *, by: Sequence[str] = ("keys",), time: str = "event_time", slot: str = C.DEFAULT_SLOT
) -> DataFrame:
    """Completion rows: a key idle for longer than ``timeout`` is closed, and reopens on its next row.

    ``window`` runs from the first row of the active stretch to the closing time, last row + timeout.
    """
    closed = SE.session_reduce(df, timeout, {"rows": SE.Mergeable("count")}, by=by, time=time)
    return closed.withColumn("slot", F.lit(slot)).withColumn("eof", F.lit(True))


def clamp_window(start_seconds: Column, end_seconds: Column) -> Column:
    """A window from epoch seconds, clamped to the representable years."""
    from msgflow.functions.scalars import clamp_epoch_seconds

    return F.struct(clamp_epoch_seconds(start_seconds).alias("start"), clamp_epoch_seconds(end_seconds).alias("end"))
