"""Windowed reduce with native aggregates: partial aggregation before the only shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow import constants as C
from msgflow.functions import scalars as S
from msgflow.operators import windows as W


def reduce_window(
    df: DataFrame,
    length: str,
    *aggs: Column,
    by: Sequence[str] = ("keys",),
    time: str = "event_time",
    slot: str = C.DEFAULT_SLOT,
) -> DataFrame:
    """Aggregate per fixed window and key. ``by=()`` is the unkeyed form: per window only.

    Works on batch and streaming input. A hot key costs one partial row per input partition.
    """
    grouped = df.groupBy(W.fixed_window(length, time=time).alias("window"), *by).agg(*aggs)
    return grouped.withColumn("slot", F.lit(slot))


def reduce_counter(df: DataFrame, length: str, *, by: Sequence[str] = ("keys",)) -> DataFrame:
    """Row count per window and key, with the payload text that states it."""
    counted = reduce_window(df, length, F.count(F.lit(1)).alias("counter"), by=by)
    text = S.window_text(C.COUNTER_FORMAT, F.col("counter"), F.col("window"))
    return counted.withColumn("value", S.text_to_bytes(text))
