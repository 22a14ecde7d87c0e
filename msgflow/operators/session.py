"""Session windows: rows of a key whose gaps do not exceed a timeout, built from mergeable parts.

The batch form never brings all rows of a key together. Rows of one key in the same gap-long bucket
always share a session, so they are pre-aggregated before the shuffle. Buckets are then merged
inside blocks of BLOCK buckets, and only the first and last session of each block take part in the
merge across blocks. No task sees more than BLOCK rows of a key per block, or two rows per block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgflow.functions.scalars import interval_micros

BLOCK = 4096  # gap-long buckets per block


@dataclass(frozen=True)
class Mergeable:
    """An aggregate whose parts merge: count, sum, min or max. A count merges by adding."""

    kind: str
    value: Column | None = None

    def part(self) -> Column:
        if self.kind == "count":
            return F.count(F.lit(1) if self.value is None else self.value)
        if self.value is None:
            raise ValueError(f"{self.kind} needs a value")
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.kind](self.value)

    def merge(self, col: str) -> Column:
        return {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}[self.kind](col)


def number_sessions(parts: DataFrame, group: Sequence[str], gap: Column) -> DataFrame:
    """Number the sessions of each group from 1, in ``_no``; parts at most ``gap`` apart share one.

    Parts have ``_lo`` and ``_hi`` in microseconds and may overlap.
    """
    w = Window.partitionBy(*group).orderBy("_lo")
    reached = F.max("_hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("_lo") - reached > gap, F.lit(True))
    marked = parts.withColumn("_new", starts.cast("bigint"))
    no = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("_no", no).drop("_new")


def merge_sessions(
    parts: DataFrame, group: Sequence[str], gap: Column, merges: Mapping[str, Column], *, block: int = BLOCK
) -> DataFrame:
    """Merge partial sessions: rows (group, ``_lo``, ``_hi`` in microseconds, states).

    Each part lies in one gap-long bucket. ``merges`` maps state columns to merging aggregates.
    """
    group = list(group)
    states = [F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), *[m.alias(n) for n, m in merges.items()]]
    in_block = [*group, "_block"]
    numbered = number_sessions(parts.withColumn("_block", F.floor(F.col("_lo") / (gap * block))), in_block, gap)
    local = numbered.groupBy(*in_block, "_no").agg(*states)
    edge = (F.col("_no") == 1) | (F.col("_no") == F.max("_no").over(Window.partitionBy(*in_block)))
    # Edge sessions of a group meet in one place; inner ones are complete and stay in their block.
    local = local.withColumn("_place", F.when(~edge, F.col("_block"))).drop("_no", "_block")
    in_place = [*group, "_place"]
    final = number_sessions(local, in_place, gap).groupBy(*in_place, "_no").agg(*states)
    return final.drop("_no", "_place")


def session_reduce(
    df: DataFrame,
    gap: str,
    aggs: Mapping[str, Mergeable],
    *,
    by: Sequence[str] = ("keys",),
    time: str = "event_time",
    block: int = BLOCK,
) -> DataFrame:
    """One row per key and session, batch form. ``window`` ends one gap after the last row.

    Rows exactly ``gap`` apart share a session.
    """
    by = list(by)
    width = interval_micros(gap)
    at = F.unix_micros(time)
    parts = df.groupBy(*by, F.floor(at / width).alias("_bucket")).agg(
        F.min(at).alias("_lo"), F.max(at).alias("_hi"), *[a.part().alias(n) for n, a in aggs.items()]
    )
    merged = merge_sessions(parts.drop("_bucket"), by, width, {n: a.merge(n) for n, a in aggs.items()}, block=block)
    return merged.select(
        F.struct(
            F.timestamp_micros("_lo").alias("start"), F.timestamp_micros(F.col("_hi") + width).alias("end")
        ).alias("window"),
        *by,
        *aggs,
    )


def session_reduce_stream(df: DataFrame, gap: str, *aggs: Column, by: Sequence[str] = ("keys",), time: str = "event_time") -> DataFrame:
    """The streaming form: Spark's session windows, whose state merges when a late row bridges two."""
    return df.groupBy(F.session_window(time, gap).alias("window"), *by).agg(*aggs)
