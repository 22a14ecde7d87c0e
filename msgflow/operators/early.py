"""Early results: reducers that emit several times before their window closes.

Counters depend only on the row count of a group, so they are partial aggregates whose emissions
are generated afterwards. The running sum with reset is a sequential fold; its hot groups are cut
into segments, and what a segment does to an incoming sum is composed before the final pass.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow.operators import ordered as O
from msgflow.operators import scan

CHUNK = 1_000_000  # emissions generated by one row; larger groups are spread over several rows


def _emissions(df: DataFrame, group: Sequence[str], step: int) -> DataFrame:
    """Count each group and number its emissions: one per full ``step`` rows, and the final one.

    Columns: group, ``_n`` (rows), ``emit`` from 1, ``final``.
    """
    counted = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    emits = F.floor(F.col("_n") / F.lit(step)).cast("bigint") + 1
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((emits - 1) / F.lit(CHUNK)).cast("bigint"))
    # A row generates at most CHUNK emissions, and the rows of a large group are spread.
    spread = counted.withColumn("_chunk", F.explode(chunks)).repartition(*group, "_chunk")
    last = F.least(emits, (F.col("_chunk") + 1) * CHUNK)
    numbered = spread.withColumn("emit", F.explode(F.sequence(F.col("_chunk") * CHUNK + 1, last)))
    return numbered.select(*group, "_n", "emit", (F.col("emit") == emits).alias("final"))


def early_counter(df: DataFrame, group: Sequence[str], threshold: int = 10) -> DataFrame:
    """Emit the count and restart it whenever it exceeds ``threshold``; then emit the rest, even 0."""
    step = threshold + 1
    counter = F.when(F.col("final"), F.col("_n") % step).otherwise(F.lit(step)).cast("bigint")
    return _emissions(df, group, step).select(*group, "emit", counter.alias("counter"), "final")


def early_every(df: DataFrame, group: Sequence[str], every: int = 10) -> DataFrame:
    """Emit the running count at each multiple of ``every``, and the total as the final result."""
    counter = F.when(F.col("final"), F.col("_n")).otherwise(F.col("emit") * every)
    return _emissions(df, group, every).select(*group, "emit", counter.alias("counter"), "final")


def early_running(df: DataFrame, group: Sequence[str], order: Sequence[str], **opts) -> DataFrame:
    """Emit the running count on every row."""
    return O.running_count(df, group, order, **opts)


# Running sum with reset --------------------------------------------------------


def fold_sum(acc: int, values: Iterator[int], threshold: int) -> Iterator[tuple[bool, int]]:
    """Yield (True, sum) for each emission, and at the end (False, remainder)."""
    for v in values:
        acc += v
        if acc >= threshold:
            yield True, acc
            acc = 0
    yield False, acc


class SumStep:
    """What a stretch of values does to any incoming sum ``a`` with ``floor <= a < threshold``.

    ``lows`` falls and ``outs`` is parallel: a sum at or above ``lows[i]`` (first such i) leaves as
    ``outs[i]``; a sum below all of them meets no reset and leaves as ``a + total``.
    """

    def __init__(self, threshold: int, floor: int) -> None:
        self.threshold, self.floor = threshold, floor
        self.total, self.peak = 0, 0
        self.lows: list[int] = []
        self.track: list[int] = []  # per low: index into accs
        self.accs = np.zeros(0, dtype=np.int64)

    def feed(self, values: np.ndarray) -> None:
        for i, v in enumerate(values.tolist()):
            accs = self.accs
            if accs.size:
                accs += v
                accs[accs >= self.threshold] = 0
            self.total += v
            if self.total > self.peak:
                if self.threshold - self.peak > self.floor:
                    self.lows.append(max(self.threshold - self.total, self.floor))
                    self.track.append(accs.size)
                    self.accs = np.append(accs, 0)
                self.peak = self.total
            if i % 512 == 0:
                self._merge()
        self._merge()

    def _merge(self) -> None:
        """Sums that have met stay equal from then on."""
        if self.accs.size < 2:
            return
        self.accs, index = np.unique(self.accs, return_inverse=True)
        lows: list[int] = []
        track: list[int] = []
        for low, t in zip(self.lows, index[self.track].tolist()):
            if track and track[-1] == t:
                lows[-1] = low
            else:
                lows.append(low)
                track.append(t)
        self.lows, self.track = lows, track

    def outs(self) -> list[int]:
        return [int(self.accs[t]) for t in self.track]


def apply_step(acc: int, lows: Sequence[int], outs: Sequence[int], total: int) -> int:
    i = bisect.bisect_left([-x for x in lows], -acc)
    return outs[i] if i < len(outs) else acc + total


def early_sum(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    number: str,
    threshold: int = 100,
    *,
    hot_rows: int = O.HOT_ROWS,
) -> DataFrame:
    """Add up ``number`` in order; emit and restart at ``threshold``; then emit the rest, even 0.

    Rows are (group columns, ``segment``, ``emit``, ``total``, ``final``). ``emit`` counts a group's
    emissions from 1, the final one included, whether or not the group is split; ``segment`` names
    the part of a split group. NULLs add nothing; a group of NULLs alone emits a final 0.
    ``number`` must be of an integer type, ``threshold`` positive.
    """
    group, order = list(group), list(order)
    if not isinstance(df.select(number).schema[0].dataType, T.IntegralType):
        raise TypeError(f"{number} is not of an integer type")
    if threshold <= 0:
        raise ValueError("the threshold must be positive")
    fields = [df.select(*group).schema[g] for g in group]
    out_type = T.StructType(
        [
            *fields,
            T.StructField("segment", T.StringType()),
            T.StructField("emit", T.LongType()),
            T.StructField("total", T.LongType()),
            T.StructField("final", T.BooleanType()),
        ]
    )
    rows = df.select(*group, *order, F.col(number).cast("bigint").alias("_v"))
    split = O.segmented(rows, group, order, hot_rows=hot_rows)
    no_seg = F.array(F.lit(0))
    if split is None:
        ready = rows.withColumns({"_seg": no_seg, "_hot": F.lit(False), "_kind": F.lit(1)})
        return scan.ordered_scan(ready, [*group, "_seg"], ["_kind", *order], _sum_run(group, threshold), out_type)

    # A NULL adds nothing, like 0; its group and segment are still there.
    hot = split.filter("_hot").withColumn("_v", F.coalesce("_v", F.lit(0)))
    floors = hot.groupBy(*group).agg(F.sum(F.least("_v", F.lit(0))).alias("_floor"))
    # One row per hot group.
    floored = O._lookup(hot, O._frozen(floors), group, how="inner")
    step_type = T.StructType(
        [
            *fields,
            split.schema["_seg"],
            T.StructField("lows", T.ArrayType(T.LongType())),
            T.StructField("outs", T.ArrayType(T.LongType())),
            T.StructField("total", T.LongType()),
        ]
    )
    steps = scan.ordered_scan(floored, [*group, "_seg"], order, _step_run(group, threshold), step_type)
    # The steps of a hot group: one per segment, each a short table.
    carry_type = T.StructType(
        [*fields, split.schema["_seg"], T.StructField("_v", T.LongType()), T.StructField("_last", T.BooleanType())]
    )
    carry = scan.ordered_scan(steps, group, ["_seg"], _carry_run(group), carry_type)
    entering = carry.filter(~F.col("_last")).drop("_last").withColumns({"_hot": F.lit(True), "_kind": F.lit(0)})
    ready = split.withColumn("_kind", F.lit(1)).unionByName(entering, allowMissingColumns=True)
    emitted = scan.ordered_scan(ready, [*group, "_seg"], ["_kind", *order], _sum_run(group, threshold), out_type)
    # A segment's emissions come after those of the segments before it: one short row per segment.
    counts = emitted.filter(~F.col("final")).groupBy(*group, "segment").agg(F.max("emit").alias("_n"))
    order_segments = Window.partitionBy(*group).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(order_segments), F.lit(0)))
    numbered = _beside(emitted, offsets, [*group, "segment"]).withColumn(
        "emit", F.col("emit") + F.coalesce("_before", F.lit(0))
    )
    finals = carry.filter("_last").select(*group, _segment_text("_seg").alias("segment"), F.col("_v").alias("total"))
    finals = _beside(finals, counts.groupBy(*group).agg(F.sum("_n").alias("_n")), group).withColumns(
        {"emit": F.coalesce("_n", F.lit(0)) + 1, "final": F.lit(True)}
    )
    names = out_type.fieldNames()
    return numbered.select(*names).unionByName(finals.select(*names))


def _beside(df: DataFrame, more: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on keys that may be NULL."""
    right = more.withColumnsRenamed({k: f"_right_{i}" for i, k in enumerate(keys)})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{i}")) for i, k in enumerate(keys)]
    return df.join(right, same, "left")


def _segment_text(seg: str) -> Column:
    return F.array_join(F.transform(seg, lambda part: F.format_string("%05d", part)), ".")


def _head(batch: pa.RecordBatch, names: Sequence[str]) -> dict:
    return {n: batch.column(batch.schema.get_field_index(n))[0].as_py() for n in names}


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _sum_run(group: Sequence[str], threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        acc, emit, head, hot, segment = 0, 0, None, False, ""
        for batch in batches:
            if head is None:
                head = _head(batch, group)
                hot = _column(batch, "_hot")[0].as_py()
                seg = _column(batch, "_seg")[0].as_py()
                segment = ".".join("%05d" % part for part in seg)
            values = _column(batch, "_v").to_pylist()
            if _column(batch, "_kind")[0].as_py() == 0:
                acc = values[0]
                values = values[1:]
            for is_emit, total in fold_sum(acc, (v for v in values if v is not None), threshold):
                if is_emit:
                    emit += 1
                    yield {**head, "segment": segment, "emit": emit, "total": total, "final": False}
                else:
                    acc = total
        if not hot:
            yield {**head, "segment": segment, "emit": emit + 1, "total": acc, "final": True}

    return run


def _step_run(group: Sequence[str], threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        step, head = None, None
        for batch in batches:
            if step is None:
                head = _head(batch, [*group, "_seg"])
                step = SumStep(threshold, _column(batch, "_floor")[0].as_py())
            step.feed(_column(batch, "_v").to_numpy(zero_copy_only=False))
        yield {**head, "lows": step.lows, "outs": step.outs(), "total": step.total}

    return run


def _carry_run(group: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        acc, last = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                last = {**{g: row[g] for g in group}, "_seg": row["_seg"]}
                yield {**last, "_v": acc, "_last": False}
                acc = apply_step(acc, row["lows"], row["outs"], row["total"])
        yield {**last, "_v": acc, "_last": True}

    return run
