"""Redelivery from a queue in state: a refused row is tried again after a pause, and nothing of its key overtakes it.

Each key has a queue. Its head is given to the handler; if refused, a processing-time timer tries it again after ``pause``,
doubled each time, and the rows behind it wait. After ``tries`` refusals the row is dead and the queue goes on. A row is
one state entry, so a long queue is never loaded whole.
"""

from __future__ import annotations

import pickle
import time
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from msgflow.message import Datum, row_function
from msgflow.operators import scan
from msgflow.operators.group_handlers import _Async, _is_async
from msgflow.operators.handlers import iterate
from msgflow.session import shared_dir
from msgflow.streaming.run import state_settings
from msgflow.streaming.stateful import _grouped

TAKEN, DEAD = "taken", "dead"
_PACKED = T.StructType([T.StructField("packed", T.BinaryType())])
_PLACE = T.StructType([T.StructField(n, T.LongType()) for n in ("head", "next", "tried")])


class _Queue(StatefulProcessor):
    def __init__(self, call: Any, columns: list[str], order: list[str], tries: int, pause_ms: int) -> None:
        self.call, self.columns, self.order, self.tries, self.pause_ms = call, columns, order, tries, pause_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", T.StructType([T.StructField("seq", T.LongType())]), _PACKED)
        self.place = handle.getValueState("place", _PLACE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        items = ({c: r[c] for c in self.columns} for r in rows)
        if self.order:
            items = sorted(items, key=lambda d: tuple(d[c] for c in self.order))
        head, end, tried = self.place.get() if self.place.exists() else (0, 0, 0)
        waiting = head < end
        for item in items:
            self.rows.updateValue((end,), (pickle.dumps(item),))
            end += 1
        if waiting:
            self.place.update((head, end, tried))
        else:
            yield from self._deliver(head, end, tried, timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.place.exists():
            yield from self._deliver(*self.place.get(), timerValues.getCurrentProcessingTimeInMs())

    def _deliver(self, head: int, end: int, tried: int, now: int) -> Iterator[Row]:
        with scan.Loop() as loop:
            while head < end:
                item = pickle.loads(bytes(self.rows.getValue((head,))[0]))
                refusal = self._refusal({**item, "attempt": tried}, loop)
                tried += 1
                if refusal is not None and tried < self.tries:
                    self.place.update((head, end, tried))
                    self.handle.registerTimer(now + self.pause_ms * 2 ** (tried - 1))
                    return
                outcome = TAKEN if refusal is None else DEAD
                yield Row(**item, attempts=tried, outcome=outcome, err_msg=refusal)
                self.rows.removeKey((head,))
                head, tried = head + 1, 0
        self.place.clear()

    def _refusal(self, item: dict, loop: scan.Loop) -> str | None:
        """Why the handler refused a row; None if it took it."""
        items = iter([Datum(item)])
        answers = list(iterate(self.call(_Async(items) if _is_async(self.call) else items), loop))
        if [a.id for a in answers] != [item["id"]]:
            raise ValueError(f"row {item['id']} got responses for {[a.id for a in answers]}")
        return (answers[0].err_msg or "") if answers[0].status == "FAILURE" else None


def redeliver(
    df: DataFrame, handler: Any, *, tries: int = 3, pause_ms: int = 1000, order: tuple[str, ...] = ("event_time", "id")
) -> DataFrame:
    """``handler(datums) -> responses`` for one row at a time, with ``attempt`` (0 first); a FAILURE is a refusal.

    Columns: those of ``df`` (id and keys among them), attempts, outcome (taken or dead), err_msg. Run it with a
    processing-time trigger, as timers need micro-batches: :func:`run_until_empty` does.
    """
    if tries < 1 or pause_ms < 1:
        raise ValueError("tries and pause_ms must be positive")
    out_type = T.StructType(
        [
            *df.schema.fields,
            T.StructField("attempts", T.LongType()),
            T.StructField("outcome", T.StringType()),
            T.StructField("err_msg", T.StringType()),
        ]
    )
    processor = _Queue(row_function(handler), df.columns, [c for c in order if c in df.columns], tries, pause_ms)
    return _grouped(df, ["keys"]).transformWithState(processor, out_type, outputMode="Append", timeMode="ProcessingTime")


def run_until_empty(df: DataFrame, *, poll: float = 0.5, partitions: int | None = None, at_most: float = 3600) -> DataFrame:
    """Run a redelivering stream until its source has no more rows and its queues are empty; the output as a table.

    Raises TimeoutError after ``at_most`` seconds; the queues then stay in the checkpoint for another run.
    """
    spark = df.sparkSession
    folder = shared_dir(spark, "redelivery")
    with state_settings(spark, partitions):
        writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/checkpoint")
        started = writer.option("path", f"{folder}/data").trigger(processingTime="100 milliseconds").start()
    try:
        end = time.monotonic() + at_most
        while started.isActive:
            last = started.lastProgress
            if last and last["batchId"] > 0 and not last["numInputRows"] and not any(o["numRowsTotal"] for o in last["stateOperators"]):
                break
            if time.monotonic() > end:
                raise TimeoutError(f"rows still wait after {at_most} seconds")
            started.awaitTermination(poll)
    finally:
        started.stop()
    if started.exception():
        raise started.exception()
    return spark.read.schema(df.schema).parquet(f"{folder}/data")
