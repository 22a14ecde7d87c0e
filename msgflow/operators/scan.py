"""Ordered scans: Python that walks each group's rows in order, batch by batch.

Spark shuffles by group and sorts (spilling to disk when needed); the task then streams Arrow
batches, so a group is never held in memory. A group is still read by one task: use this for rows
already cut into segments (see :mod:`msgflow.operators.ordered`), or for opaque handlers whose
contract is one call per group.
"""

from __future__ import annotations

import asyncio
import gc
import itertools
from collections.abc import Awaitable, Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GROUP_ID = "_gid"
MAX_BYTES = 32 * 1024 * 1024


class Loop:
    """An event loop made on first use and closed with the task."""

    def __init__(self) -> None:
        self._loop: asyncio.AbstractEventLoop | None = None

    def __enter__(self) -> Loop:
        return self

    def __exit__(self, *_) -> None:
        if self._loop is not None:
            self._loop.run_until_complete(self._loop.shutdown_asyncgens())
            self._loop.close()

    def run(self, awaitable: Awaitable[Any]) -> Any:
        if self._loop is None:
            self._loop = asyncio.new_event_loop()
        return self._loop.run_until_complete(awaitable)


def group_id(group: Sequence[str]) -> Column:
    """A text that is equal exactly for equal group values."""
    if not group:
        return F.lit("")
    return F.to_json(F.struct(*group), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        ids = batch.column(batch.schema.get_field_index(GROUP_ID))
        changes = pc.not_equal(ids.slice(1), ids.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        bounds = [0, *(np.flatnonzero(changes) + 1).tolist(), n]
        for low, high in itertools.pairwise(bounds):
            yield ids[low].as_py(), batch.slice(low, high - low)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[pa.RecordBatch]]:
    """Consecutive rows of equal group id, each run as an iterator of batch slices."""
    for _, pieces in itertools.groupby(_pieces(batches), key=lambda p: p[0]):
        yield (piece for _, piece in pieces)


def row_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[dict]]:
    """Consecutive rows of equal group id, each run as an iterator of row dicts."""
    rows = itertools.chain.from_iterable(batch.to_pylist() for batch in batches)
    for _, run in itertools.groupby(rows, key=lambda r: r[GROUP_ID]):
        yield run


@contextmanager
def rare_collections() -> Iterator[None]:
    """Let Python look for cycles less often: beside thousands of open handlers each look costs more than their work."""
    old = gc.get_threshold()
    gc.set_threshold(200_000, 20, 20)
    try:
        yield
    finally:
        gc.set_threshold(*old)


class _Columns(dict):
    """The columns of a batch as lists, each made when it is first read."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        super().__init__()
        self.batch, self.names = batch, batch.schema.names

    def __missing__(self, name: str) -> list:
        values = self[name] = self.batch.column(name).to_pylist()
        return values


class BatchRow:
    """A row of a batch for a :class:`msgflow.message.Datum`: columns that nobody reads are never decoded."""

    __slots__ = ("_columns", "_at")

    def __init__(self, columns: _Columns, at: int) -> None:
        self._columns, self._at = columns, at

    def __getitem__(self, name: str) -> Any:
        if name not in self._columns.names:
            raise KeyError(name)
        return self._columns[name][self._at]

    def get(self, name: str, default: Any = None) -> Any:
        return self._columns[name][self._at] if name in self._columns.names else default

    def __reduce__(self):
        return dict, ([(name, self[name]) for name in self._columns.names],)


def batch_rows(batch: pa.RecordBatch) -> Iterator[BatchRow]:
    columns = _Columns(batch)
    return (BatchRow(columns, at) for at in range(batch.num_rows))


def to_batches(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches, sent on at ``size`` rows or MAX_BYTES of payload."""
    chunk: list[dict] = []
    held = 0
    for row in rows:
        chunk.append(row)
        held += len(row.get("value") or b"")
        if len(chunk) >= size or held >= MAX_BYTES:
            yield pa.RecordBatch.from_pylist(chunk, schema=schema)
            chunk, held = [], 0
    if chunk:
        yield pa.RecordBatch.from_pylist(chunk, schema=schema)


def _scan(df, group, order, task, out_type, together) -> DataFrame:
    rows = df.withColumn(GROUP_ID, group_id(group))
    if not together:
        rows = rows.repartition(*group)
    return rows.sortWithinPartitions(*group, *order).mapInArrow(task, out_type)


def ordered_scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    per_run: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]],
    out_type: T.StructType,
) -> DataFrame:
    """Apply ``per_run`` to the ordered batches of each group; it yields output rows as dicts."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out_type)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = itertools.chain.from_iterable(per_run(run) for run in runs(batches))
        yield from to_batches(rows, arrow)

    return _scan(df, group, order, task, out_type, False)


def ordered_rows_scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    per_run: Callable[[Iterator[dict], Loop], Iterator[dict]],
    out_type: T.StructType,
    *,
    together: bool = False,
) -> DataFrame:
    """The same for handlers of single rows: ``per_run(rows, loop)``, with one event loop per task.

    ``together``: a window over some of the group columns has just put each group into one task.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out_type)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Loop() as loop:
            rows = itertools.chain.from_iterable(per_run(run, loop) for run in row_runs(batches))
            yield from to_batches(rows, arrow)

    return _scan(df, group, order, task, out_type, together)
