"""Map-like handlers: user Python over Arrow batches, without a shuffle.

Only the columns a handler reads are sent to Python (``columns``). An exception fails the query;
with ``on_error="capture"`` it becomes an error row instead (see :func:`split_errors`).
"""

from __future__ import annotations

import asyncio
import inspect
import itertools
import time
import traceback
from collections.abc import AsyncIterator, Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow import constants as C
from msgflow.message import BatchResponse, Datum, Message, row_function
from msgflow.operators import envelope as E
from msgflow.operators import scan

COLUMNS = ("id", "keys", "value", "event_time", "watermark", "headers")

ERROR = T.StructType(
    [
        T.StructField("container", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("code", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("details", T.StringType()),
    ]
)
_PLAIN = ("keys", "value", "tags")


def _out_type(fields: Sequence[str], capture: bool) -> T.StructType:
    out = [E.ENVELOPE["id"], T.StructField("pos", T.IntegerType())]
    out += [E.ENVELOPE[f] for f in fields if f != "id"]
    if capture:
        out.append(T.StructField("error", ERROR))
    return T.StructType(out)


def _rows(request_id: str | None, items: Iterable[Message] | None, fields: Sequence[str]) -> Iterator[dict]:
    for pos, m in enumerate(items or ()):
        row = {f: getattr(m, f) for f in fields}
        if "event_time" in fields and m.event_time is None:
            row["event_time"] = C.MISSING_TIME
        row["id"], row["pos"] = request_id, pos
        yield row


def error_value(exc: BaseException, container: str) -> dict:
    return {
        "container": container,
        "timestamp": int(time.time()),
        "code": C.INTERNAL_ERROR_CODE,
        "message": f"{type(exc).__name__}: {exc}",
        "details": "".join(traceback.format_exception(exc)),
    }


def _error_row(request_id: str | None, exc: BaseException, container: str) -> dict:
    return {"id": request_id, "pos": None, "error": error_value(exc, container)}


def datums(batches: Iterator[pa.RecordBatch]) -> Iterator[Datum]:
    for batch in batches:
        for row in batch.to_pylist():
            yield Datum(row)


def _selected(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def _run(
    df: DataFrame,
    columns: Sequence[str],
    fields: Sequence[str],
    produce: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]],
    *,
    capture: bool,
    rows_per_batch: int = 4096,
) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    out_type = _out_type(fields, capture)
    arrow = to_arrow_schema(out_type)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from scan.to_batches(produce(batches), arrow, rows_per_batch)

    return _selected(df, columns).mapInArrow(task, out_type)


def _map(df: DataFrame, handler: Any, fields, columns, on_error, container, max_in_flight) -> DataFrame:
    call = row_function(handler)
    capture = is_capture(on_error)
    if inspect.iscoroutinefunction(call):

        def produce(batches):
            yield from _gather(datums(batches), call, fields, capture, container, max_in_flight)

    else:

        def produce(batches):
            for d in datums(batches):
                try:
                    # The whole result of a row, so that a failing row leaves no partial output.
                    out = list(_rows(d.id, call(d.keys, d), fields))
                except Exception as exc:
                    if not capture:
                        raise
                    out = [_error_row(d.id, exc, container)]
                yield from out

    return _run(df, columns, fields, produce, capture=capture)


def is_capture(on_error: str) -> bool:
    if on_error not in ("fail", "capture"):
        raise ValueError(f"on_error is 'fail' or 'capture', not {on_error!r}")
    return on_error == "capture"


def _gather(rows: Iterator[Datum], call, fields, capture, container, max_in_flight) -> Iterator[dict]:
    """Run the coroutine on up to ``max_in_flight`` rows at once, on one event loop per task."""

    async def one(d: Datum) -> list[dict]:
        try:
            return list(_rows(d.id, await call(d.keys, d), fields))
        except Exception as exc:
            if not capture:
                raise
            return [_error_row(d.id, exc, container)]

    async def many(chunk: list[Datum]) -> list[list[dict]]:
        return await asyncio.gather(*[one(d) for d in chunk])

    with scan.Loop() as loop:
        while chunk := list(itertools.islice(rows, max_in_flight)):
            yield from itertools.chain.from_iterable(loop.run(many(chunk)))


def map_handler(
    df: DataFrame,
    handler: Any,
    *,
    columns: Sequence[str] = COLUMNS,
    on_error: str = "fail",
    container: str = "map",
    max_in_flight: int = 256,
) -> DataFrame:
    """``handler(keys, datum) -> messages``, plain or async. User metadata of the messages goes on."""
    return _map(df, handler, (*_PLAIN, "user_metadata"), columns, on_error, container, max_in_flight)


def source_transform_handler(
    df: DataFrame,
    handler: Any,
    *,
    columns: Sequence[str] = COLUMNS,
    on_error: str = "fail",
    container: str = "source-transform",
    max_in_flight: int = 256,
) -> DataFrame:
    """``handler(keys, datum) -> messages`` with their own event time; a missing one is year 1.

    Filter dropped rows only after the watermark is set.
    """
    fields = (*_PLAIN, "event_time", "user_metadata")
    return _map(df, handler, fields, columns, on_error, container, max_in_flight)


def map_stream_handler(
    df: DataFrame,
    handler: Any,
    *,
    columns: Sequence[str] = COLUMNS,
    rows_per_batch: int = 64,
) -> DataFrame:
    """``handler(keys, datum)`` as a generator, plain or async; outputs go on in small batches."""
    call = row_function(handler)

    def produce(batches):
        with scan.Loop() as loop:
            for d in datums(batches):
                yield from _rows(d.id, iterate(call(d.keys, d), loop), _PLAIN)

    return _run(df, columns, _PLAIN, produce, capture=False, rows_per_batch=rows_per_batch)


async def _next(items: AsyncIterator[Any]) -> Any:
    return await anext(items)


def iterate(result: Any, loop: scan.Loop) -> Iterator[Any]:
    """What a handler call returned, as a plain iterator: list, generator, coroutine or async generator."""
    if inspect.iscoroutine(result):
        result = loop.run(result)
    if isinstance(result, AsyncIterator):
        while True:
            try:
                yield loop.run(_next(result))
            except StopAsyncIteration:
                return
    elif result is not None:
        yield from result


def register_map_stream(spark: SparkSession, name: str, handler: Callable[[bytes], Iterable[bytes]]) -> None:
    """A SQL table function: ``SELECT ... FROM t, LATERAL name(t.value)`` gives (pos, value) rows."""

    class Stream:
        def eval(self, value: bytes):
            for pos, out in enumerate(handler(value)):
                yield pos, out

    spark.udtf.register(name, F.udtf(Stream, returnType="pos int, value binary"))


def batch_map_handler(
    df: DataFrame,
    handler: Callable[[list[Datum]], Iterable[BatchResponse]],
    *,
    columns: Sequence[str] = COLUMNS,
    strict: bool = True,
) -> DataFrame:
    """``handler(datums) -> responses``, one call per Arrow batch, responses paired by id.

    Batches hold ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows. ``strict`` fails unless each
    id of the batch got exactly one response.
    """
    call = row_function(handler)

    def produce(batches):
        for batch in batches:
            rows = [Datum(r) for r in batch.to_pylist()]
            responses = list(call(rows))
            if strict and sorted(r.id for r in responses) != sorted(d.id for d in rows):
                raise ValueError(f"batch of {len(rows)} rows got {len(responses)} responses, or other ids")
            for r in responses:
                yield from _rows(r.id, r.messages, _PLAIN)

    return _run(df, columns, _PLAIN, produce, capture=False)


def map_concurrent(
    df: DataFrame,
    call: Callable[[Any, Datum], Iterable[Message]],
    client: Callable[[], Any],
    *,
    columns: Sequence[str] = COLUMNS,
    max_in_flight: int = 64,
) -> DataFrame:
    """Blocking calls to an outside service, ``max_in_flight`` at once in each task.

    ``client()`` is made once per task and given to each ``call(client, datum)``; order is kept.
    """

    def produce(batches):
        made = client()
        rows = datums(batches)
        with ThreadPoolExecutor(max_in_flight) as pool:
            while chunk := list(itertools.islice(rows, max_in_flight * 4)):
                for d, out in zip(chunk, pool.map(lambda d: list(call(made, d)), chunk)):
                    yield from _rows(d.id, out, _PLAIN)

    return _run(df, columns, _PLAIN, produce, capture=False)


def spread(df: DataFrame, n: int) -> DataFrame:
    """More parallel tasks for a CPU-heavy map: ``n`` even partitions."""
    return df.repartition(n)


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(output rows, error rows) of a handler run with ``on_error="capture"``.

    Each result runs the handler when it is used; write the unsplit output to a table first where
    that is too dear.
    """
    good = df.filter(F.col("error").isNull()).drop("error")
    return good, df.filter(F.col("error").isNotNull()).select("error.*", "id")
