"""Handlers over groups: windows, sessions and keys.

Two kinds:

* Opaque handlers get every row of their group in one call, as the contract demands. Rows are
  streamed to them in order, never held whole, but one group is one task's work.
* Mergeable handlers (``add``, ``state``, ``merge``, ``result``) are combined inside each input
  partition first, so only their states are shuffled. Use these where a group may be hot.
"""

from __future__ import annotations

import inspect
import itertools
import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow.constants import EPOCH_TIME, at_micros
from msgflow.functions.scalars import interval_micros
from msgflow.message import Datum, Interval, Message, make_factory
from msgflow.operators import envelope as E
from msgflow.operators import ordered as O
from msgflow.operators import scan
from msgflow.operators import windows as W
from msgflow.operators.handlers import ERROR, error_value, is_capture, iterate
from msgflow.operators.session import BLOCK, number_sessions

ORDER = ("event_time", "id")
COLUMNS = ("id", "keys", "value", "event_time", "watermark", "headers")
_WINDOW = T.StructField(
    "window", T.StructType([T.StructField("start", T.TimestampType()), T.StructField("end", T.TimestampType())])
)
_SPAN = [T.StructField("_lo", T.LongType()), T.StructField("_hi", T.LongType()), T.StructField("_state", T.BinaryType())]
MAX_OPEN = 20_000  # combined states a task keeps before it passes them on
MAX_WAITING = 200_000  # states that wait to be packed with others for the same place
AT_ONCE = 256  # handlers that are asked for their states together


class MergeableHandler(Protocol):
    """A handler whose partial states merge in any order."""

    def add(self, datum: Datum) -> None: ...

    def state(self) -> bytes: ...

    def merge(self, state: bytes) -> None: ...

    def result(self, keys: list[str], window: Interval) -> Iterable[Message]: ...


class _Async:
    """A plain iterator given to an async handler."""

    def __init__(self, items: Iterator[Datum]) -> None:
        self.items = items

    def __aiter__(self):
        return self

    async def __anext__(self) -> Datum:
        try:
            return next(self.items)
        except StopIteration:
            raise StopAsyncIteration from None


def _is_async(call: Callable) -> bool:
    return inspect.iscoroutinefunction(call) or inspect.isasyncgenfunction(call)


def _first(rows: Iterator[dict]) -> tuple[dict, Iterator[dict]]:
    head = next(rows)
    return head, itertools.chain([head], rows)


class _Guard:
    """Runs a group's handler: with capture, a failure becomes a row after what the handler said before it.

    Failures of the rows themselves, which come from Spark, are raised in any case.
    """

    def __init__(self, on_error: str, container: str) -> None:
        self.capture, self.container = is_capture(on_error), container

    def fields(self) -> list[T.StructField]:
        return [T.StructField("error", ERROR)] if self.capture else []

    def run(self, head: dict, rows: Iterator[dict], produce: Callable[[Iterator[Datum]], Iterator[dict]]) -> Iterator[dict]:
        broken: list[BaseException] = []

        def items() -> Iterator[Datum]:
            try:
                for row in rows:
                    yield Datum(row)
            except Exception as exc:
                broken.append(exc)
                raise

        try:
            yield from produce(items())
        except Exception as exc:
            if broken or not self.capture:
                raise
            yield {**head, "error": error_value(exc, self.container)}


def reduce_handler(
    df: DataFrame,
    length: str,
    handler: Any,
    *,
    init_args: tuple = (),
    init_kwargs: dict | None = None,
    keyed: bool = True,
    columns: Sequence[str] = COLUMNS,
    order: Sequence[str] = ORDER,
    on_error: str = "fail",
    container: str = "reduce",
) -> DataFrame:
    """``handler(keys, datums, window) -> messages`` on the ordered rows of each window and key.

    The handler may be a function, generator, coroutine or async generator (an early emission is
    simply yielded), or a class built anew per group. Output rows carry the window and no metadata. With
    ``on_error="capture"`` a failing group keeps what it emitted and adds a row with ``error`` and its keys; other groups
    go on.
    """
    guard = _Guard(on_error, container)
    factory = make_factory(handler, init_args, init_kwargs)
    needed = [c for c in dict.fromkeys([*columns, "keys", "event_time", *order]) if c in df.columns]
    rows = df.select(W.fixed_window(length).alias("window"), *needed)
    group = ["window", "keys"] if keyed else ["window"]
    out_type = T.StructType(
        [_WINDOW, T.StructField("pos", T.IntegerType()), *[E.ENVELOPE[n] for n in ("keys", "value", "tags")], *guard.fields()]
    )

    def run(rows: Iterator[dict], loop: scan.Loop) -> Iterator[dict]:
        head, rows = _first(rows)
        window = Interval(head["window"]["start"], head["window"]["end"])
        keys = head["keys"] if keyed else []

        def produce(items: Iterator[Datum]) -> Iterator[dict]:
            call = factory()
            result = call(keys, _Async(items) if _is_async(call) else items, window)
            for pos, m in enumerate(iterate(result, loop)):
                yield {"window": head["window"], "pos": pos, "keys": m.keys, "value": m.value, "tags": m.tags}

        yield from guard.run({"window": head["window"], "keys": keys}, rows, produce)

    return scan.ordered_rows_scan(rows, group, [c for c in order if c in needed], run, out_type)


def accumulate_handler(
    df: DataFrame,
    handler: Any,
    *,
    init_args: tuple = (),
    init_kwargs: dict | None = None,
    timeout: str | None = None,
    columns: Sequence[str] = COLUMNS,
    order: Sequence[str] = ORDER,
    on_error: str = "fail",
    container: str = "accumulator",
) -> DataFrame:
    """``handler(datums) -> messages`` on all rows of each key in order; a class is built per key.

    Messages set their own event time, watermark, id and headers. The output window runs from epoch 0
    to the highest watermark the key has emitted so far. With ``timeout``, a key idle for longer is
    closed and starts afresh, so its stretches are separate groups (column ``stretch``, from 1). With
    ``on_error="capture"`` a failing stretch keeps what it emitted and adds a row with ``error``.
    """
    guard = _Guard(on_error, container)
    factory = make_factory(handler, init_args, init_kwargs)
    needed = [c for c in dict.fromkeys([*columns, "keys", *order]) if c in df.columns]
    names = ("id", "keys", "value", "event_time", "watermark", "headers", "tags")
    stretch = T.StructField("stretch", T.LongType())
    out_type = T.StructType([_WINDOW, stretch, T.StructField("pos", T.LongType()), *[E.ENVELOPE[n] for n in names], *guard.fields()])
    order = [c for c in order if c in needed]
    rows = df.select(*needed)
    if timeout is None:
        rows = rows.withColumn("stretch", F.lit(1).cast("bigint"))
    else:
        rows = number_stretches(rows, ["keys"], order, timeout)

    def run(rows: Iterator[dict], loop: scan.Loop) -> Iterator[dict]:
        head, rows = _first(rows)

        def produce(items: Iterator[Datum]) -> Iterator[dict]:
            call = factory()
            latest = EPOCH_TIME
            result = call(_Async(items) if _is_async(call) else items)
            for pos, m in enumerate(iterate(result, loop)):
                if m.watermark is not None:
                    latest = max(latest, m.watermark)
                row = {n: getattr(m, n) for n in names}
                window = {"start": EPOCH_TIME, "end": latest}
                yield {**row, "pos": pos, "stretch": head["stretch"], "window": window}

        yield from guard.run({"stretch": head["stretch"], "keys": head["keys"]}, rows, produce)

    return scan.ordered_rows_scan(rows, ["keys", "stretch"], order, run, out_type)


def number_stretches(df: DataFrame, group: Sequence[str], order: Sequence[str], timeout: str) -> DataFrame:
    """Number the active stretches of each group along ``order`` (time first): a gap over ``timeout`` starts one."""
    time = order[0]
    seen = O.running(df, group, order, {"_last": O.Running("max", F.col(time))}, exclusive=True)
    idle = F.unix_micros(time) - F.unix_micros("_last") > interval_micros(timeout)
    first = F.when(F.coalesce(idle, F.lit(True)), 1).otherwise(0).cast("bigint")
    marked = seen.withColumn("_first", first)
    return O.running(marked, group, order, {"stretch": O.Running("sum", F.col("_first"))}).drop("_last", "_first")


# Mergeable handlers ------------------------------------------------------------


def states_of(handlers: Sequence[MergeableHandler]) -> Iterator[bytes]:
    """The states of handlers of one class; a class with ``states`` is asked for many at once."""
    many = getattr(type(handlers[0]), "states", None) if handlers else None
    if many is None:
        yield from (h.state() for h in handlers)
        return
    for low in range(0, len(handlers), AT_ONCE):
        yield from many(handlers[low : low + AT_ONCE])


def merged_handlers(factory: Callable[[], MergeableHandler], groups: Sequence[Sequence[bytes]]) -> list[MergeableHandler]:
    """A handler for each group of states; a class with ``merges`` does many at once."""
    handlers = [factory() for _ in groups]
    many = getattr(type(handlers[0]), "merges", None) if handlers else None
    if many is not None:
        many(list(zip(handlers, groups)))
        return handlers
    for handler, group in zip(handlers, groups):
        for state in group:
            handler.merge(state)
    return handlers


def results_of(calls: Sequence[tuple[MergeableHandler, list[str], Interval]]) -> Iterator[Iterable[Message]]:
    """The results of handlers of one class; a class with ``results`` is asked for many at once."""
    many = getattr(type(calls[0][0]), "results", None) if calls else None
    if many is None:
        return (handler.result(keys, window) for handler, keys, window in calls)
    return iter(many(calls))


def _states(
    rows: DataFrame, group: Sequence[str], factory: Callable[[], MergeableHandler], time: str
) -> tuple[DataFrame, Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]]:
    """The rows with what combining needs, and a function from their batches to (group values, low, high, state)."""
    rows = rows.withColumn(scan.GROUP_ID, scan.group_id(group)).withColumn("_at", F.unix_micros(time))

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        open_groups: dict[str, list] = {}

        def flush() -> Iterator[tuple]:
            entries = list(open_groups.values())
            open_groups.clear()
            for (head, low, high, _), state in zip(entries, states_of([e[3] for e in entries])):
                yield [head[g] for g in group], low, high, state

        with scan.rare_collections():
            for batch in batches:
                ids, times = (batch.column(c).to_pylist() for c in (scan.GROUP_ID, "_at"))
                for row, group_id, at in zip(scan.batch_rows(batch), ids, times):
                    entry = open_groups.get(group_id)
                    if entry is None:
                        if len(open_groups) >= MAX_OPEN:
                            yield from flush()
                        entry = open_groups[group_id] = [row, at, at, factory()]
                    entry[1] = min(entry[1], at)
                    entry[2] = max(entry[2], at)
                    entry[3].add(Datum(row))
            yield from flush()

    return rows, states


def _combine(rows: DataFrame, group: Sequence[str], factory: Callable[[], MergeableHandler], time: str) -> DataFrame:
    """States per group inside each input partition, with the span of their rows. No shuffle."""
    from pyspark.sql.pandas.types import to_arrow_schema

    out_type = T.StructType([*[rows.schema[g] for g in group], *_SPAN])
    arrow = to_arrow_schema(out_type)
    rows, states = _states(rows, group, factory, time)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for values, low, high, state in states(batches):
            yield {**dict(zip(group, values)), "_lo": low, "_hi": high, "_state": state}

    return rows.mapInArrow(lambda batches: scan.to_batches(found(batches), arrow), out_type)


def _combine_packed(
    rows: DataFrame, group: Sequence[str], factory: Callable[[], MergeableHandler], time: str, place: str
) -> DataFrame:
    """The same, with the states of a task that go to one ``place`` as one packed row: a list of (keys, low, high, state).

    ``group`` begins with the keys, and ``place`` follows from them.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    out_type = T.StructType([T.StructField(place, T.LongType()), T.StructField("packed", T.BinaryType())])
    arrow = to_arrow_schema(out_type)
    rows, states = _states(rows, [*group, place], factory, time)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple]] = {}
        count = held = 0

        def flush() -> Iterator[dict]:
            for at, parts in waiting.items():
                yield {place: at, "packed": pickle.dumps(parts)}
            waiting.clear()

        for (keys, *_, at), low, high, state in states(batches):
            waiting.setdefault(at, []).append((keys, low, high, state))
            count, held = count + 1, held + len(state)
            if count >= MAX_WAITING or held >= scan.MAX_BYTES:
                yield from scan.to_batches(flush(), arrow, 256)
                count = held = 0
        yield from scan.to_batches(flush(), arrow, 256)

    return rows.mapInArrow(packed, out_type)


def _merge_run(factory: Callable[[], MergeableHandler], finish: Callable[[dict, int, int, MergeableHandler], Iterable[dict]]):
    def run(rows: Iterator[dict], _: scan.Loop) -> Iterator[dict]:
        head, rows = _first(rows)
        merged = factory()
        low, high = head["_lo"], head["_hi"]
        for row in rows:
            merged.merge(row["_state"])
            low, high = min(low, row["_lo"]), max(high, row["_hi"])
        yield from finish(head, low, high, merged)

    return run


def _mergeable_factory(handler: type, init_args: tuple, init_kwargs: dict | None) -> Callable[[], MergeableHandler]:
    if not inspect.isclass(handler):
        raise TypeError("a mergeable handler must be a class")
    missing = [m for m in ("add", "state", "merge", "result") if not callable(getattr(handler, m, None))]
    if missing:
        raise TypeError(f"{handler.__name__} lacks {', '.join(missing)}")
    kwargs = init_kwargs or {}
    return lambda: handler(*init_args, **kwargs)


_RESULT = T.StructType(
    [_WINDOW, T.StructField("pos", T.IntegerType()), *[E.ENVELOPE[n] for n in ("keys", "value", "tags")]]
)


def _emit(head: dict, window: Interval, handler: MergeableHandler) -> Iterator[dict]:
    for pos, m in enumerate(handler.result(head["keys"], window)):
        yield {
            "window": {"start": window.start, "end": window.end},
            "pos": pos,
            "keys": m.keys,
            "value": m.value,
            "tags": m.tags,
        }


def reduce_mergeable(
    df: DataFrame,
    length: str,
    handler: type[MergeableHandler],
    *,
    init_args: tuple = (),
    init_kwargs: dict | None = None,
    columns: Sequence[str] = COLUMNS,
) -> DataFrame:
    """Reduce each window and key with a mergeable handler: combined per partition, then merged."""
    factory = _mergeable_factory(handler, init_args, init_kwargs)
    needed = [c for c in dict.fromkeys([*columns, "keys", "event_time"]) if c in df.columns]
    rows = df.select(W.fixed_window(length).alias("window"), *needed)
    states = _combine(rows, ["window", "keys"], factory, "event_time")

    def finish(head, low, high, merged):
        yield from _emit(head, Interval(head["window"]["start"], head["window"]["end"]), merged)

    return scan.ordered_rows_scan(states, ["window", "keys"], [], _merge_run(factory, finish), _RESULT)


def session_handler(
    df: DataFrame,
    gap: str,
    handler: type[MergeableHandler],
    *,
    init_args: tuple = (),
    init_kwargs: dict | None = None,
    columns: Sequence[str] = COLUMNS,
    block: int = BLOCK,
) -> DataFrame:
    """Session reduce with a mergeable handler.

    States are combined per partition and gap-long bucket, merged to sessions inside blocks of
    buckets, and then across blocks, as in :mod:`msgflow.operators.session`.
    """
    factory = _mergeable_factory(handler, init_args, init_kwargs)
    needed = [c for c in dict.fromkeys([*columns, "keys", "event_time"]) if c in df.columns]
    width: Column = interval_micros(gap)
    rows = df.select(*needed, F.floor(F.unix_micros("event_time") / width).alias("_bucket"))
    parts = _combine(rows, ["keys", "_bucket"], factory, "event_time")
    parts = parts.withColumn("_block", F.floor(F.col("_bucket") / block)).drop("_bucket")

    local_type = T.StructType(
        [
            E.ENVELOPE["keys"],
            parts.schema["_block"],
            T.StructField("_no", T.LongType()),
            *[parts.schema[c] for c in ("_lo", "_hi", "_state")],
        ]
    )

    def keep(head, low, high, merged):
        yield {
            **{c: head[c] for c in ("keys", "_block", "_no")},
            "_lo": low,
            "_hi": high,
            "_state": merged.state(),
        }

    numbered = number_sessions(parts, ["keys", "_block"], width)
    local = scan.ordered_rows_scan(
        numbered, ["keys", "_block", "_no"], [], _merge_run(factory, keep), local_type, together=True
    )
    whole = Window.partitionBy("keys", "_block")
    edge = (F.col("_no") == 1) | (F.col("_no") == F.max("_no").over(whole))
    placed = local.withColumn("_place", F.when(~edge, F.col("_block"))).drop("_no", "_block")
    final = number_sessions(placed, ["keys", "_place"], width).withColumn("_gap", width)

    def finish(head, low, high, merged):
        yield from _emit(head, Interval(at_micros(low), at_micros(high + head["_gap"])), merged)

    return scan.ordered_rows_scan(
        final, ["keys", "_place", "_no"], ["_lo"], _merge_run(factory, finish), _RESULT, together=True
    )
