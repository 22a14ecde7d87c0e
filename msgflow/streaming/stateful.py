"""Keyed state on streams: sorting, early counts, sessions, windows and accumulators.

Rows are grouped by the text of their key (and window or time bucket); state lives in Spark's
state store and event-time timers close it when the watermark passes. Rows older than the watermark
are dropped by Spark before they get here. Results of a micro-batch appear when it commits.
"""

from __future__ import annotations

import inspect
import pickle
from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from msgflow.constants import EPOCH_TIME, at_micros
from msgflow.message import Datum, Interval, Message, make_factory
from msgflow.operators import envelope as E
from msgflow.operators import scan
from msgflow.operators import windows as W
from msgflow.operators.group_handlers import _Async, _combine_packed, _is_async, _mergeable_factory, merged_handlers, results_of, states_of
from msgflow.operators.handlers import iterate
from msgflow.functions.scalars import interval_micros
from msgflow.streaming import packed

COLUMNS = ("id", "keys", "value", "event_time", "watermark", "headers")
_ACCUMULATED = (*COLUMNS, "tags")


def _interval() -> T.StructField:
    return T.StructField(
        "window", T.StructType([T.StructField("start", T.TimestampType()), T.StructField("end", T.TimestampType())])
    )


def _bounds(start: datetime, end: datetime) -> Row:
    return Row(start=start, end=end)


def _message_row(start: datetime, end: datetime, pos: int, m: Message) -> Row:
    return Row(window=_bounds(start, end), pos=pos, keys=m.keys, value=m.value, tags=m.tags)


def micros(t: datetime) -> int:
    t = t if t.tzinfo else t.astimezone()
    delta = t - EPOCH_TIME
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def _timer_ms(at: int) -> int:
    """The first millisecond at or after ``at`` microseconds."""
    return -(-at // 1000)


def _grouped(df: DataFrame, group: Sequence[str]):
    return df.withColumn(scan.GROUP_ID, scan.group_id(group)).groupBy(scan.GROUP_ID)


def _run(grouped, processor: StatefulProcessor, out_type: T.StructType) -> DataFrame:
    return grouped.transformWithState(processor, out_type, outputMode="Append", timeMode="EventTime")


def _typed(df: DataFrame, columns: Sequence[str]) -> list[T.StructField]:
    return [df.schema[c] for c in columns]


def _constant(df: DataFrame, micros_col) -> int:
    return df.sparkSession.range(1).select(micros_col).first()[0]


class _Sort(StatefulProcessor):
    def __init__(self, columns: list[str], order: list[str], width: int) -> None:
        self.columns, self.order, self.width = columns, order, width

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", T.StructType([T.StructField("row", T.BinaryType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        buffered = [(r["_bucket"], tuple(r[c] for c in self.columns)) for r in rows]
        if not self.rows.exists():
            self.handle.registerTimer(_timer_ms((buffered[0][0] + 1) * self.width))
        self.rows.appendList([(pickle.dumps(values),) for _, values in buffered])
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        place = [self.columns.index(c) for c in self.order]
        rows = [pickle.loads(bytes(r[0])) for r in self.rows.get()]
        rows.sort(key=lambda v: tuple(v[i] for i in place))  # stable: ties keep their arrival order
        self.rows.clear()
        for pos, values in enumerate(rows):
            yield Row(pos=pos, **dict(zip(self.columns, values)))


def sort_stream(
    df: DataFrame, group: Sequence[str], order: Sequence[str], *, bucket: str = "1 minute", time: str = "event_time"
) -> DataFrame:
    """Rows of each key in event-time order, released when the watermark passes their time bucket.

    State is held per (key, bucket), so a hot key spreads over tasks and no buffer outlives its
    bucket. ``bucket_start`` and ``pos`` order the output rows of a key.
    """
    width = _constant(df, interval_micros(bucket))
    rows = df.withColumn("_bucket", F.floor(F.unix_micros(time) / width))
    columns = [c for c in df.columns]
    out_type = T.StructType([T.StructField("pos", T.IntegerType()), *_typed(df, columns)])
    out = _run(_grouped(rows, [*group, "_bucket"]), _Sort(columns, list(order), width), out_type)
    start = F.floor(F.unix_micros(time) / width) * width
    return out.withColumn("bucket_start", F.timestamp_micros(start))


class _EarlyCount(StatefulProcessor):
    def __init__(self, group: list[str], threshold: int) -> None:
        self.group, self.step = group, threshold + 1

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "count", T.StructType([T.StructField("n", T.LongType()), T.StructField("head", T.BinaryType())])
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = next(rows)
        added = 1 + sum(1 for _ in rows)
        if self.state.exists():
            before, packed = self.state.get()
        else:
            before, packed = 0, pickle.dumps((first["window"]["start"], first["window"]["end"], first["keys"]))
            self.handle.registerTimer(_timer_ms(micros(first["window"]["end"])))
        self.state.update((before + added, packed))
        start, end, keys = pickle.loads(bytes(packed))
        for emit in range(before // self.step + 1, (before + added) // self.step + 1):
            yield Row(window=_bounds(start, end), keys=keys, emit=emit, counter=self.step, final=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        n, packed = self.state.get()
        start, end, keys = pickle.loads(bytes(packed))
        self.state.clear()
        yield Row(window=_bounds(start, end), keys=keys, emit=n // self.step + 1, counter=n % self.step, final=True)


def early_counter_stream(df: DataFrame, length: str, threshold: int = 10) -> DataFrame:
    """Emit a window's count and restart it whenever it exceeds ``threshold``; the rest at its end."""
    rows = df.select(W.plain_window(length).alias("window"), "keys", "event_time")
    out_type = T.StructType(
        [
            _interval(),
            E.ENVELOPE["keys"],
            T.StructField("emit", T.LongType()),
            T.StructField("counter", T.LongType()),
            T.StructField("final", T.BooleanType()),
        ]
    )
    return _run(_grouped(rows, ["window", "keys"]), _EarlyCount(["window", "keys"], threshold), out_type)


class _WindowRows(StatefulProcessor):
    def __init__(self, factory, columns: list[str], order: list[str]) -> None:
        self.factory, self.columns, self.order = factory, columns, order

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", T.StructType([T.StructField("row", T.BinaryType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        taken = [{c: r[c] for c in ("window", *self.columns)} for r in rows]
        if not self.rows.exists():
            self.handle.registerTimer(_timer_ms(micros(taken[0]["window"]["end"])))
        self.rows.appendList([(pickle.dumps(r),) for r in taken])
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        rows = [pickle.loads(bytes(r[0])) for r in self.rows.get()]
        rows.sort(key=lambda d: tuple(d[c] for c in self.order))
        self.rows.clear()
        keys, window = rows[0]["keys"], rows[0]["window"]
        start, end = window["start"], window["end"]
        call = self.factory()
        items = map(Datum, rows)
        with scan.Loop() as loop:
            result = call(keys, _Async(items) if _is_async(call) else items, Interval(start, end))
            for pos, m in enumerate(iterate(result, loop)):
                yield _message_row(start, end, pos, m)


def _result_type() -> T.StructType:
    return T.StructType(
        [_interval(), T.StructField("pos", T.IntegerType()), *[E.ENVELOPE[n] for n in ("keys", "value", "tags")]]
    )


def reduce_handler_stream(
    df: DataFrame,
    length: str,
    handler: Any,
    *,
    init_args: tuple = (),
    init_kwargs: dict | None = None,
    columns: Sequence[str] = COLUMNS,
    order: Sequence[str] = ("event_time", "id"),
) -> DataFrame:
    """An opaque reduce handler on a stream: the rows of a window and key are kept until it closes.

    Prefer native aggregates, whose state is one row per group.
    """
    factory = make_factory(handler, init_args, init_kwargs)
    needed = [c for c in dict.fromkeys([*columns, "keys", "event_time", *order]) if c in df.columns]
    rows = df.select(W.plain_window(length).alias("window"), *needed)
    processor = _WindowRows(factory, needed, [c for c in order if c in needed])
    return _run(_grouped(rows, ["window", "keys"]), processor, _result_type())


class _Sessions(StatefulProcessor):
    """The open sessions of a bucket of keys as one state value: few are open at a time. One timer per bucket.

    Rows come packed, as states of stretches shorter than the gap, made in the tasks before the shuffle.
    """

    def __init__(self, factory, gap: int) -> None:
        self.factory, self.gap = factory, gap

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("sessions", packed.PACKED)

    def _load(self) -> dict[tuple, list[tuple]]:
        return pickle.loads(bytes(self.state.get()[0])) if self.state.exists() else {}

    def _due_ms(self, held: dict[tuple, list[tuple]]) -> int | None:
        end = min((end for sessions in held.values() for _, end, _ in sessions), default=None)
        return None if end is None else _timer_ms(end + self.gap)

    def _save(self, held: dict[tuple, list[tuple]], timer: int | None) -> None:
        """Store the sessions and move the timer to the first one that closes."""
        due = self._due_ms(held)
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if due is None:
            self.state.clear()
            return
        if timer != due:
            self.handle.registerTimer(due)
        self.state.update((pickle.dumps(held),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        with scan.rare_collections():
            self._take(rows, timerValues.getCurrentWatermarkInMs())
        return iter([])

    def _take(self, rows: Iterator[Row], now: int) -> None:
        held = self._load()
        timer = self._due_ms(held)
        parts: dict[tuple, list[tuple]] = {}
        for r in rows:
            for keys, low, high, state in pickle.loads(bytes(r["packed"])):
                parts.setdefault(tuple(keys), []).append((low, high, False, state))
        joined: list[tuple] = []  # (session, its states) where there are several
        for keys, new in parts.items():
            # Stored sessions and stretches in order of their start: neighbours within the gap merge.
            line = sorted([*[(a, b, True, s) for a, b, s in held.get(keys, ())], *new], key=lambda x: x[:2])
            merged: list[list] = []
            for start, end, known, state in line:
                if merged and start - merged[-1][1] <= self.gap:
                    merged[-1][1] = max(merged[-1][1], end)
                    merged[-1][2] |= known
                    merged[-1][3].append(state)
                else:
                    merged.append([start, end, known, [state]])
            sessions = []
            for start, end, known, states in merged:
                if not known and _timer_ms(end + self.gap) <= now:  # the whole session is late
                    continue
                if len(states) > 1:
                    joined.append((sessions, len(sessions), states))
                sessions.append((start, end, states[0]))
            if sessions:
                held[keys] = sessions
        for low in range(0, len(joined), packed.CHUNK):
            some = joined[low : low + packed.CHUNK]
            handlers = merged_handlers(self.factory, [states for _, _, states in some])
            for (sessions, at, _), state in zip(some, states_of(handlers)):
                sessions[at] = (*sessions[at][:2], state)
        if held:
            self._save(held, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        held = self._load()
        closed = []
        for keys in list(held):
            closed += [(keys, s) for s in held[keys] if _timer_ms(s[1] + self.gap) <= now]
            held[keys] = [s for s in held[keys] if _timer_ms(s[1] + self.gap) > now]
            if not held[keys]:
                del held[keys]
        self._save(held, None)
        with scan.rare_collections():
            yield from (Row(packed=out) for out in packed.pack(self._results(closed)))

    def _results(self, closed: list[tuple]) -> Iterator[tuple]:
        for low in range(0, len(closed), packed.CHUNK):
            some = closed[low : low + packed.CHUNK]
            handlers = merged_handlers(self.factory, [[state] for _, (_, _, state) in some])
            windows = [Interval(at_micros(start), at_micros(end + self.gap)) for _, (start, end, _) in some]
            calls = [(h, list(keys), w) for h, (keys, _), w in zip(handlers, some, windows)]
            for (_, (start, end, _)), messages in zip(some, results_of(calls)):
                for pos, m in enumerate(messages):
                    yield start, end + self.gap, pos, m.keys, m.value, m.tags


def session_handler_stream(
    df: DataFrame,
    gap: str,
    handler: type,
    *,
    init_args: tuple = (),
    init_kwargs: dict | None = None,
    columns: Sequence[str] = COLUMNS,
    buckets: int = packed.BUCKETS,
) -> DataFrame:
    """Sessions with a mergeable handler: a row that bridges two open sessions merges their states.

    Rows are combined per key and gap-long bucket inside their task, so a hot key is a few rows per task and micro-batch.
    A session that the watermark has passed before its first row arrives is late and left out. The sessions of one of
    ``buckets`` shares of the keys are read and written together (see :mod:`msgflow.streaming.packed`); their number is fixed
    for the life of the query.
    """
    factory = _mergeable_factory(handler, init_args, init_kwargs)
    needed = [c for c in dict.fromkeys([*columns, "keys", "event_time"]) if c in df.columns]
    width = interval_micros(gap)
    rows = df.select(*needed, F.floor(F.unix_micros("event_time") / width).alias("_bucket"), packed.bucket(buckets).alias(packed.PLACE))
    parts = _combine_packed(rows, ["keys", "_bucket"], factory, "event_time", packed.PLACE)
    out = _run(parts.groupBy(packed.PLACE), _Sessions(factory, _constant(df, width)), packed.PACKED)
    return packed.unpack(out, _result_type())


class StreamAccumulator:
    """Base of accumulators on streams: one per key, saved between micro-batches.

    ``add`` may return messages at once; ``close`` may return more when the key has been idle.
    """

    def add(self, datum: Datum) -> Iterable[Message] | None:
        raise NotImplementedError

    def close(self) -> Iterable[Message] | None:
        return None

    def save(self) -> bytes:
        return pickle.dumps(self.__dict__)

    def load(self, state: bytes) -> None:
        self.__dict__.update(pickle.loads(state))


class _Accumulate(StatefulProcessor):
    def __init__(self, factory, columns: list[str], order: list[str], timeout: int) -> None:
        self.factory, self.columns, self.order, self.timeout = factory, columns, order, timeout

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "state",
            T.StructType(
                [
                    T.StructField("saved", T.BinaryType()),
                    T.StructField("keys", T.BinaryType()),
                    T.StructField("last", T.LongType()),
                    T.StructField("seen", T.LongType()),
                    T.StructField("watermark", T.LongType()),
                ]
            ),
        )

    def _rows(self, messages: Iterable[Message] | None) -> Iterator[Row]:
        for m in messages or ():
            if m.watermark is not None:
                self.latest = max(self.latest, micros(m.watermark))
            self.seen += 1
            window = _bounds(EPOCH_TIME, at_micros(self.latest))
            yield Row(window=window, pos=self.seen - 1, eof=False, **{n: getattr(m, n) for n in _ACCUMULATED})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        batch = sorted(({c: r[c] for c in self.columns} for r in rows), key=lambda d: tuple(d[c] for c in self.order))
        worker = self.factory()
        keys = batch[0]["keys"]
        if self.state.exists():
            saved, _, last, self.seen, self.latest = self.state.get()
            worker.load(bytes(saved))
            self.handle.deleteTimer(_timer_ms(last + self.timeout))
        else:
            self.seen, self.latest, last = 0, 0, micros(batch[0]["event_time"])
        for d in batch:
            at = micros(d["event_time"])
            if at - last > self.timeout:  # idle within the batch: the timer had no chance to fire
                yield from self._close(worker, keys)
                worker, self.seen, self.latest = self.factory(), 0, 0
            last = max(last, at)
            yield from self._rows(worker.add(Datum(d)))
        self.state.update((worker.save(), pickle.dumps(keys), last, self.seen, self.latest))
        self.handle.registerTimer(_timer_ms(last + self.timeout))

    def _close(self, worker: StreamAccumulator, keys: list[str]) -> Iterator[Row]:
        yield from self._rows(worker.close())
        window = _bounds(EPOCH_TIME, at_micros(self.latest))
        last = Message(keys=keys)
        yield Row(window=window, pos=self.seen, eof=True, **{n: getattr(last, n) for n in _ACCUMULATED})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        saved, keys, _, self.seen, self.latest = self.state.get()
        worker = self.factory()
        worker.load(bytes(saved))
        self.state.clear()
        yield from self._close(worker, pickle.loads(bytes(keys)))


def accumulate_stream(
    df: DataFrame,
    handler: type[StreamAccumulator],
    *,
    timeout: str,
    init_args: tuple = (),
    init_kwargs: dict | None = None,
    columns: Sequence[str] = COLUMNS,
    order: Sequence[str] = ("event_time", "id"),
) -> DataFrame:
    """One accumulator per key. A key idle for ``timeout`` is closed: its last messages, then an
    ``eof`` row, and its next row starts afresh."""
    if not (inspect.isclass(handler) and issubclass(handler, StreamAccumulator)):
        raise TypeError("a stream accumulator must be a subclass of StreamAccumulator")
    kwargs = init_kwargs or {}
    needed = [c for c in dict.fromkeys([*columns, "keys", "event_time", *order]) if c in df.columns]
    out_type = T.StructType(
        [
            _interval(),
            T.StructField("pos", T.LongType()),
            T.StructField("eof", T.BooleanType()),
            *[E.ENVELOPE[n] for n in _ACCUMULATED],
        ]
    )
    processor = _Accumulate(
        lambda: handler(*init_args, **kwargs),
        needed,
        [c for c in order if c in needed],
        _constant(df, interval_micros(timeout)),
    )
    return _run(_grouped(df.select(*needed), ["keys"]), processor, out_type)
