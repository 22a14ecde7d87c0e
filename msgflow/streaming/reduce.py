"""Reducers on streams whose state is one value per window and key, not the window's rows.

* :func:`reduce_mergeable_stream`: rows become partial states inside each task of a micro-batch, and only these are
  shuffled and merged into the stored state. A hot key costs one row per task and micro-batch; without keys too.
* :func:`reduce_resumable_stream`: a handler that emits while its window is open. It is saved after each micro-batch and
  loaded by the next.
* :func:`early_sum_stream`: a sum that is emitted and restarted whenever it reaches a threshold, in event-time order. Rows
  wait in their time bucket; buckets are folded in order as the watermark passes them, and the sum is carried on.

Rows of windows that the watermark has passed are late and left out.
"""

from __future__ import annotations

import inspect
import itertools
import json
import pickle
from collections.abc import AsyncIterator, Iterable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from msgflow.functions.scalars import interval_micros
from msgflow.message import Datum, Interval, Message
from msgflow.operators import envelope as E
from msgflow.operators import scan
from msgflow.operators import windows as W
from msgflow.operators.early import fold_sum
from msgflow.operators.group_handlers import COLUMNS, MergeableHandler, _combine, _is_async, _mergeable_factory
from msgflow.operators.handlers import iterate
from msgflow.streaming import packed
from msgflow.streaming.stateful import _bounds, _constant, _grouped, _interval, _message_row, _result_type, _run, _timer_ms, micros

WINDOW_BUCKETS = 256  # of each window; several windows are open at a time
_PACKED = T.StructType([T.StructField("packed", T.BinaryType())])


def _closed(end, timer_values) -> bool:
    """Whether the watermark has passed a window."""
    return _timer_ms(micros(end)) <= timer_values.getCurrentWatermarkInMs()


class _Merge(StatefulProcessor):
    def __init__(self, factory, keyed: bool) -> None:
        self.factory, self.keyed = factory, keyed

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", _PACKED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        merged, head = self.factory(), None
        for row in rows:
            if head is None:
                head = (row["window"]["start"], row["window"]["end"], list(row["keys"]) if self.keyed else [])
            merged.merge(bytes(row["_state"]))
        if self.state.exists():
            merged.merge(pickle.loads(bytes(self.state.get()[0]))[1])
        elif _closed(head[1], timerValues):
            return iter([])
        else:
            self.handle.registerTimer(_timer_ms(micros(head[1])))
        self.state.update((pickle.dumps((head, merged.state())),))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        (start, end, keys), state = pickle.loads(bytes(self.state.get()[0]))
        self.state.clear()
        handler = self.factory()
        handler.merge(state)
        for pos, m in enumerate(handler.result(keys, Interval(start, end))):
            yield _message_row(start, end, pos, m)


def reduce_mergeable_stream(
    df: DataFrame,
    length: str,
    handler: type[MergeableHandler],
    *,
    init_args: tuple = (),
    init_kwargs: dict | None = None,
    keyed: bool = True,
    columns: Sequence[str] = COLUMNS,
) -> DataFrame:
    """Reduce each window (and key) with a mergeable handler: combined in the task, merged in the state."""
    factory = _mergeable_factory(handler, init_args, init_kwargs)
    needed = [c for c in dict.fromkeys([*columns, "keys", "event_time"]) if c in df.columns]
    group = ["window", "keys"] if keyed else ["window"]
    rows = df.select(W.plain_window(length).alias("window"), *needed)
    return _run(_grouped(_combine(rows, group, factory, "event_time"), group), _Merge(factory, keyed), _result_type())


class StreamReducer:
    """Base of reducers that emit while their window is open; one per window and key, saved between micro-batches.

    ``add`` and ``close`` may be plain functions, generators, coroutines or async generators, and may emit nothing.
    """

    def add(self, datum: Datum) -> Iterable[Message] | None:
        raise NotImplementedError

    def close(self) -> Iterable[Message] | None:
        return None

    def save(self) -> bytes:
        return pickle.dumps(self.__dict__)

    def load(self, state: bytes) -> None:
        self.__dict__.update(pickle.loads(state))


class _Arrived(dict):
    """A row as it came; its event time, and its keys where they are text, are made when they are read."""

    __slots__ = ("lazy",)

    def __missing__(self, name: str) -> Any:
        at, zone, keys = self.lazy
        if name == "event_time":
            self[name] = pa.scalar(at, pa.timestamp("us", tz=zone)).as_py()
        elif name == "keys" and keys is not None:
            self[name] = json.loads(keys).get("keys")
        else:
            raise KeyError(name)
        return self[name]

    def get(self, name: str, default: Any = None) -> Any:
        try:
            return self[name]
        except KeyError:
            return default

    def whole(self, names: Iterable[str]) -> dict:
        return {n: self[n] for n in names}

    def __reduce__(self):
        return dict, (self.whole([*self, "event_time", *(["keys"] if self.lazy[2] is not None else [])]),)


async def _awaited(calls: list[tuple]) -> list[tuple]:
    said = []
    for entry, method, args in calls:
        result = method(*args)
        if inspect.iscoroutine(result):
            result = await result
        if isinstance(result, AsyncIterator):
            async for m in result:
                said.append((entry, m))
        else:
            said.extend((entry, m) for m in result or ())
    return said


def _answers(calls: Iterator[tuple], loop: scan.Loop) -> Iterator[tuple]:
    """(entry, message) for calls (entry, method, arguments) in their order; coroutines share runs of the event loop."""
    for first in calls:
        if not _is_async(first[1]):
            yield from ((first[0], m) for m in iterate(first[1](*first[2]), loop))
        else:
            yield from loop.run(_awaited([first, *itertools.islice(calls, packed.CHUNK)]))


class _Resume:
    """The reducers of a window and a bucket of keys: one state value with what each has saved, one time to close them.

    Rows come as (time, key, values of the columns); :class:`_ResumeRows` and :meth:`frames` bring them.
    """

    def __init__(self, factory, columns: list[str], order: list[str], keyed: bool, width: int, buckets: int, zone: str, text: bool) -> None:
        self.factory, self.columns, self.order, self.keyed = factory, columns, order, keyed
        self.width, self.buckets, self.zone, self.text = width, buckets, zone, text

    def _rows(self, start: int, calls: Iterator[tuple], final: bool) -> Iterator[tuple]:
        end = start + self.width
        with scan.Loop() as loop:
            for entry, m in _answers(calls, loop):
                yield start, end, entry[0], final, m.keys, m.value, m.tags
                entry[0] += 1

    def _load(self, saved: tuple[int, bytes]) -> list:
        worker = self.factory()
        worker.load(saved[1])
        return [saved[0], worker]

    def _items(self, rows: Iterable[tuple]) -> Iterator[tuple[str, _Arrived]]:
        for at, key, *values in rows:
            item = _Arrived(zip(self.columns, values))
            item.lazy = (at, self.zone, key if self.text else None)
            yield key if self.keyed else "", item

    def _sorted(self, items: Iterator[tuple[str, _Arrived]]) -> Iterator[tuple[str, _Arrived]]:
        by_key: dict[str, list[_Arrived]] = {}
        for key, item in items:
            by_key.setdefault(key, []).append(item)
        for key, own in by_key.items():
            yield from ((key, item) for item in sorted(own, key=lambda d: tuple(d[c] for c in self.order)))

    def start(self, place: int) -> int:
        return place // self.buckets * self.width

    def due(self, start: int) -> int:
        return _timer_ms(start + self.width)

    def take(self, start: int, rows: Iterable[tuple], held: dict[str, tuple[int, bytes]], late: bool) -> Iterator[bytes]:
        """Packed output of the rows; what the reducers save goes to ``held``. ``late``: no new reducer is opened."""
        opened: dict[str, list] = {}

        def calls() -> Iterator[tuple]:
            items = self._items(rows)
            for own, item in self._sorted(items) if self.order else items:
                entry = opened.get(own)
                if entry is None:
                    if own in held:
                        entry = self._load(held[own])
                    elif late:
                        continue
                    else:
                        entry = [0, self.factory()]
                    opened[own] = entry
                yield entry, entry[1].add, (Datum(item),)

        with scan.rare_collections():
            yield from packed.pack(self._rows(start, calls(), False))
            for own, (seen, worker) in opened.items():
                held[own] = (seen, worker.save())

    def close(self, start: int, held: dict[str, tuple[int, bytes]]) -> Iterator[bytes]:
        entries = map(self._load, held.values())
        with scan.rare_collections():
            yield from packed.pack(self._rows(start, ((entry, entry[1].close, ()) for entry in entries), True))

    def frames(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """One call of ``applyInPandasWithState``: a column is decoded at once, which many rows need."""
        start = self.start(int(key[0]))
        due, now = self.due(start), state.getCurrentWatermarkMs()
        held = pickle.loads(state.get[0]) if state.exists else {}
        if not state.hasTimedOut:
            rows = itertools.chain.from_iterable(zip(*(f[c].tolist() for c in f.columns[1:])) for f in frames)
            for out in self.take(start, rows, held, due <= now):
                yield pd.DataFrame({"packed": [out]})
        if not held:
            return
        if state.hasTimedOut or due <= now:
            state.remove()
            for out in self.close(start, held):
                yield pd.DataFrame({"packed": [out]})
        else:
            state.update((pickle.dumps(held),))
            state.setTimeoutTimestamp(max(due - 1, 1))  # positive; it fires once the watermark is beyond it


class _ResumeRows(StatefulProcessor):
    """The same with rows one at a time, for columns of any type."""

    def __init__(self, reducers: _Resume) -> None:
        self.reducers = reducers

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", packed.PACKED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        start = self.reducers.start(key[0])
        due = self.reducers.due(start)
        known = self.state.exists()
        held = pickle.loads(bytes(self.state.get()[0])) if known else {}
        late = due <= timerValues.getCurrentWatermarkInMs()
        yield from (Row(packed=out) for out in self.reducers.take(start, (row[1:] for row in rows), held, late))
        if held:
            if not known:
                self.handle.registerTimer(due)
            self.state.update((pickle.dumps(held),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = pickle.loads(bytes(self.state.get()[0]))
        self.state.clear()
        yield from (Row(packed=out) for out in self.reducers.close(self.reducers.start(key[0]), held))


def reduce_resumable_stream(
    df: DataFrame,
    length: str,
    handler: type[StreamReducer],
    *,
    init_args: tuple = (),
    init_kwargs: dict | None = None,
    keyed: bool = True,
    columns: Sequence[str] = COLUMNS,
    order: Sequence[str] = (),
    buckets: int = WINDOW_BUCKETS,
) -> DataFrame:
    """``handler.add(datum)`` for each row of a window and key, which may emit at once; ``close`` when the window ends.

    Columns: window, pos (emissions of the window, from 0), final (from ``close``), keys, value, tags. Rows come as they
    arrive and are not held; with ``order`` the rows of a key and micro-batch are sorted first. The reducers of a window and
    one of ``buckets`` shares of the keys are read and written together (see :mod:`msgflow.streaming.packed`); their number
    is fixed for the life of the query.
    """
    if not (inspect.isclass(handler) and issubclass(handler, StreamReducer)):
        raise TypeError("a resumable reducer must be a subclass of StreamReducer")
    kwargs = init_kwargs or {}
    needed = [c for c in dict.fromkeys([*columns, "keys", "event_time", *order]) if c in df.columns]
    width = interval_micros(length)
    text = "keys" in needed and df.schema["keys"].dataType.simpleString() == "array<string>"
    others = [c for c in needed if c != "event_time" and not (text and c == "keys")]
    place = F.floor(F.unix_micros("event_time") / width) * buckets + (packed.bucket(buckets) if keyed else 0)
    # Times as numbers, which are several times cheaper to read than timestamps; Spark drops late rows by the column that
    # bears the mark of the watermark.
    at = F.unix_micros("event_time").alias("_at", metadata=df.schema["event_time"].metadata)
    own = scan.group_id(["keys"]) if "keys" in needed else F.lit("")
    rows = df.select(place.alias(packed.PLACE), at, own.alias(scan.GROUP_ID), *others)
    out_type = T.StructType(
        [
            _interval(),
            T.StructField("pos", T.LongType()),
            T.StructField("final", T.BooleanType()),
            *[E.ENVELOPE[n] for n in ("keys", "value", "tags")],
        ]
    )
    reducers = _Resume(
        lambda: handler(*init_args, **kwargs),
        others,
        [c for c in order if c in needed],
        keyed,
        _constant(df, width),
        buckets,
        df.sparkSession.conf.get("spark.sql.session.timeZone"),
        text,
    )
    grouped = rows.groupBy(packed.PLACE)
    if all(rows.schema[c].dataType in (T.StringType(), T.BinaryType()) for c in others):  # which pandas leaves as they are
        out = grouped.applyInPandasWithState(reducers.frames, packed.PACKED, packed.PACKED, "append", "EventTimeTimeout")
    else:
        out = _run(grouped, _ResumeRows(reducers), packed.PACKED)
    return packed.unpack(out, out_type)


class _BucketSum(StatefulProcessor):
    """Rows wait as packed (time, tie, value) arrays by time bucket; the carry is (emissions so far, sum)."""

    def __init__(self, threshold: int, width: int) -> None:
        self.threshold, self.width = threshold, width

    def init(self, handle) -> None:
        self.handle = handle
        place = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("seq", T.LongType())])
        self.chunks = handle.getMapState("chunks", place, _PACKED)
        self.carry = handle.getValueState("carry", _PACKED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        by_bucket: dict[int, list[tuple]] = {}
        head = None
        for row in rows:
            if head is None:
                head = (row["window"]["start"], row["window"]["end"], list(row["keys"]))
            by_bucket.setdefault(row["_at"] // self.width, []).append((row["_at"], row["_tie"], row["_value"]))
        if self.carry.exists():
            head, emitted, total, seq, waiting = pickle.loads(bytes(self.carry.get()[0]))
        elif _closed(head[1], timerValues):
            return iter([])
        else:
            emitted, total, seq, waiting = 0, 0, 0, set()
            self.handle.registerTimer(_timer_ms(micros(head[1])))
        end = _timer_ms(micros(head[1]))
        now = timerValues.getCurrentWatermarkInMs()
        for bucket, values in by_bucket.items():
            due = _timer_ms((bucket + 1) * self.width)
            if due <= now:  # its sum has been carried on
                continue
            self.chunks.updateValue((bucket, seq), (np.array(values, dtype="<i8").tobytes(),))
            seq += 1
            if bucket not in waiting:
                waiting.add(bucket)
                if due < end:
                    self.handle.registerTimer(due)
        self.carry.update((pickle.dumps((head, emitted, total, seq, waiting)),))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.carry.exists():
            return
        head, emitted, total, seq, waiting = pickle.loads(bytes(self.carry.get()[0]))
        now = expiredTimerInfo.getExpiryTimeInMs()
        whole = now >= _timer_ms(micros(head[1]))
        ready = sorted(b for b in waiting if whole or _timer_ms((b + 1) * self.width) <= now)
        places = sorted(tuple(k) for k in self.chunks.keys()) if ready else []
        for bucket in ready:
            own = [p for p in places if p[0] == bucket]
            rows = np.concatenate([np.frombuffer(bytes(self.chunks.getValue(p)[0]), dtype="<i8").reshape(-1, 3) for p in own])
            rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
            for hit, total in fold_sum(total, iter(rows[:, 2].tolist()), self.threshold):
                if hit:
                    emitted += 1
                    yield self._row(head, emitted, total, False)
            for p in own:
                self.chunks.removeKey(p)
            waiting.discard(bucket)
        if whole:
            yield self._row(head, emitted + 1, total, True)
            self.carry.clear()
        elif ready:
            self.carry.update((pickle.dumps((head, emitted, total, seq, waiting)),))

    @staticmethod
    def _row(head: tuple, emit: int, total: int, final: bool) -> Row:
        return Row(window=_bounds(head[0], head[1]), keys=head[2], emit=emit, total=total, final=final)


def early_sum_stream(
    df: DataFrame, length: str, value: Column, tie: Column, threshold: int, *, bucket: str = "1 hour"
) -> DataFrame:
    """Sum ``value`` per window and key in (event time, ``tie``) order; emit and restart at ``threshold``; the rest at the end.

    ``value`` and ``tie`` are whole numbers; a row without value adds 0. Emissions come out once the watermark passes their
    ``bucket``, so rows may arrive in any order within the watermark's delay.
    """
    rows = df.select(
        W.plain_window(length).alias("window"),
        "keys",
        "event_time",
        F.unix_micros("event_time").alias("_at"),
        tie.cast("long").alias("_tie"),
        F.coalesce(value.cast("long"), F.lit(0)).alias("_value"),
    )
    out_type = T.StructType(
        [
            _interval(),
            E.ENVELOPE["keys"],
            T.StructField("emit", T.LongType()),
            T.StructField("total", T.LongType()),
            T.StructField("final", T.BooleanType()),
        ]
    )
    width = _constant(df, interval_micros(bucket))
    return _run(_grouped(rows, ["window", "keys"]), _BucketSum(threshold, width), out_type)

