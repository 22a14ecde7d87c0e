"""User-defined sources as Spark data sources, for batch and streaming reads.

A source tells its partitions and, per partition, a range of consecutive offset numbers; Spark reads
slices of those ranges in parallel tasks, so a partition that holds most rows is still spread. The
end of a committed micro-batch is acknowledged to the source. Refused rows come back through
:func:`msgflow.streaming.sinks.with_redelivery`.

Where ``spark.sql.python.filterPushdown.enabled`` is true when a source is registered, batch reads
hand it the filters on event time and partition: partitions left out are not asked, and
:meth:`Source.prune` may leave out offset ranges. Spark applies every filter to the rows again.
"""

from __future__ import annotations

import json
from abc import ABC, abstractmethod
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from msgflow.constants import MISSING_TIME
from msgflow.operators import envelope as E
from msgflow.operators import scan

FIELDS = ("id", "keys", "value", "event_time", "headers", "user_metadata", "offset")
SCHEMA = T.StructType([E.ENVELOPE[f] for f in FIELDS])
UNKNOWN = -1
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


@dataclass
class SourceRow:
    """One row of a source. The offset bytes default to the offset number as text."""

    payload: bytes
    event_time: datetime | None = None
    offset: bytes | None = None
    keys: list[str] | None = None
    headers: dict[str, str] | None = None
    user_metadata: dict[str, dict[str, bytes]] | None = None


def _utc(at: datetime) -> datetime:
    return at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)


@dataclass
class Bounds:
    """What filters ask for: event times from ``low`` to ``high``, both included, as UTC; None: no bound."""

    low: datetime | None = None
    high: datetime | None = None
    asked: set[int] | None = None  # the only partitions asked for
    low_partition: int | None = None
    high_partition: int | None = None

    @classmethod
    def of(cls, filters: list[Filter]) -> Bounds:
        """Filters on other columns, of other kinds or with NULL bound nothing."""
        out = cls()
        for f in filters:
            path, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if path == ("event_time",) and isinstance(value, datetime):
                out._time(f, _utc(value))
            elif path == ("offset", "partition_id"):
                out._partition(f, value)
        return out

    def _time(self, f: Filter, at: datetime) -> None:
        if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
            self.low = at if self.low is None else max(self.low, at)
        if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
            self.high = at if self.high is None else min(self.high, at)

    def _partition(self, f: Filter, number: int | tuple | None) -> None:
        values = set(f.value) if isinstance(f, In) else {number} if isinstance(f, EqualTo) else None
        if values is not None:
            self.asked = values if self.asked is None else self.asked & values
        elif isinstance(f, GreaterThan | GreaterThanOrEqual) and number is not None:
            self.low_partition = number if self.low_partition is None else max(self.low_partition, number)
        elif isinstance(f, LessThan | LessThanOrEqual) and number is not None:
            self.high_partition = number if self.high_partition is None else min(self.high_partition, number)

    def has_partition(self, p: int) -> bool:
        if self.asked is not None and p not in self.asked:
            return False
        above = self.low_partition is None or p >= self.low_partition
        return above and (self.high_partition is None or p <= self.high_partition)

    def overlaps(self, first: datetime, last: datetime) -> bool:
        """Whether a row with an event time from ``first`` to ``last`` may be asked for."""
        after = self.low is None or _utc(last) >= self.low
        return after and (self.high is None or _utc(first) <= self.high)


class Source(ABC):
    """What a user writes. Instances are made on the driver and in tasks, from the same options."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[int]:
        """The active partitions; one, numbered 0, by default."""
        return [0]

    def total_partitions(self) -> int | None:
        """How many partitions there are in all, if known."""
        return None

    def first(self, partition: int) -> int:
        return 0

    @abstractmethod
    def latest(self, partition: int) -> int:
        """One past the last offset number that can be read now."""

    @abstractmethod
    def read(self, partition: int, start: int, end: int) -> Iterator[SourceRow]:
        """The rows at offset numbers start..end-1, in order."""

    def prune(self, partition: int, start: int, end: int, bounds: Bounds) -> list[tuple[int, int]]:
        """The offset ranges within start..end-1 that may hold rows within ``bounds``; all by default.

        A row without an event time counts as one of year 1 (``MISSING_TIME``).
        """
        return [(start, end)]

    def ack(self, partition: int, end: int) -> None:
        """Everything before ``end`` has been processed."""

    def acked(self, partition: int) -> int | None:
        """The last acknowledged end, if the source keeps it; None if unknown."""
        return None


class _Slice(InputPartition):
    def __init__(self, partition: int, start: int, end: int) -> None:
        self.partition, self.start, self.end = partition, start, end


def _slices(ranges: list[tuple[int, int, int]], rows_per_task: int) -> list[_Slice]:
    return [
        _Slice(p, at, min(at + rows_per_task, end))
        for p, start, end in sorted(ranges)
        for at in range(start, end, rows_per_task)
    ]


def _read(source: Source, part: _Slice):
    from pyspark.sql.pandas.types import to_arrow_schema

    def rows() -> Iterator[dict]:
        for number, r in enumerate(source.read(part.partition, part.start, part.end), start=part.start):
            offset = r.offset if r.offset is not None else str(number).encode()
            yield {
                "id": f"{part.partition}-{number}",
                "keys": r.keys or [],
                "value": r.payload or b"",
                "event_time": r.event_time or MISSING_TIME,
                "headers": r.headers or {},
                "user_metadata": r.user_metadata or {},
                "offset": {"offset": offset, "partition_id": part.partition},
            }

    yield from scan.to_batches(rows(), to_arrow_schema(SCHEMA))


class _Reader(DataSourceReader):
    def __init__(self, make, rows_per_task: int) -> None:
        self.make, self.rows_per_task = make, rows_per_task

    def _ranges(self, source: Source) -> list[tuple[int, int, int]]:
        return [(p, source.first(p), source.latest(p)) for p in source.partitions()]

    def partitions(self):
        ranges = self._ranges(self.make())
        return _slices(ranges, self.rows_per_task) or [_Slice(0, 0, 0)]

    def read(self, partition):
        if partition.start == partition.end:
            return
        yield from _read(self.make(), partition)


class _PruningReader(_Reader):
    bounds = Bounds()

    def pushFilters(self, filters):
        self.bounds = Bounds.of(filters)
        return filters

    def _ranges(self, source: Source) -> list[tuple[int, int, int]]:
        out = []
        for p in filter(self.bounds.has_partition, source.partitions()):
            asked = source.prune(p, source.first(p), source.latest(p), self.bounds)
            out += [(p, start, end) for start, end in asked if start < end]
        return out


class _StreamReader(DataSourceStreamReader):
    def __init__(self, make, rows_per_task: int, num_records: int | None) -> None:
        self.make, self.rows_per_task, self.num_records = make, rows_per_task, num_records
        self.source: Source | None = None
        self.position: dict[int, int] = {}

    def _source(self) -> Source:
        if self.source is None:
            self.source = self.make()
        return self.source

    def initialOffset(self) -> dict:
        source = self._source()
        return {str(p): source.first(p) for p in source.partitions()}

    def latestOffset(self) -> dict:
        """The end of the next micro-batch: at most ``num_records`` more per partition.

        Spark asks before it tells where it resumes. Until then an acknowledged end is at most one
        batch behind, hence twice the limit; without one the partition must be new.
        """
        source = self._source()
        out = {}
        for p in source.partitions():
            end = source.latest(p)
            if self.num_records is not None:
                acked = source.acked(p)
                if p in self.position:
                    limit = self.position[p] + self.num_records
                elif acked is not None:
                    limit = acked + 2 * self.num_records
                else:
                    limit = source.first(p) + self.num_records
                end = min(end, limit)
            out[str(p)] = max(end, self.position.get(p, end))
        return out

    def partitions(self, start: dict, end: dict):
        source = self._source()
        ranges = {int(p): (start[p] if p in start else source.first(int(p)), n) for p, n in end.items()}
        for p, (low, high) in ranges.items():
            if high < low:
                raise ValueError(f"partition {p} resumes at {low}: num_records needs a source that keeps acknowledgements")
        self.position = {p: stop for p, (_, stop) in ranges.items()}
        return _slices([(p, *r) for p, r in ranges.items()], self.rows_per_task)

    def read(self, partition):
        yield from _read(self.make(), partition)

    def commit(self, end: dict) -> None:
        for p, n in end.items():
            self._source().ack(int(p), n)


def register_source(spark: SparkSession, name: str, source: type[Source]) -> None:
    """Make ``source`` readable as ``spark.read.format(name)`` and ``spark.readStream.format(name)``.

    Options: ``num_records`` (most rows per partition and micro-batch; use a repeating trigger with
    it) and ``rows_per_task``; all options are passed to the source.
    """
    batch_reader = _PruningReader if spark.conf.get(PUSHDOWN, "false") == "true" else _Reader

    class UserSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self):
            return SCHEMA

        def _setup(self):
            options = dict(self.options)
            rows = int(options.get("rows_per_task", 1_000_000))
            limit = options.get("num_records")
            limit = None if limit is None else int(limit)
            if limit is not None and limit < 1:
                raise ValueError("num_records must be positive")
            return (lambda: source(options)), rows, limit

        def reader(self, schema):
            make, rows, _ = self._setup()
            return batch_reader(make, rows)

        def streamReader(self, schema):
            make, rows, limit = self._setup()
            return _StreamReader(make, rows, limit)

    spark.dataSource.register(UserSource)


def pending(source: Source) -> int:
    """Unread rows over all partitions; negative when the source does not know what was acknowledged."""
    total = 0
    for p in source.partitions():
        at = source.acked(p)
        if at is None:
            return UNKNOWN
        total += source.latest(p) - at
    return total


def describe(spark: SparkSession, source: Source) -> DataFrame:
    """One row: pending count, active partitions and total partitions."""
    row = (pending(source), source.partitions(), source.total_partitions())
    return spark.createDataFrame([row], "pending bigint, partitions array<int>, total_partitions int")


class FileAcks:
    """Acknowledged ends kept as one small JSON file per partition, on a path the driver can write."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def _path(self, partition: int) -> str:
        return f"{self.folder}/{partition}.json"

    def ack(self, partition: int, end: int) -> None:
        import os

        os.makedirs(self.folder, exist_ok=True)
        with open(f"{self._path(partition)}.new", "w") as f:
            json.dump(end, f)
        os.replace(f"{self._path(partition)}.new", self._path(partition))

    def acked(self, partition: int) -> int | None:
        try:
            with open(self._path(partition)) as f:
                return json.load(f)
        except FileNotFoundError:
            return None
