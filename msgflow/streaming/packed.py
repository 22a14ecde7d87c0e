"""Many keys in one group of a stateful operator, and many rows in one of its output rows.

Every group of ``transformWithState`` costs some ten calls between Python and the JVM and an Arrow batch of its own, whatever
its size. So keys are dealt into a fixed number of buckets by their hash: a group is a bucket, its state one value with the
state of each of its keys, its output a few packed rows that :func:`unpack` opens again. Keys stay apart inside the bucket.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow.operators.scan import MAX_BYTES

PLACE = "_place"
BUCKETS = 1024
PACKED = T.StructType([T.StructField("packed", T.BinaryType())])
CHUNK = 4096  # rows in a packed row, and rows or keys that share one turn of an event loop


def bucket(buckets: int) -> Column:
    """The bucket of a row's keys."""
    return F.pmod(F.xxhash64("keys"), F.lit(buckets))


def pack(rows: Iterable[tuple]) -> Iterator[bytes]:
    """Rows (window start and end in microseconds, then the other columns), many in one value."""
    return map(pickle.dumps, chunks(rows))


def chunks(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    """At most CHUNK rows or some MAX_BYTES of payload at a time."""
    chunk: list[tuple] = []
    held = 0
    for row in rows:
        chunk.append(row)
        held += sum(len(v) for v in row if isinstance(v, bytes | bytearray))
        if len(chunk) >= CHUNK or held >= MAX_BYTES:
            yield chunk
            chunk, held = [], 0
    if chunk:
        yield chunk


def unpack(df: DataFrame, out_type: T.StructType) -> DataFrame:
    """The packed rows of ``df`` opened; the first column of ``out_type`` is the window."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out_type)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = itertools.chain.from_iterable(batch.column("packed") for batch in batches)
        for chunk in chunks(itertools.chain.from_iterable(pickle.loads(p.as_py()) for p in packed)):
            start, end, *others = zip(*chunk, strict=True)
            bounds = arrow.field(0).type
            window = pa.StructArray.from_arrays(
                [pa.array(v, type=bounds.field(i).type) for i, v in enumerate((start, end))], fields=[bounds.field(0), bounds.field(1)]
            )
            columns = [pa.array(v, type=f.type) for v, f in zip(others, list(arrow)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([window, *columns], schema=arrow)

    return df.mapInArrow(opened, out_type)
