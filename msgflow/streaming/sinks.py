"""Writing a stream to its sinks: one pass per micro-batch, idempotent per batch, with redelivery."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow.message import Datum, Response, row_function
from msgflow.operators import envelope as E
from msgflow.operators import scan
from msgflow.operators import sinks as SK
from msgflow.operators.group_handlers import _Async, _is_async
from msgflow.operators.handlers import ERROR, error_value, is_capture, iterate

_RESPONSE = [
    T.StructField("status", T.StringType()),
    T.StructField("err_msg", T.StringType()),
    T.StructField("payload", T.BinaryType()),
    T.StructField("message", E.MESSAGE),
]


def sink_handler(df: DataFrame, handler: Any, *, on_error: str = "fail", container: str = "sink") -> DataFrame:
    """``handler(datums) -> responses``, plain or async, once per Arrow batch; rows keep all columns.

    Each id must get exactly one response. With ``on_error="capture"`` the answers given before a failure count; rows
    without one become failures, and carry the ``error``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    call = row_function(handler)
    capture = is_capture(on_error)
    out_type = T.StructType([*df.schema.fields, *_RESPONSE, *([T.StructField("error", ERROR)] if capture else [])])
    arrow = to_arrow_schema(out_type)

    def answer(rows: list[dict], answers: dict[str, Response], loop: scan.Loop) -> None:
        items = iter([Datum(r) for r in rows])
        known = {r["id"] for r in rows}
        for r in iterate(call(_Async(items) if _is_async(call) else items), loop):
            if r.id in answers:
                raise ValueError(f"two responses for id {r.id}")
            if r.id not in known:
                raise ValueError(f"a response for id {r.id}, which no row has")
            answers[r.id] = r
        if len(answers) != len(rows):
            raise ValueError(f"{len(rows)} rows got responses for {len(answers)} ids")

    def produce(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        with scan.Loop() as loop:
            for batch in batches:
                rows = batch.to_pylist()
                answers: dict[str, Response] = {}
                error = None
                try:
                    answer(rows, answers, loop)
                except Exception as exc:
                    if not capture:
                        raise
                    error = error_value(exc, container)
                for row in rows:
                    if row["id"] in answers:
                        yield {**row, **_flat(answers[row["id"]])}
                    else:
                        yield {**row, **_flat(Response.failure(row["id"], error["message"])), "error": error}

    return df.mapInArrow(lambda batches: scan.to_batches(produce(batches), arrow), out_type)


def _flat(r: Response) -> dict:
    m = r.message
    message = None if m is None else {n: getattr(m, n) for n in E.MESSAGE.names}
    return {"status": r.status, "err_msg": r.err_msg, "payload": r.payload, "message": message}


def stage(responded: DataFrame, batch_id: int, path: str) -> DataFrame:
    """Write the rows of a micro-batch by destination, in one pass, and read them back.

    A replayed batch overwrites its own folder. Whatever follows reads the folder, so handlers run
    once however many destinations there are, and a lost executor cannot change the answers.
    """
    folder = f"{path}/batch_id={batch_id}"
    routed = SK.destinations(responded)
    routed.write.mode("overwrite").partitionBy("destination").parquet(folder)
    return responded.sparkSession.read.schema(routed.schema).parquet(folder)


def sink_batches(
    respond: Callable[[DataFrame], DataFrame],
    path: str,
    writers: Mapping[str, Callable[[DataFrame, int], None]] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: respond, stage by destination, then call the writers given.

    Writers get the rows of their destination and the batch id, by which they should be idempotent.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        staged = stage(respond(batch), batch_id, path)
        for destination, writer in (writers or {}).items():
            writer(staged.filter(F.col("destination") == destination), batch_id)

    return write


def log_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: one line of text per row."""

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = batch.select(SK.log_text().alias("value"))
        lines.write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write


# Redelivery --------------------------------------------------------------------


def with_redelivery(
    process: Callable[[DataFrame, int], DataFrame], path: str
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that gives rows refused in one batch to the next one again.

    ``process(rows, batch_id)`` gets new and returned rows together, with ``attempt`` (0 for new
    ones), and returns the refused ones. They are kept per batch in ``path``; a replayed batch reads
    the same returned rows and overwrites its own refusals. A batch commits, and so acknowledges its
    offsets, only after that.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("attempt", F.lit(0))
        if batch_id > 0:
            rows = returned(batch.sparkSession, path, batch_id - 1, rows.schema).unionByName(rows)
        refused = process(rows, batch_id)
        again = refused.withColumn("attempt", F.col("attempt") + 1).select(*rows.columns)
        again.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def returned(spark: SparkSession, path: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """Rows that batch ``batch_id`` refused."""
    return spark.read.schema(schema).parquet(f"{path}/batch_id={batch_id}")
