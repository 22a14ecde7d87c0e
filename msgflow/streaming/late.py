"""Late rows of a stream as an output, and the open windows of a stopped or running one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.functions.scalars import interval_micros


def late_batches(path: str, delay: str, *, time: str = "event_time") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes all rows to ``path``/rows, each with ``late`` and ``batch_id``.

    A row is late if its time is not above the watermark of the batches before it: their highest time, in whole
    milliseconds, less ``delay``. Each batch writes its watermark to ``path``/watermarks, one row; a replayed batch reads
    the same earlier ones and overwrites its own rows. Give it a stream without stateful steps before it: those would drop
    the late rows. A row without time is on time, and no row is late in the first batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = "watermark bigint, batch_id bigint"
        before = None
        if batch_id > 0:
            earlier = spark.read.schema(known).parquet(f"{path}/watermarks").filter(F.col("batch_id") < batch_id)
            before = earlier.agg(F.max("watermark")).first()[0]
        late = F.lit(False) if before is None else F.coalesce(F.unix_micros(time) <= F.lit(before), F.lit(False))
        rows = f"{path}/rows/batch_id={batch_id}"
        batch.withColumn("late", late).write.mode("overwrite").parquet(rows)
        highest = spark.read.schema(batch.schema).parquet(rows).agg(F.max(F.unix_micros(time)).alias("m"))
        mark = F.floor(F.col("m") / 1000) * 1000 - interval_micros(delay)
        highest.select(mark.cast("bigint").alias("watermark")).write.mode("overwrite").parquet(f"{path}/watermarks/batch_id={batch_id}")

    return write


def split_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(on-time rows, late rows) that :func:`late_batches` wrote, with their ``batch_id``."""
    rows = spark.read.parquet(f"{path}/rows")
    return rows.filter(~F.col("late")).drop("late"), rows.filter("late").drop("late")


def open_windows(spark: SparkSession, checkpoint: str, *, operator: int = 0, batch_id: int | None = None) -> DataFrame:
    """The windows that a windowed aggregation holds in its state: window, its other keys, and the aggregate's buffer.

    Read from the stream's checkpoint by Spark's state reader, at its last committed batch or at ``batch_id``: the windows
    that have rows and are not yet emitted. ``partition_id`` is the state partition.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select("key.*", F.col("value").alias("buffer"), "partition_id")
