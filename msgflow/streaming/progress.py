"""Watermark progress of idle streams, and the record of errors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.operators import errors as ER
from msgflow.operators.watermarks import after_watermark

HEARTBEAT = "heartbeat"


def clock(spark: SparkSession, threshold: str, *, per_second: int = 1) -> DataFrame:
    """Heartbeat rows whose event time is the wall clock less ``threshold``."""
    beats = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return beats.select((F.col("timestamp") - F.expr(f"interval {threshold}")).alias("event_time"))


def with_heartbeats(df: DataFrame, beats: DataFrame, delay: str, *, time: str = "event_time") -> DataFrame:
    """Merge heartbeats into a stream and set its watermark.

    Spark's watermark moves only on rows, so an idle source would hold windows open; heartbeats move
    it instead. Use them for sources whose event time follows the clock of the heartbeats to within
    the threshold: a source further behind would find its rows late. Follow with
    :func:`drop_heartbeats`.
    """
    marked = beats.select(F.col("event_time").alias(time)).withColumn(HEARTBEAT, F.lit(True))
    merged = df.withColumn(HEARTBEAT, F.lit(False)).unionByName(marked, allowMissingColumns=True)
    return merged.withWatermark(time, delay)


def drop_heartbeats(df: DataFrame, *, time: str = "event_time") -> DataFrame:
    return df.filter(after_watermark(~F.col(HEARTBEAT), time=time)).drop(HEARTBEAT)


def record_first_errors(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for error rows: keep the first critical error of each container.

    One row per container and run is small, so the containers on record are looked up by a join that
    Spark sizes itself. A replayed batch overwrites its own record.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        first = ER.first_critical(batch)
        if batch_id > 0:
            recorded = batch.sparkSession.read.schema(f"{ER.SCHEMA}, batch_id bigint").parquet(path)
            known = recorded.filter(F.col("batch_id") < batch_id).select("container")
            first = first.join(known, "container", "left_anti").select(*first.columns)
        first.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return each
