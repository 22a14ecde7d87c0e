"""Reading tables as streams, and running a stream to its current end."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from msgflow.session import SETTINGS, shared_dir
from msgflow.sources.tables import utc_schema

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_PARTITIONS = "spark.sql.shuffle.partitions"


def read_parquet_stream(spark: SparkSession, folder: str, *, files: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files of a folder as a stream, at most ``files_per_batch`` per micro-batch."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = utc_schema(spark.read.option("pathGlobFilter", files).parquet(folder).schema)
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def read_table_stream(spark: SparkSession, base: str, name: str, **options) -> DataFrame:
    """Table ``name`` of ``base`` as a stream, be it one file or a folder of them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getFileStatus(path).isDirectory():
        return read_parquet_stream(spark, f"{base}/{name}.parquet", **options)
    return read_parquet_stream(spark, base, files=f"{name}.parquet", **options)


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """RocksDB state, with as many state partitions as the cluster has cores unless told otherwise.

    A query keeps its number of state partitions for life, so size it for the cluster it will run on.
    """
    old = {k: spark.conf.get(k, None) for k in (_PROVIDER, _PARTITIONS)}
    spark.conf.set(_PROVIDER, SETTINGS[_PROVIDER])
    spark.conf.set(_PARTITIONS, partitions or spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def run_to_table(
    df: DataFrame, *, output_mode: str = "append", partitions: int | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Process what the source holds now and return the output as a batch table in the shared folder."""
    spark = df.sparkSession
    folder = shared_dir(spark, "stream")
    with state_settings(spark, partitions):
        started = (
            df.writeStream.format("parquet")
            .outputMode(output_mode)
            .option("checkpointLocation", checkpoint or f"{folder}/checkpoint")
            .option("path", f"{folder}/data")
            .trigger(availableNow=True)
            .start()
        )
        started.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/data")


def run_each_batch(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    output_mode: str = "append",
    partitions: int | None = None,
) -> None:
    """Process what the source holds now, giving each micro-batch to ``write``."""
    with state_settings(df.sparkSession, partitions):
        started = (
            df.writeStream.foreachBatch(write)
            .outputMode(output_mode)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        started.awaitTermination()
