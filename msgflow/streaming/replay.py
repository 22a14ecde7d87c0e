"""Replaying a table as a stream of several micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.session import shared_dir
from msgflow.streaming.run import read_parquet_stream


SMALL, LARGE = 20_000, 2_000_000  # rows of a file: fewer are not worth a task, more are too many for one


def replay(df: DataFrame, parts: list[Column]) -> DataFrame:
    """The rows of ``df`` as a stream: one micro-batch for the rows of each condition, in this order.

    A part is written, and so visible to the stream, after the parts before it. All parts have the same number of files, which
    the stream takes together: one where they are small, else as many as keep all cores busy, with at most some ``LARGE``
    rows each. A part with fewer rows than files gets empty ones. Rows that no condition takes are left out.
    """
    spark = df.sparkSession
    folder = shared_dir(spark, "replay")
    most = max(df.agg(*[F.count_if(part) for part in parts]).first(), default=0)
    files = max(1, min(-(-most // SMALL), max(spark.sparkContext.defaultParallelism, -(-most // LARGE))))
    before = 0
    for part in parts:
        rows = df.filter(part)
        (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.mode("append").parquet(folder)
        written = _count_files(spark, folder)
        for _ in range(before + files - written):
            df.limit(0).coalesce(1).write.mode("append").parquet(folder)
        before += files
    return read_parquet_stream(spark, folder, files_per_batch=files)


def _count_files(spark: SparkSession, folder: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sum(1 for f in files if f.getPath().getName().endswith(".parquet"))


def time_slices(df: DataFrame, time: str, n: int) -> list[Column]:
    """Conditions that cut the rows into ``n`` consecutive spans of ``time``, about equal in length. Null times go first."""
    low, high = df.agg(F.min(F.unix_micros(time)), F.max(F.unix_micros(time))).first()
    if low is None:
        return [F.lit(True)]
    at = F.coalesce(F.floor((F.unix_micros(time) - low) * n / F.lit(high - low + 1)), F.lit(0))
    return [at == i for i in range(n)]
