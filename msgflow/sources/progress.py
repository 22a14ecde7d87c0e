"""Source progress: which partitions exist, how far they go and how much of them is unread."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = -1  # a backlog that the source cannot tell


def partitions(df: DataFrame) -> DataFrame:
    """The partitions that hold rows."""
    return df.select(F.col("offset.partition_id").alias("partition_id")).distinct()


def _number():
    return F.decode("offset.offset", "UTF-8").cast("bigint")


def offsets(df: DataFrame) -> DataFrame:
    """Row count and last offset per partition, for offsets that are numbers in text."""
    return df.groupBy(F.col("offset.partition_id").alias("partition_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(_number()).alias("last_offset")
    )


def backlog(df: DataFrame, committed: DataFrame) -> DataFrame:
    """Row count, last offset and rows after the committed offset, per partition, in one pass.

    ``committed`` has (partition_id, committed), one row per partition; a partition without a row
    there is unread, and one with a NULL offset has an unknown backlog.
    """
    rows = df.select(F.col("offset.partition_id").alias("partition_id"), _number().alias("_n"))
    known = committed.select("partition_id", F.col("committed"), F.lit(True).alias("_seen"))
    joined = rows.join(known, "partition_id", "left")
    unread = F.col("_seen").isNull() | (F.col("_n") > F.col("committed"))
    counted = joined.groupBy("partition_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max("_n").alias("last_offset"),
        F.count_if(unread).alias("_unread"),
        F.bool_or(F.col("_seen").isNotNull() & F.col("committed").isNull()).alias("_unknown"),
    )
    return counted.select(
        "partition_id",
        "n_rows",
        "last_offset",
        F.when(F.col("_unknown"), F.lit(UNKNOWN).cast("bigint")).otherwise(F.col("_unread")).alias("pending"),
    )


def pending(df: DataFrame, committed: DataFrame) -> DataFrame:
    """Rows after the committed offset, per partition; see ``backlog``."""
    return backlog(df, committed).select("partition_id", "pending")
