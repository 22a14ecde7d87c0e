"""Table scans. Time columns without a zone are read as UTC instants, so time filters push down."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def utc_schema(schema: T.StructType) -> T.StructType:
    """The schema with TIMESTAMP in place of zone-less timestamps."""
    return T.StructType(
        [
            T.StructField(f.name, T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType, True)
            for f in schema
        ]
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A batch scan. The session time zone becomes UTC, in which all times here are understood."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = utc_schema(spark.read.parquet(path).schema)
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{base}/{name}.parquet")
