"""Error rows: what a failed row or handler leaves behind, and the first critical error of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow import constants as C

SCHEMA = "container string, timestamp bigint, code string, message string, details string"


def error_columns(
    message: Column,
    *,
    timestamp: Column,
    details: Column | None = None,
    code: str = C.INTERNAL_ERROR_CODE,
    container: str = C.DEFAULT_CONTAINER,
) -> list[Column]:
    return [
        F.lit(container).alias("container"),
        timestamp.cast("bigint").alias("timestamp"),
        F.lit(code or C.INTERNAL_ERROR_CODE).alias("code"),
        message.alias("message"),
        (details if details is not None else F.lit(None)).cast("string").alias("details"),
    ]


def capture(df: DataFrame, failed: Column, message: Column, *, timestamp: Column, **fields) -> tuple[DataFrame, DataFrame]:
    """(good rows, error rows): rows that meet ``failed`` are described instead of failing the query."""
    bad = F.coalesce(failed, F.lit(False))
    return df.filter(~bad), df.filter(bad).select(*error_columns(message, timestamp=timestamp, **fields))


def fail_fast(df: DataFrame, failed: Column, message: Column, *, column: str = "value") -> DataFrame:
    """Abort the query on the first row that meets ``failed``."""
    checked = F.when(F.coalesce(failed, F.lit(False)), F.raise_error(message).cast(df.schema[column].dataType))
    return df.withColumn(column, checked.otherwise(F.col(column)))


def first_critical(errors: DataFrame) -> DataFrame:
    """The first error per container; later ones are not recorded. Ties go by message."""
    first = F.min(F.struct("timestamp", "message", "code", "details"))
    return errors.groupBy("container").agg(first.alias("_e")).select(
        "container", "_e.timestamp", "_e.code", "_e.message", "_e.details"
    )
