"""Side inputs: small versioned values that every row of a stream can see.

A side input is a table ``(name, version, version_time, value, no_broadcast)``. Retrieval appends a
row; a ``no_broadcast`` row keeps the previous value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow import constants as C
from msgflow.operators import ordered as O

SCHEMA = "name string, version bigint, version_time timestamp, value binary, no_broadcast boolean"


def retrieve(
    spark: SparkSession, name: str, version: int, at: datetime, handler: Callable[[], bytes | None]
) -> DataFrame:
    """Call the retrieval function once; ``None`` means no broadcast. Append the row to the table."""
    value = handler()
    if value is not None and not isinstance(value, bytes | bytearray):
        raise TypeError(f"a side input value must be bytes, not {type(value).__name__}")
    return spark.createDataFrame([(name, version, at, value, value is None)], SCHEMA)


def latest(table: DataFrame) -> DataFrame:
    """The current value per side input: that of the highest version that was broadcast."""
    return (
        table.filter(~F.col("no_broadcast"))
        .groupBy("name")
        .agg(F.max_by("value", "version").alias("value"), F.max("version").alias("version"))
    )


def current(table: DataFrame, name: str) -> Column:
    """The current (value, version) as a scalar subquery; the initial value when nothing was broadcast."""
    last = table.filter((F.col("name") == name) & ~F.col("no_broadcast"))
    found = last.agg(F.max_by(F.struct("value", "version"), "version").alias("current")).scalar()
    initial = F.struct(
        F.encode(F.lit(C.NO_SIDE_INPUT), "UTF-8").alias("value"), F.lit(None).cast("bigint").alias("version")
    )
    return F.coalesce(found, initial)


def with_side_input(
    df: DataFrame, table: DataFrame, name: str, column: str = "side_input", version: str | None = None
) -> DataFrame:
    """Every row sees the current value, and its version if a column for it is named.

    The subquery runs once; the rows are not joined or shuffled.
    """
    seen = df.withColumn("_current", current(table, name)).withColumn(column, F.col("_current.value"))
    if version:
        seen = seen.withColumn(version, F.col("_current.version"))
    return seen.drop("_current")


def join_side_table(df: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """A keyed side input. No hint: Spark broadcasts the table when it measures it as small enough,
    and otherwise joins by shuffle with skew handling."""
    return df.join(table, list(on), "left")


def side_input_asof(
    df: DataFrame,
    versions: DataFrame,
    *,
    order: Sequence[str] = ("event_time", "id"),
    column: str = "side_input",
    **opts,
) -> DataFrame:
    """The value that was current at each row's event time, per side input name.

    ``df`` has ``name``. Versions and rows form one timeline per name, and the last version at or
    before a row is a running maximum along it, so neither side is broadcast or paired off.
    """
    time, *ties = order
    changes = versions.filter(~F.col("no_broadcast")).select(
        "name",
        F.col("version_time").alias(time),
        F.struct("version_time", "version", "value").alias("_version"),
        F.lit(False).alias("_is_row"),
    )
    line = df.withColumn("_is_row", F.lit(True)).unionByName(changes, allowMissingColumns=True)
    seen = O.running(line, ["name"], [time, *ties], {"_seen": O.Running("max", F.col("_version"))}, **opts)
    value = F.coalesce(F.col("_seen.value"), F.encode(F.lit(C.NO_SIDE_INPUT), "UTF-8"))
    return seen.filter("_is_row").select(*df.columns, value.alias(column), F.col("_seen.version").alias("version"))
