"""The catalogue of named queries: a Spark function each, and the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.functions import scalars as S
from msgflow.operators import envelope as E
from msgflow.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def time_text(col: Column | str) -> Column:
    return F.date_format(col, TIME_FORMAT)


def cents(col: Column | str = "value") -> Column:
    """Money-like doubles as whole cents, so that sums do not depend on their order."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * 100).cast("bigint")


def event_messages(spark: SparkSession, base: str, *keep: str) -> DataFrame:
    """The events table as envelope rows keyed by event type; typed columns ride along."""
    events = read_table(spark, base, "events")
    events = events.withColumn("cents", cents())
    return E.to_envelope(
        events,
        keep=keep,
        id=F.col("event_id").cast("string"),
        keys=E.strings(F.col("event_type")),
        value=S.text_to_bytes(F.col("cents").cast("string")),
        event_time=F.col("ts"),
        headers=F.create_map(F.lit("user"), F.col("user_id").cast("string")),
        offset=F.struct(
            F.col("event_id").cast("string").cast("binary").alias("offset"),
            (F.col("event_id") % 4).cast("int").alias("partition_id"),
        ),
    )
