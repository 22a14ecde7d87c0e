"""The message envelope: building, validating and rewriting message rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow import constants as C
from msgflow.functions import metadata as M

_METADATA = T.MapType(T.StringType(), T.MapType(T.StringType(), T.BinaryType()))
OFFSET = T.StructType([T.StructField("offset", T.BinaryType()), T.StructField("partition_id", T.IntegerType())])

ENVELOPE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("keys", T.ArrayType(T.StringType())),
        T.StructField("value", T.BinaryType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("watermark", T.TimestampType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("user_metadata", _METADATA),
        T.StructField("system_metadata", _METADATA),
        T.StructField("previous_vertex", T.StringType()),
        T.StructField("offset", OFFSET),
    ]
)

# What a map-like handler may return for one output row.
MESSAGE = T.StructType([ENVELOPE[n] for n in ("keys", "value", "tags", "user_metadata")])


def strings(*items: str | Column) -> Column:
    """An ARRAY<STRING> from literals and columns."""
    return F.array(*[i if isinstance(i, Column) else F.lit(i) for i in items]).cast("array<string>")


def missing_event_time() -> Column:
    return F.lit(C.MISSING_EVENT_TIME).cast("timestamp")


_DEFAULTS = {
    "keys": strings,
    "value": lambda: F.lit(b""),
    "event_time": missing_event_time,
    "headers": lambda: F.create_map().cast("map<string,string>"),
    "tags": strings,
    "user_metadata": M.empty_metadata,
    "system_metadata": M.empty_metadata,
}


def to_envelope(df: DataFrame, *, keep: Iterable[str] = (), **fields: Column) -> DataFrame:
    """Build envelope rows; fields that are not given, or are NULL, take their defaults.

    ``keep`` names typed columns of ``df`` that ride beside the envelope, so that analytics read
    them directly instead of decoding payload bytes.
    """
    unknown = set(fields) - set(ENVELOPE.names)
    if unknown:
        raise TypeError(f"not envelope fields: {sorted(unknown)}")
    out = []
    for field in ENVELOPE:
        given = fields.get(field.name)
        default = _DEFAULTS.get(field.name)
        if given is None:
            col = default() if default else F.lit(None)
        else:
            given = given.cast(field.dataType)
            col = F.coalesce(given, default()) if default else given
        out.append(col.cast(field.dataType).alias(field.name))
    return df.select(*out, *keep)


def with_default_offset(df: DataFrame, offset: Column, partition_id: int | Column = 0) -> DataFrame:
    """Set the offset column; the partition defaults to 0."""
    part = partition_id if isinstance(partition_id, Column) else F.lit(partition_id)
    return df.withColumn(
        "offset", F.struct(offset.cast("binary").alias("offset"), part.cast("int").alias("partition_id"))
    )


def validate(df: DataFrame) -> DataFrame:
    """Check envelope column types now (TypeError) and array elements at run time (query error)."""
    for field in df.schema:
        if field.name in ENVELOPE.names:
            expected = ENVELOPE[field.name].dataType
            if field.dataType.simpleString() != expected.simpleString():
                raise TypeError(
                    f"{field.name} must be {expected.simpleString()}, not {field.dataType.simpleString()}"
                )
    for name in ("keys", "tags"):
        if name in df.columns:
            bad = F.coalesce(F.exists(name, lambda x: x.isNull()), F.lit(False))
            df = df.withColumn(
                name,
                F.when(bad, F.raise_error(F.lit(f"{name} must hold only strings")).cast("array<string>")).otherwise(
                    F.col(name)
                ),
            )
    return df


def is_valid(df: DataFrame) -> Column:
    """Row condition behind :func:`validate`, for splitting bad rows off instead of failing."""
    checks = [
        ~F.coalesce(F.exists(n, lambda x: x.isNull()), F.lit(False)) for n in ("keys", "tags") if n in df.columns
    ]
    out = F.lit(True)
    for c in checks:
        out = out & c
    return out


def message(
    value: Column,
    keys: Column | None = None,
    tags: Column | None = None,
    user_metadata: Column | None = None,
) -> Column:
    """One output message as a struct. Keys, tags and metadata start empty: inputs are not inherited."""
    return F.struct(
        F.coalesce(keys if keys is not None else strings(), strings()).alias("keys"),
        F.coalesce(value.cast("binary"), F.lit(b"")).alias("value"),
        F.coalesce(tags if tags is not None else strings(), strings()).alias("tags"),
        F.coalesce(user_metadata if user_metadata is not None else M.empty_metadata(), M.empty_metadata()).alias(
            "user_metadata"
        ),
    )


def drop_message() -> Column:
    return message(F.lit(b""), tags=strings(C.DROP))


def to_drop(df: DataFrame, condition: Column) -> DataFrame:
    """Mark the rows that meet ``condition`` as dropped; their event time stays."""
    hit = F.coalesce(condition, F.lit(False))

    def swap(name: str, col: Column) -> Column:
        return F.when(hit, col).otherwise(F.col(name))

    return df.withColumns(
        {
            "value": swap("value", F.lit(b"")),
            "keys": swap("keys", strings()),
            "tags": swap("tags", strings(C.DROP)),
        }
    )


def is_dropped() -> Column:
    return F.array_contains("tags", C.DROP)


def drop_marked(df: DataFrame) -> DataFrame:
    return df.filter(~is_dropped())


def rekey(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.withColumn("keys", strings(*keys))


def with_tags(df: DataFrame, tags: Column) -> DataFrame:
    return df.withColumn("tags", F.coalesce(tags, strings()))


def from_datum(
    df: DataFrame, *, value: Column | None = None, keys: Column | None = None, tags: Column | None = None
) -> DataFrame:
    """Copy rows to the output, overriding some fields; tags start empty."""
    return df.withColumns(
        {
            "value": F.coalesce(value, F.col("value")) if value is not None else F.col("value"),
            "keys": F.coalesce(keys, F.col("keys")) if keys is not None else F.col("keys"),
            "tags": F.coalesce(tags, strings()) if tags is not None else strings(),
        }
    )


def header(name: str) -> Column:
    return F.try_element_at("headers", F.lit(name))


# Message lists: ARRAY<STRUCT> columns -----------------------------------------


def messages(*items: Column) -> Column:
    return F.array(*items)


def messages_len(items: Column | str) -> Column:
    return F.size(items)


def message_at(items: Column | str, index: int) -> Column:
    """Zero-based access; negative counts from the end. Out of range is an error."""
    return F.element_at(items, index + 1 if index >= 0 else index)


def messages_append(items: Column | str, item: Column) -> Column:
    return F.array_append(items, item)
