"""Outside row shapes as envelope rows: Kafka records, posted rows and generated rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.operators import envelope as E


def from_kafka(records: DataFrame, *, keep: Iterable[str] = ()) -> DataFrame:
    """Rows of Spark's Kafka source, read with ``includeHeaders``. A repeated header keeps its last value."""
    keys = F.when(F.col("key").isNotNull(), E.strings(F.decode("key", "UTF-8")))
    pairs = F.transform(
        "headers", lambda h: F.struct(h["key"].alias("key"), F.decode(h["value"], "UTF-8").alias("value"))
    )
    last = F.filter(
        pairs, lambda h, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda later: later["key"] == h["key"])
    )
    return E.to_envelope(
        records,
        keep=keep,
        id=F.concat_ws("-", "topic", "partition", "offset"),
        keys=keys,
        value=F.col("value"),
        event_time=F.col("timestamp"),
        headers=F.map_from_entries(F.coalesce(last, F.array().cast("array<struct<key:string,value:string>>"))),
        offset=F.struct(
            F.col("offset").cast("string").cast("binary").alias("offset"), F.col("partition").alias("partition_id")
        ),
    )


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """The stream form; needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic, "includeHeaders": "true", **options}
    )
    return from_kafka(reader.load())


POSTED = "body binary, headers map<string,string>"


def from_posted(
    rows: DataFrame, *, time_header: str, key_header: str | None = None, id_header: str | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Rows posted from outside: the event time is in a header, as epoch milliseconds."""
    millis = E.header(time_header).try_cast("bigint")
    fields = {"value": F.col("body"), "headers": F.col("headers"), "event_time": F.timestamp_millis(millis)}
    if key_header:
        fields["keys"] = F.when(E.header(key_header).isNotNull(), E.strings(E.header(key_header)))
    if id_header:
        fields["id"] = E.header(id_header)
    return E.to_envelope(rows, keep=keep, **fields)


def read_posted_stream(spark: SparkSession, path: str, *, time_header: str, files_per_batch: int = 100, **options) -> DataFrame:
    """Posted rows dropped as JSON files (base64 body); at most ``files_per_batch`` per batch."""
    reader = spark.readStream.schema(POSTED).option("maxFilesPerTrigger", files_per_batch)
    return from_posted(reader.json(path), time_header=time_header, **options)


def _generated(rows: DataFrame, number: str, time, size: int) -> DataFrame:
    text = F.rpad(F.col(number).cast("string"), size, "x")
    return E.to_envelope(
        rows,
        id=F.col(number).cast("string"),
        value=text.cast("binary"),
        event_time=time,
        offset=F.struct(F.col(number).cast("string").cast("binary").alias("offset"), F.lit(0).alias("partition_id")),
    )


def generate(spark: SparkSession, n: int, *, per_second: int, size: int = 8, start: str = "1970-01-01") -> DataFrame:
    """A batch of ``n`` generated messages of ``size`` bytes, ``per_second`` to each second of event time."""
    micros = F.floor(F.col("id") * 1_000_000 / per_second).cast("bigint")
    begin = F.unix_micros(F.lit(start).cast("timestamp"))
    return _generated(spark.range(n), "id", F.timestamp_micros(begin + micros), size)


def generate_stream(spark: SparkSession, *, per_second: int, size: int = 8) -> DataFrame:
    rate = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return _generated(rate, "value", F.col("timestamp"), size)
