"""Streams over several files: stream results equal batch results, late rows, redelivery, replay."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from msgflow.functions import scalars as S
from msgflow.message import Message, Response
from msgflow.operators import envelope as E
from msgflow.operators import reduce as RD
from msgflow.operators import sinks as SK
from msgflow.operators import watermarks as WM
from msgflow.session import ship_package
from msgflow.sources import custom
from msgflow.operators import errors as ER
from msgflow.operators import side_inputs as SI
from msgflow.sources import shapes
from msgflow.streaming import progress, run, sinks, stateful
from msgflow.streaming.side_inputs import with_refreshed_side_input
from tests.test_handlers import CountRows
from tests.test_tables import Fixed

# Times start at 1: Spark's first watermark is 0, and a row at or below the watermark is late.
END = 1_000_000  # a row this late in event time closes everything before it


@pytest.fixture(scope="module", autouse=True)
def ship(spark):
    ship_package(spark)


def files(spark, folder, *batches):
    """One file per micro-batch, in order; rows are (key, second)."""
    for i, batch in enumerate(batches):
        df = spark.createDataFrame([(f"{i}-{n}", *row) for n, row in enumerate(batch)], "id string, k string, s bigint")
        df.coalesce(1).write.parquet(f"{folder}/{i}")
        time.sleep(0.02)  # files are taken in order of their time
    raw = (
        spark.readStream.schema("id string, k string, s bigint")
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true")
        .parquet(str(folder))
    )
    rows = E.to_envelope(
        raw,
        keep=["s"],
        id=F.col("id"),
        keys=E.strings(F.col("k")),
        value=S.text_to_bytes(F.col("s").cast("string")),
        event_time=F.timestamp_seconds("s"),
    )
    return rows.withWatermark("event_time", "10 seconds")


def result(df):
    return run.run_to_table(df, partitions=2)


def test_reduce_over_batches_and_late_rows(spark, tmp_path):
    batches = [("a", 1), ("a", 2)], [("a", 70), ("b", 65)], [("b", 72)], [("a", 3)], [("z", END)]
    rows = files(spark, tmp_path, *batches)
    out = result(RD.reduce_window(rows, "1 minute", F.count(F.lit(1)).alias("n")))
    got = sorted((r["keys"][0], r.a, r.n) for r in out.select("keys", F.unix_seconds("window.start").alias("a"), "n").collect())
    # ("a", 3) arrives a batch after the one that closed its window: Spark drops it.
    assert got == [("a", 0, 2), ("a", 60, 1), ("b", 60, 2)]


def test_sorter_over_batches(spark, tmp_path):
    rows = files(spark, tmp_path, [("k", 30), ("k", 10)], [("k", 20), ("k", 40), ("j", 31)], [("z", END)])
    out = result(stateful.sort_stream(rows.select("keys", "event_time", "s"), ["keys"], ["event_time"], bucket="1 minute"))
    got = [r.s for r in out.filter("keys[0] = 'k'").orderBy("bucket_start", "pos").collect()]
    assert got == [10, 20, 30, 40] and out.count() == 5


def test_early_counter_over_batches(spark, tmp_path):
    rows = files(spark, tmp_path, [("k", i) for i in range(1, 5)], [("k", i) for i in range(5, 11)], [("z", END)])
    out = result(stateful.early_counter_stream(rows, "1 minute", threshold=2))
    got = [(r.emit, r.counter, r.final) for r in out.filter("keys[0] = 'k'").orderBy("emit").collect()]
    assert got == [(1, 3, False), (2, 3, False), (3, 3, False), (4, 1, True)]


def test_sessions_bridged_by_a_later_batch(spark, tmp_path):
    # 1..5 and 20..22 are two sessions until 12 arrives; 200 is another one.
    rows = files(spark, tmp_path, [("k", 1), ("k", 5)], [("k", 20), ("k", 22)], [("k", 12)], [("k", 200)], [("z", END)])
    out = result(stateful.session_handler_stream(rows.drop("s"), "10 seconds", CountRows))
    got = sorted(
        (r.a, r.b, bytes(r.value))
        for r in out.filter("keys[0] = 'k'")
        .select("value", F.unix_seconds("window.start").alias("a"), F.unix_seconds("window.end").alias("b"))
        .collect()
    )
    assert got == [(1, 32, b"5"), (200, 210, b"1")]


def test_reduce_handler_over_batches(spark, tmp_path):
    async def joined(keys, datums, window):
        return [Message(b",".join([d.value async for d in datums]), keys=keys)]

    rows = files(spark, tmp_path, [("k", 30), ("k", 10)], [("k", 20)], [("z", END)])
    out = result(stateful.reduce_handler_stream(rows, "1 minute", joined))
    assert [bytes(r.value) for r in out.collect()] == [b"10,20,30"]


class Total(stateful.StreamAccumulator):
    def __init__(self, start):
        self.total = start

    def add(self, datum):
        self.total += int(datum.value)
        self.keys = datum.keys
        return [Message(str(self.total).encode(), keys=datum.keys, watermark=datum.event_time)]

    def close(self):
        return [Message(b"closed at %d" % self.total, keys=self.keys)]


def test_accumulator_over_batches(spark, tmp_path):
    rows = files(spark, tmp_path, [("k", 1), ("k", 2)], [("k", 4)], [("j", 100)], [("k", 101)], [("z", END)])
    out = result(stateful.accumulate_stream(rows, Total, timeout="20 seconds", init_args=(0,)))
    got = [
        (r.pos, bytes(r.value), r.eof, r.e)
        for r in out.filter("keys[0] = 'k'").select("pos", "value", "eof", F.unix_seconds("window.end").alias("e")).collect()
    ]
    first = [(0, b"1", False, 1), (1, b"3", False, 2), (2, b"7", False, 4), (3, b"closed at 7", False, 4), (4, b"", True, 4)]
    second = [(0, b"101", False, 101), (1, b"closed at 101", False, 101), (2, b"", True, 101)]
    assert sorted(got) == sorted(first + second)


def test_stream_accumulator_must_be_one(spark, tmp_path):
    rows = files(spark, tmp_path, [("k", 1)])
    with pytest.raises(TypeError):
        stateful.accumulate_stream(rows, CountRows, timeout="1 minute")


def test_sink_batches_are_idempotent(spark, tmp_path):
    def answer(datums):
        for d in datums:
            yield Response.fallback(d.id) if int(d.value) % 2 else Response.success(d.id)

    seen = []
    write = sinks.sink_batches(
        lambda b: sinks.sink_handler(b, answer),
        str(tmp_path / "out"),
        {SK.FALLBACK_SINK: lambda df, n: seen.append((n, sorted(r.id for r in df.collect())))},
    )
    df = spark.range(6).select(F.col("id").cast("string").alias("id"), F.col("id").cast("string").cast("binary").alias("value"))
    write(df, 0)
    write(df, 0)  # a replay
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 6 and sorted(r.id for r in out.filter("destination = 'fallback'").collect()) == ["1", "3", "5"]
    assert seen == [(0, ["1", "3", "5"])] * 2


def test_sink_handler_checks_ids(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("id"), F.lit(b"x").alias("value"))
    for answer in (
        lambda datums: [Response.success(d.id) for d in datums][:-1],
        lambda datums: [Response.success("other") for d in datums],
    ):
        with pytest.raises(Exception, match="respon"):
            sinks.sink_handler(df.coalesce(1), answer).collect()


def test_redelivery(spark, tmp_path):
    rows = files(spark, tmp_path / "in", [("a", 1), ("bad", 2)], [("a", 3)], [("a", 4)])
    rows = rows.select("id", "keys", "s")
    seen = []

    def process(df, batch_id):
        seen.append((batch_id, sorted((r.s, r.attempt) for r in df.collect())))
        return df.filter("keys[0] = 'bad' and attempt < 1")

    write = sinks.with_redelivery(process, str(tmp_path / "retry"))
    run.run_each_batch(rows, write, str(tmp_path / "checkpoint"))
    assert seen == [(0, [(1, 0), (2, 0)]), (1, [(2, 1), (3, 0)]), (2, [(4, 0)])]


def test_log_sink(spark, tmp_path):
    df = E.to_envelope(spark.range(2), value=F.col("id").cast("string").cast("binary"), event_time=F.lit("2024-01-01").cast("timestamp"))
    sinks.log_batches(str(tmp_path / "log"))(df, 0)
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "log")).collect())
    assert lines[0].startswith("0 {} 2024-01-01")


def test_source_stream_limits_and_acknowledges(spark, tmp_path):
    acks = str(tmp_path / "acks")
    custom.register_source(spark, "fixed_rows", Fixed)
    reader = spark.readStream.format("fixed_rows").option("acks", acks).option("num_records", 4)
    sizes = []
    query = (
        reader.load()
        .writeStream.foreachBatch(lambda df, n: sizes.append(df.count()))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(processingTime="200 milliseconds")
        .start()
    )
    try:
        deadline = time.time() + 60
        while sum(sizes) < 10 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        query.stop()
    assert [s for s in sizes if s] == [4, 4, 2]
    source = Fixed({"acks": acks})
    assert source.acked(1) >= 8  # the end of every batch but the last is acknowledged by the next


@pytest.mark.parametrize("limit", [{}, {"num_records": 4}])
def test_source_stream_resumes(spark, tmp_path, limit):
    acks, checkpoint = str(tmp_path / "acks"), str(tmp_path / "checkpoint")
    custom.register_source(spark, "fixed_rows", Fixed)

    def once():
        got = []
        df = spark.readStream.format("fixed_rows").option("acks", acks).options(**limit).load()
        run.run_each_batch(df, lambda b, n: got.append(b.count()), checkpoint)
        return sum(got)

    # One limited batch each time; after a restart a batch may hold twice the limit.
    assert [once() for _ in range(4)] == ([4, 4, 2, 0] if limit else [10, 0, 0, 0])


def test_side_input_is_refreshed_between_batches(spark, tmp_path):
    from datetime import datetime

    folder = str(tmp_path / "side")
    SI.retrieve(spark, "s", 1, datetime(2024, 1, 1), lambda: b"one").write.parquet(folder)
    seen = []

    def write(df, batch_id):
        seen.extend((batch_id, r.id, bytes(r.side_input), r.side_input_version) for r in df.collect())
        SI.retrieve(spark, "s", 2, datetime(2024, 1, 2), lambda: b"two").write.mode("append").parquet(folder)
        SI.retrieve(spark, "s", 3, datetime(2024, 1, 3), lambda: None).write.mode("append").parquet(folder)

    rows = files(spark, tmp_path / "in", [("a", 1)], [("a", 2)]).select("id", "s")
    each = with_refreshed_side_input(lambda: spark.read.parquet(folder), "s", write)
    run.run_each_batch(rows, each, str(tmp_path / "checkpoint"))
    assert seen == [(0, "0-0", b"one", 1), (1, "1-0", b"two", 2)]


def test_heartbeats_close_the_windows_of_an_idle_source(spark, tmp_path):
    rows = files(spark, tmp_path / "in", [("a", 1), ("a", 2)])
    bare = spark.readStream.schema("id string, k string, s bigint").option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    bare = bare.select("k", F.timestamp_seconds("s").alias("event_time"))
    spark.createDataFrame([(200,)], "s bigint").write.parquet(str(tmp_path / "beats" / "0"))
    beats = spark.readStream.schema("s bigint").option("recursiveFileLookup", "true").parquet(str(tmp_path / "beats"))
    merged = progress.with_heartbeats(bare, beats.select(F.timestamp_seconds("s").alias("event_time")), "10 seconds")
    out = RD.reduce_window(progress.drop_heartbeats(merged), "1 minute", F.count(F.lit(1)).alias("n"), by=("k",))
    assert [(r.k, r.n) for r in result(out).collect()] == [("a", 2)]
    assert result(RD.reduce_window(rows, "1 minute", F.count(F.lit(1)).alias("n"))).count() == 0


def test_first_errors_are_recorded_once(spark, tmp_path):
    rows = files(spark, tmp_path / "in", [("a", 3), ("a", 2)], [("a", 1), ("b", 9)], [("b", 4)])
    errors = rows.select(F.get("keys", 0).alias("container"), *ER.error_columns(F.lit("m"), timestamp=F.col("s"))[1:])
    path = str(tmp_path / "errors")
    run.run_each_batch(errors, progress.record_first_errors(path), str(tmp_path / "checkpoint"))
    assert sorted((r.container, r.timestamp) for r in spark.read.parquet(path).collect()) == [("a", 2), ("b", 9)]


def test_posted_files_as_a_stream(spark, tmp_path):
    data = [(bytearray(b"x"), {"t": "60000"}), (bytearray(b"y"), {"t": "120000"})]
    spark.createDataFrame(data, shapes.POSTED).write.json(str(tmp_path / "posted"))
    out = result(shapes.read_posted_stream(spark, str(tmp_path / "posted"), time_header="t"))
    got = sorted((bytes(r.value), r.e) for r in out.select("value", F.unix_seconds("event_time").alias("e")).collect())
    assert got == [(b"x", 60), (b"y", 120)]


def test_clock_and_generator_streams_have_their_columns(spark):
    assert progress.clock(spark, "5 seconds").columns == ["event_time"]
    assert shapes.generate_stream(spark, per_second=5).isStreaming


def test_dropped_rows_advance_the_watermark(spark, tmp_path):
    rows = files(spark, tmp_path, [("a", 1), ("gone", 200)])
    marked = E.to_drop(rows, F.array_contains("keys", "gone"))
    counted = lambda df: result(RD.reduce_window(df, "1 minute", F.count(F.lit(1)).alias("n"), by=()))
    assert [r.n for r in counted(WM.drop_marked(marked)).collect()] == [1]
    # The plain filter moves below the watermark, which then stays at the kept row.
    assert counted(E.drop_marked(marked)).count() == 0
