"""Side inputs, sinks, errors, source shapes and progress on batch tables."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from msgflow import constants as C
from msgflow.functions import scalars as S
from msgflow.operators import envelope as E
from msgflow.operators import errors as ER
from msgflow.operators import reduce as RD
from msgflow.operators import side_inputs as SI
from msgflow.operators import sinks as SK
from msgflow.operators import windows as W
from msgflow.sources import custom, progress, shapes
from msgflow.session import shared_dir

AT = datetime(2024, 1, 1)


# Side inputs -------------------------------------------------------------------------


def test_retrieve_and_latest(spark):
    table = SI.retrieve(spark, "s", 1, AT, lambda: b"first")
    table = table.unionByName(SI.retrieve(spark, "s", 2, AT, lambda: b"test_side_input"))
    table = table.unionByName(SI.retrieve(spark, "s", 3, AT, lambda: None))
    assert [(r.name, bytes(r.value), r.version) for r in SI.latest(table).collect()] == [("s", b"test_side_input", 2)]
    seen = SI.with_side_input(SI.with_side_input(spark.range(2), table, "s", "a"), table, "other", "b").collect()
    assert {(bytes(r.a), bytes(r.b)) for r in seen} == {(b"test_side_input", b"no_value")}
    with pytest.raises(TypeError):
        SI.retrieve(spark, "s", 1, AT, lambda: "text")


def test_side_input_needs_no_join(spark):
    table = SI.retrieve(spark, "s", 1, AT, lambda: b"v")
    plan = SI.with_side_input(spark.range(2), table, "s")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("split", [{}, {"hot_rows": 20}])
def test_asof_against_brute_force(spark, split):
    r = random.Random(4)
    versions = [("a" if r.random() < 0.7 else "b", i, r.randrange(500), f"v{i}", r.random() < 0.2) for i in range(60)]
    events = [("a" if r.random() < 0.7 else r.choice("bc"), i, r.randrange(500)) for i in range(400)]
    v = spark.createDataFrame(versions, "name string, version bigint, s bigint, t string, no_broadcast boolean").select(
        "name", "version", F.timestamp_seconds("s").alias("version_time"), S.text_to_bytes("t").alias("value"), "no_broadcast"
    )
    e = spark.createDataFrame(events, "name string, n bigint, s bigint").withColumn("event_time", F.timestamp_seconds("s"))
    out = SI.side_input_asof(e, v, order=("event_time", "n"), **split)
    got = {x.n: (bytes(x.side_input).decode(), x.version) for x in out.collect()}
    want = {}
    for name, n, s in events:
        known = [(vs, i, t) for nm, i, vs, t, no in versions if nm == name and vs <= s and not no]
        best = max(known, default=None)
        want[n] = (best[2], best[1]) if best else ("no_value", None)
    assert got == want


# Sinks -------------------------------------------------------------------------------


def test_sink_statuses(spark):
    data = [
        ("test_id_0", "test_mock_message"),
        ("test_id_1", "test_mock_err_message"),
        ("test_id_2", "test_mock_on_success1_message"),
        ("test_id_3", "test_mock_on_success2_message"),
        ("test_id_4", "test_mock_fallback_message"),
    ]
    df = spark.createDataFrame(data, "id string, t string").select(
        "id", S.text_to_bytes("t").alias("value"), E.strings("in").alias("keys")
    )

    def has(text):
        return S.payload_contains("value", text)

    answer = (
        F.when(has("err"), SK.respond_failure("mock sink message error"))
        .when(has("fallback"), SK.respond_fallback())
        .when(has("on_success1"), SK.respond_on_success())
        .when(has("on_success2"), SK.respond_on_success(E.message(F.lit(b"value"), keys=E.strings("key"))))
        .otherwise(SK.respond_success())
    )
    responded = SK.sink(df, answer)
    got = {r.id: (r.status, r.err_msg) for r in responded.collect()}
    assert got == {
        "test_id_0": ("SUCCESS", None),
        "test_id_1": ("FAILURE", "mock sink message error"),
        "test_id_2": ("ON_SUCCESS", None),
        "test_id_3": ("ON_SUCCESS", None),
        "test_id_4": ("FALLBACK", None),
    }
    routed = {(r.destination, r.id): (bytes(r.value).decode(), r["keys"]) for r in SK.destinations(responded).collect()}
    assert routed[("on_success", "test_id_2")] == ("test_mock_on_success1_message", ["in"])
    assert routed[("on_success", "test_id_3")] == ("value", ["key"])
    assert routed[("primary", "test_id_3")] == ("test_mock_on_success2_message", ["in"])
    assert ("retry", "test_id_1") in routed and ("fallback", "test_id_4") in routed and len(routed) == 7


# Errors ------------------------------------------------------------------------------


def test_capture_and_first(spark):
    df = spark.createDataFrame([(3, "x"), (1, "7"), (2, "y")], "s bigint, t string")
    failed = F.col("t").try_cast("bigint").isNull()
    good, bad = ER.capture(df, failed, F.concat(F.lit("bad "), F.col("t")), timestamp=F.col("s"))
    assert [r.t for r in good.collect()] == ["7"]
    assert bad.columns == ["container", "timestamp", "code", "message", "details"]
    (first,) = ER.first_critical(bad).collect()
    assert (first.container, first.timestamp, first.code, first.message) == (
        C.DEFAULT_CONTAINER, 2, C.INTERNAL_ERROR_CODE, "bad y"
    )
    with pytest.raises(Exception, match="bad x"):
        ER.fail_fast(df, F.col("t") == "x", F.lit("bad x"), column="t").collect()


def test_empty_code_takes_the_default(spark):
    cols = ER.error_columns(F.lit("m"), timestamp=F.lit(1), code="")
    assert spark.range(1).select(*cols).first().code == C.INTERNAL_ERROR_CODE


# Windows -----------------------------------------------------------------------------


def test_windows(spark):
    df = spark.createDataFrame([(f"k{i}", i) for i in range(100)], "k string, s bigint")
    df = df.select(E.strings(F.col("k")).alias("keys"), F.timestamp_seconds(F.col("s") % 60 + 1662998400).alias("event_time"))
    out = RD.reduce_counter(df, "1 minute")
    assert out.count() == 100 and {r.slot for r in out.select("slot").distinct().collect()} == {"slot-0"}
    assert W.window_eof(out).count() == 1
    text = out.select(S.bytes_to_text("value").alias("v")).first().v
    assert text == (
        "counter:1 interval_window_start:2022-09-12 16:00:00+00:00 interval_window_end:2022-09-12 16:01:00+00:00"
    )
    with pytest.raises(ValueError, match="one window"):
        W.fixed_window("1 minute", slide="30 seconds")
    end = F.lit("2022-09-12 16:01:00").cast("timestamp")
    assert W.open_windows(df, "1 minute", end).count() == 0
    assert W.open_windows(df, "1 minute", end - F.expr("interval 1 second")).count() == 1


def test_plain_window_equals_window(spark):
    df = spark.range(-50, 50).select(F.timestamp_micros(F.col("id") * 7_777_777).alias("event_time"))
    for length in ("1 minute", "45 seconds", "7 days"):
        both = df.select(W.fixed_window(length).alias("a"), W.plain_window(length).alias("b"))
        assert both.filter("a.start <> b.start or a.end <> b.end").count() == 0


def test_reduce_is_partially_aggregated(spark):
    df = spark.range(10).select(E.strings("k").alias("keys"), F.timestamp_seconds("id").alias("event_time"))
    plan = RD.reduce_window(df, "1 minute", F.count(F.lit(1)).alias("n"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.count("Exchange") == 1


# Source shapes -------------------------------------------------------------------------


def test_generator(spark):
    out = shapes.generate(spark, 25, per_second=10, size=6)
    rows = out.select("id", "value", F.unix_micros("event_time").alias("us")).orderBy(F.col("id").cast("int")).collect()
    assert len(rows) == 25 and all(len(r.value) == 6 for r in rows)
    assert [r.us for r in rows[:3]] == [0, 100_000, 200_000] and rows[24].us == 2_400_000


def test_kafka_shape(spark):
    schema = (
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
        "headers array<struct<key:string,value:binary>>"
    )
    data = [
        (b"k", b"v", "t", 3, 7, AT, [("h", b"1"), ("h", b"2"), ("g", b"3")]),
        (None, None, "t", 3, 8, AT, None),
    ]
    out = shapes.from_kafka(spark.createDataFrame(data, schema))
    a, b = out.orderBy("id").collect()
    assert (a.id, a["keys"], bytes(a.value), a.headers) == ("t-3-7", ["k"], b"v", {"h": "2", "g": "3"})
    assert (a.offset.partition_id, bytes(a.offset.offset)) == (3, b"7")
    assert (b["keys"], bytes(b.value), b.headers) == ([], b"", {})


def test_posted_rows(spark):
    data = [(bytearray(b"x"), {"time": "60000", "key": "k"}), (bytearray(b"y"), {"time": "soon"})]
    df = spark.createDataFrame(data, shapes.POSTED)
    out = shapes.from_posted(df, time_header="time", key_header="key").select(
        "value", "keys", F.col("event_time").cast("string").alias("e")
    )
    got = {bytes(r.value): (r["keys"], r.e) for r in out.collect()}
    assert got == {b"x": (["k"], "1970-01-01 00:01:00"), b"y": ([], C.MISSING_EVENT_TIME)}


def test_progress(spark):
    df = spark.range(12).select(
        F.struct(F.col("id").cast("string").cast("binary").alias("offset"), (F.col("id") % 3).cast("int").alias("partition_id")).alias("offset")
    )
    assert sorted(r.partition_id for r in progress.partitions(df).collect()) == [0, 1, 2]
    committed = spark.createDataFrame([(0, 6), (1, None)], "partition_id int, committed bigint")
    got = {r.partition_id: r.pending for r in progress.pending(df, committed).collect()}
    assert got == {0: 1, 1: -1, 2: 4}


class Fixed(custom.Source):
    """Ten rows with a fixed offset, on partitions 1, 2 and 3; keeps acknowledgements on disk."""

    def __init__(self, options):
        super().__init__(options)
        self.acks = custom.FileAcks(options["acks"])

    def partitions(self):
        return [1, 2, 3]

    def total_partitions(self):
        return 10

    def latest(self, partition):
        return 10 if partition == 1 else 0

    def read(self, partition, start, end):
        for n in range(start, end):
            yield custom.SourceRow(
                b"payload:%d" % n,
                event_time=AT,
                offset=b"offset_mock",
                keys=["test_key"],
                user_metadata={"custom_info": {"custom_key": b"v"}, "test_info": {}},
            )

    def ack(self, partition, end):
        self.acks.ack(partition, end)

    def acked(self, partition):
        return self.acks.acked(partition)


def test_source_batch_read(spark, tmp_path):
    from msgflow.session import ship_package

    ship_package(spark)
    custom.register_source(spark, "fixed_rows", Fixed)
    reader = spark.read.format("fixed_rows").option("acks", str(tmp_path / "acks")).option("rows_per_task", 3)
    df = reader.load()
    assert df.rdd.getNumPartitions() == 4
    rows = df.collect()
    assert sorted(bytes(r.value) for r in rows) == [b"payload:%d" % n for n in range(10)]
    assert {bytes(r.offset.offset) for r in rows} == {b"offset_mock"} and {r.offset.partition_id for r in rows} == {1}
    assert rows[0]["keys"] == ["test_key"] and bytes(rows[0].user_metadata["custom_info"]["custom_key"]) == b"v"


class Clocked(custom.Source):
    """One row a second on each of two partitions; reading a row that nobody asked for fails."""

    def partitions(self):
        return [0, 1]

    def latest(self, partition):
        return 100

    def prune(self, partition, start, end, bounds):
        return [(i, i + 10) for i in range(start, end, 10) if bounds.overlaps(self._at(i), self._at(i + 9))]

    def _at(self, n):
        return datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=n)

    def read(self, partition, start, end):
        allowed = [int(n) for n in self.options["allowed"].split("-")]
        if partition != 1 or start < allowed[0] or end > allowed[1]:
            raise ValueError(f"partition {partition}, rows {start} to {end} were not asked for")
        for n in range(start, end):
            yield custom.SourceRow(str(n).encode(), event_time=self._at(n))


@pytest.mark.parametrize(
    ("asked", "allowed", "want"),
    [
        ("event_time >= '2024-01-01 00:00:25' AND event_time < '2024-01-01 00:00:31'", "20-40", range(25, 31)),
        ("event_time = '2024-01-01 00:00:40'", "40-50", [40]),
        ("event_time > '2024-01-01 00:01:35' AND value <> CAST('97' AS BINARY)", "90-100", [96, 98, 99]),
        ("event_time > '2025-01-01'", "0-0", []),
        ("event_time < '2024-01-01 00:00:03' OR event_time > '2024-01-01 00:01:37'", "0-100", [0, 1, 2, 98, 99]),
    ],
)
def test_source_reads_only_what_filters_ask(spark, asked, allowed, want):
    from msgflow.session import ship_package

    ship_package(spark)
    spark.conf.set(custom.PUSHDOWN, "true")
    try:
        custom.register_source(spark, "clocked_rows", Clocked)
        rows = spark.read.format("clocked_rows").option("allowed", allowed).load()
        got = rows.filter(f"offset.partition_id >= 1 AND ({asked})")
        assert sorted(int(bytes(r.value)) for r in got.collect()) == list(want)
    finally:
        spark.conf.unset(custom.PUSHDOWN)


def test_bounds_of_partitions():
    at = ("offset", "partition_id")
    few = custom.Bounds.of([custom.In(at, (1, 2, 5)), custom.LessThan(at, 5), custom.GreaterThan(at, 1)])
    assert [p for p in range(7) if few.has_partition(p)] == [1, 2, 5]  # bounds may be too wide, never too narrow
    none = custom.Bounds.of([custom.EqualTo(at, 1), custom.EqualTo(at, 2)])
    assert not any(none.has_partition(p) for p in range(4))
    assert all(custom.Bounds.of([custom.EqualTo(("id",), "1-0")]).has_partition(p) for p in range(4))


def test_source_progress(spark, tmp_path):
    source = Fixed({"acks": str(tmp_path / "acks")})
    assert custom.pending(source) == custom.UNKNOWN
    for p in source.partitions():
        source.ack(p, 4 if p == 1 else 0)
    row = custom.describe(spark, source).first()
    assert (row.pending, row.partitions, row.total_partitions) == (6, [1, 2, 3], 10)


def test_shared_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a.startswith(base) and a != b
