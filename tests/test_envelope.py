from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from msgflow import constants as C
from msgflow.functions import metadata as M
from msgflow.functions import scalars as S
from msgflow.operators import envelope as E
from msgflow.operators import mapping as MP
from msgflow.operators import routing as R
from msgflow.operators import transform as TR

EVENT_TIME = datetime(2022, 9, 12, 16, 0)


def rows(spark, texts, **fields):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "i string, t string")
    given = {"id": F.col("i"), "value": S.text_to_bytes("t"), **fields}
    return E.to_envelope(df, **given)


def test_defaults(spark):
    df = E.to_envelope(spark.range(1))
    assert df.schema.simpleString() == E.ENVELOPE.simpleString()
    row = df.withColumn("event_time", F.col("event_time").cast("string")).first()
    assert (row.keys, bytes(row.value), row.tags, row.headers) == ([], b"", [], {})
    assert (row.user_metadata, row.system_metadata) == ({}, {})
    assert row.event_time == C.MISSING_EVENT_TIME
    assert row.id is None and row.watermark is None and row.offset is None


def test_unknown_field_is_an_error(spark):
    with pytest.raises(TypeError):
        E.to_envelope(spark.range(1), payload=F.lit(1))


def test_validate_types(spark):
    good = rows(spark, ["a"])
    E.validate(good)
    for bad in (
        good.withColumn("value", F.lit("text")),
        good.withColumn("keys", F.lit("key")),
        good.withColumn("keys", F.array(F.lit(1))),
        good.withColumn("tags", F.lit("tag")),
        good.withColumn("event_time", F.lit("2022-01-01")),
    ):
        with pytest.raises(TypeError):
            E.validate(bad)


def test_validate_elements(spark):
    df = rows(spark, ["a", "b"], keys=F.array(F.when(F.col("t") == "a", F.lit("k"))))
    assert [r.v for r in df.select("id", E.is_valid(df).alias("v")).orderBy("id").collect()] == [True, False]
    with pytest.raises(Exception, match="must hold only strings"):
        E.validate(df).collect()


def test_drop_marks_and_filters(spark):
    df = E.to_drop(
        rows(spark, ["keep", "go"], keys=E.strings("k"), event_time=F.lit(EVENT_TIME)),
        S.payload_equals("value", "go"),
    )
    marked = {r.id: r for r in df.collect()}
    assert marked["1"].tags == [C.DROP] and marked["1"]["keys"] == [] and bytes(marked["1"].value) == b""
    assert marked["1"].event_time == marked["0"].event_time
    assert [r.id for r in E.drop_marked(df).select("id").collect()] == ["0"]


def test_map_takes_nothing_from_the_input(spark):
    df = rows(spark, ["a,b,c"], keys=E.strings("in"), tags=E.strings("t"), user_metadata=M.meta_from_dict({"g": {"k": "v"}}))
    out = MP.map_messages(df, E.messages(E.message(F.col("value")), E.message(F.lit(b"x"), keys=E.strings("out"))), keep=("id",))
    got = sorted((r.pos, bytes(r.value), r["keys"], r.tags, r.user_metadata) for r in out.collect())
    assert got == [(0, b"a,b,c", [], [], {}), (1, b"x", ["out"], [], {})]


def test_flat_map(spark):
    out = MP.flat_map(rows(spark, ["a,b,c", "", "x,"], keys=E.strings("k")))
    got = sorted((r.id, r.pos, bytes(r.value), r["keys"]) for r in out.drop("event_time").collect())
    assert got == [
        ("0", 0, b"a", ["k"]), ("0", 1, b"b", ["k"]), ("0", 2, b"c", ["k"]),
        ("1", 0, b"", ["k"]), ("2", 0, b"x", ["k"]), ("2", 1, b"", ["k"]),
    ]


def test_flat_map_quotes_the_delimiter(spark):
    out = MP.flat_map(rows(spark, ["a.b|c"]), "|")
    assert [bytes(r.value) for r in out.orderBy("pos").select("value").collect()] == [b"a.b", b"c"]


def test_filter_value(spark):
    out = MP.filter_value(rows(spark, ["hello", "world", "bad world"]), "bad world")
    assert sorted(bytes(r.value) for r in out.select("value").collect()) == [b"hello", b"world"]


def test_from_datum_and_header(spark):
    df = rows(spark, ["a"], keys=E.strings("k"), tags=E.strings("t"), headers=F.create_map(F.lit("key1"), F.lit("value1")))
    row = E.from_datum(df, value=F.lit(b"new")).select("value", "keys", "tags", E.header("key1").alias("h"), E.header("no").alias("n")).first()
    assert (bytes(row.value), row["keys"], row.tags, row.h, row.n) == (b"new", ["k"], [], "value1", None)


def test_routing(spark):
    numbers = spark.range(4).select(S.int_to_le_bytes("id").alias("value"), F.col("id").cast("string").alias("id"))
    df = R.even_odd(E.to_envelope(numbers, id=F.col("id"), value=F.col("value")))
    edges = R.route(df, {"even": ["even-tag"], "odd": ["odd-tag"], "both": ["even-tag", "odd-tag"], "all": None})
    got = {name: sorted(r.id for r in e.select("id").collect()) for name, e in edges.items()}
    assert got == {"even": ["0", "2"], "odd": ["1", "3"], "both": list("0123"), "all": list("0123")}
    labelled = R.route_labelled(df, {"even": ["even-tag"], "all": None})
    assert sorted((r.edge, r.id) for r in labelled.select("edge", "id").collect()) == sorted(
        [("even", "0"), ("even", "2"), *[("all", c) for c in "0123"]]
    )


def test_pairing(spark):
    req = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    resp = spark.createDataFrame([("a",), ("b",), ("b",), ("x",)], "id string")
    got = {r.id: r.verdict for r in MP.pair_responses(req, resp).collect()}
    assert got == {"a": "OK", "b": "DUPLICATE", "c": "MISSING", "x": "UNKNOWN"}


def test_event_time_buckets(spark):
    times = ["2021-01-01", "2022-07-01", "2023-01-01"]
    df = rows(spark, times, keys=E.strings("test"), event_time=F.to_timestamp("t"))
    out = TR.bucket_event_time(df).withColumn("event_time", F.col("event_time").cast("string"))
    got = {r.id: (r.tags, r.event_time, bytes(r.value)) for r in out.collect()}
    assert got["0"] == ([C.DROP], "2021-01-01 00:00:00", b"")
    assert got["1"] == (["within_year_2022"], "2022-01-01 00:00:00", b"2022-07-01")
    assert got["2"] == (["after_year_2022"], "2023-01-01 00:00:00", b"2023-01-01")


def test_missing_event_time(spark):
    out = TR.assign_event_time(rows(spark, ["a"]), F.lit(None))
    assert out.select(F.col("event_time").cast("string").alias("e")).first().e == C.MISSING_EVENT_TIME


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(10).withColumn("t", F.lit("x")).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    env = E.to_envelope(df.withColumnRenamed("id", "n"), keep=["n"])
    plan = env.filter(F.col("n") > 5).select("n")._jdf.queryExecution().toString()
    assert "GreaterThan(id,5)" in plan and "ReadSchema: struct<id:bigint>" in plan
