"""Python handlers: maps, batches, reduces, sessions, accumulators, and their error paths."""

from __future__ import annotations

import asyncio
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from msgflow import constants as C
from msgflow.functions import scalars as S
from msgflow.message import BatchResponse, Message, make_factory
from msgflow.operators import envelope as E
from msgflow.operators import group_handlers as G
from msgflow.operators import handlers as H

START = 1662998400


@pytest.fixture(scope="module", autouse=True)
def ship(spark):
    from msgflow.session import ship_package

    ship_package(spark)


def rows(spark, data):
    """(key, seconds after START, text)"""
    df = spark.createDataFrame([(str(i), *r) for i, r in enumerate(data)], "i string, k string, s bigint, t string")
    return E.to_envelope(
        df,
        id=F.col("i"),
        keys=E.strings(F.col("k")),
        value=S.text_to_bytes("t"),
        event_time=F.timestamp_seconds(F.col("s") + START),
        watermark=F.timestamp_seconds(F.col("s") + START - 5),
    )


# Messages and builders -------------------------------------------------------------


def test_message_checks():
    m = Message(b"x")
    assert (m.keys, m.tags) == ([], [])
    assert Message.drop().tags == [C.DROP]
    for bad in ({"value": "text"}, {"keys": "k"}, {"keys": [1]}, {"tags": "t"}, {"event_time": 5}):
        with pytest.raises(TypeError):
            Message(**{"value": b"x", **bad})


def test_factory():
    class Handler:
        def __init__(self, start=0):
            self.n = start

        def handler(self):
            self.n += 1
            return self.n

    make = make_factory(Handler, (5,))
    assert (make()(), make()()) == (6, 6)  # fresh for each group
    with pytest.raises(TypeError):
        make_factory(Handler())
    with pytest.raises(TypeError):
        make_factory(lambda: None, (1,))
    with pytest.raises(TypeError):
        make_factory("handler")
    with pytest.raises(TypeError):
        make_factory(int)


# Map family ------------------------------------------------------------------------


def test_map_forms_agree(spark):
    df = rows(spark, [("a", 0, "hello"), ("b", 1, "bad world"), ("c", 2, "world")])

    def plain(keys, d):
        if d.value == b"bad world":
            return [Message.drop()]
        return [Message(d.value, keys=keys, user_metadata={"processing": {"n": str(len(d.value)).encode()}})]

    async def later(keys, d):
        await asyncio.sleep(0)
        return plain(keys, d)

    class Mapper:
        def handler(self, keys, d):
            return plain(keys, d)

    results = []
    for handler in (plain, later, Mapper()):
        out = E.drop_marked(H.map_handler(df, handler))
        results.append(sorted((r.id, bytes(r.value), r["keys"], str(r.user_metadata)) for r in out.collect()))
    assert results[0] == results[1] == results[2]
    assert [r[0] for r in results[0]] == ["0", "2"]


def test_map_class_is_refused(spark):
    class Mapper:
        def handler(self, keys, d):
            return []

    with pytest.raises(TypeError):
        H.map_handler(rows(spark, []), Mapper)


def test_map_reads_only_its_columns(spark):
    df = rows(spark, [("a", 0, "x")])
    out = H.map_handler(df, lambda keys, d: [Message(str(d.headers).encode())], columns=("id", "value"))
    assert bytes(out.first().value) == b"None"
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "watermark" not in plan.split("MapInArrow")[1].split("\n", 1)[0]


@pytest.mark.parametrize("is_async", [False, True])
def test_errors_fail_or_are_captured(spark, is_async):
    df = rows(spark, [("a", 0, "1"), ("a", 0, "x"), ("a", 0, "3")])

    def double(keys, d):
        return [Message(str(int(d.value) * 2).encode())]

    async def later(keys, d):
        return double(keys, d)

    handler = later if is_async else double
    with pytest.raises(Exception, match="ValueError"):
        H.map_handler(df, handler).collect()
    good, bad = H.split_errors(H.map_handler(df, handler, on_error="capture"))
    assert sorted(bytes(r.value) for r in good.collect()) == [b"2", b"6"]
    (error,) = bad.collect()
    assert (error.id, error.container, error.code) == ("1", "map", C.INTERNAL_ERROR_CODE)
    assert "ValueError" in error.message and "Traceback" in error.details and error.timestamp > 0


def test_source_transform(spark):
    df = rows(spark, [("a", 0, "x"), ("a", 1, "y")])
    new = datetime(2022, 9, 13, 19, 46, 40, tzinfo=timezone.utc)

    def handler(keys, d):
        return [Message.drop(d.event_time)] if d.value == b"y" else [Message(d.value, keys=["test"], event_time=new)]

    out = H.source_transform_handler(df, handler)
    got = {r.id: (r.tags, r.e) for r in out.select("id", "tags", F.unix_seconds("event_time").alias("e")).collect()}
    assert got == {"0": ([], 1663098400), "1": ([C.DROP], START + 1)}


def test_map_stream_forms(spark):
    df = rows(spark, [("k", 0, "a,b,c"), ("k", 0, "")])

    def parts(keys, d):
        for p in d.value.split(b","):
            yield Message(p, keys=keys)

    async def slow_parts(keys, d):
        for p in d.value.split(b","):
            await asyncio.sleep(0)
            yield Message(p, keys=keys)

    want = [("0", 0, b"a"), ("0", 1, b"b"), ("0", 2, b"c"), ("1", 0, b"")]
    for handler in (parts, slow_parts):
        out = H.map_stream_handler(df, handler, rows_per_batch=2)
        assert sorted((r.id, r.pos, bytes(r.value)) for r in out.collect()) == want
    H.register_map_stream(spark, "parts_of", lambda v: v.split(b","))
    out = spark.sql("SELECT id, p.* FROM {df}, LATERAL parts_of(value) p", df=df.select("id", "value"))
    assert sorted((r.id, r.pos, bytes(r.value)) for r in out.collect()) == want


def test_batch_map_pairs_by_id(spark):
    df = rows(spark, [("k", 0, str(i)) for i in range(10)])

    def echo(items):
        return [BatchResponse(d.id, [Message(d.value)]) for d in reversed(items)]

    out = H.batch_map_handler(df, echo)
    assert sorted((r.id, bytes(r.value)) for r in out.collect()) == [(str(i), str(i).encode()) for i in range(10)]
    with pytest.raises(Exception, match="responses"):
        H.batch_map_handler(df, lambda items: echo(items)[1:]).collect()
    few = H.batch_map_handler(df.coalesce(1), lambda items: echo(items)[1:], strict=False)
    assert few.count() == 9


def test_concurrent_calls_share_a_client_and_keep_order(spark):
    import time

    df = rows(spark, [("k", 0, str(i)) for i in range(40)]).coalesce(1)

    class Client:
        def __init__(self):
            self.busy = self.most = 0

    def call(client, d):
        client.busy += 1
        client.most = max(client.most, client.busy)
        time.sleep(0.01)
        client.busy -= 1
        return [Message(str(client.most).encode())]

    out = H.map_concurrent(df, call, Client, columns=("id",), max_in_flight=8).collect()
    assert [r.id for r in out] == [str(i) for i in range(40)]
    assert max(int(r.value) for r in out) > 1


# Reduce, session, accumulator --------------------------------------------------------


async def count_all(keys, datums, window):
    n = 0
    async for _ in datums:
        n += 1
    return [Message(f"counter:{n}".encode(), keys=keys)]


def test_reduce_fixture(spark):
    df = rows(spark, [("k", i, "x") for i in range(10)])
    out = G.reduce_handler(df, "1 minute", count_all)
    (row,) = out.select("keys", "value", F.unix_seconds("window.start").alias("a"), F.unix_seconds("window.end").alias("b")).collect()
    assert (row["keys"], bytes(row.value), row.a, row.b) == (["k"], b"counter:10", START, START + 60)
    many = G.reduce_handler(rows(spark, [(f"k{i}", 0, "x") for i in range(100)]), "1 minute", count_all)
    assert sorted({bytes(r.value) for r in many.collect()}) == [b"counter:1"] and many.count() == 100


def test_reduce_not_keyed(spark):
    out = G.reduce_handler(rows(spark, [("a", 0, "x"), ("b", 1, "x")]), "1 minute", count_all, keyed=False)
    assert [(bytes(r.value), r["keys"]) for r in out.collect()] == [(b"counter:2", [])]


def test_keys_that_join_alike_stay_apart(spark):
    df = rows(spark, [("a:b", 0, "x"), ("a", 0, "x")])
    df = E.rekey(df.filter("id = '0'"), "a:b").unionByName(E.rekey(df.filter("id = '1'"), "a", "b"))
    out = G.reduce_handler(df, "1 minute", count_all)
    assert sorted(r["keys"] for r in out.collect()) == [["a", "b"], ["a:b"]]


def test_reduce_stream_fixture(spark):
    class Early:
        def __init__(self, threshold):
            self.n, self.threshold = 0, threshold

        def handler(self, keys, datums, window):
            for _ in datums:
                self.n += 1
                if self.n > self.threshold:
                    yield Message(f"counter:{self.n}".encode(), keys=keys)
                    self.n = 0
            yield Message(f"counter:{self.n}".encode(), keys=keys)

    df = rows(spark, [(k, i, "x") for i in range(10) for k in ("a", "b")])
    out = G.reduce_handler(df, "1 minute", Early, init_args=(2,)).orderBy("keys", "pos").collect()
    assert [bytes(r.value) for r in out] == [b"counter:3"] * 3 + [b"counter:1"] + [b"counter:3"] * 3 + [b"counter:1"]


def test_reduce_sees_rows_in_event_time_order(spark):
    df = rows(spark, [("k", s, str(s)) for s in (30, 10, 20, 40)])
    out = G.reduce_handler(df, "1 minute", lambda keys, datums, w: [Message(b",".join(d.value for d in datums))])
    assert bytes(out.first().value) == b"10,20,30,40"


class CountRows:
    def __init__(self, start=0):
        self.n = start

    def add(self, datum):
        self.n += 1

    def state(self):
        return str(self.n).encode()

    def merge(self, state):
        self.n += int(state)

    def result(self, keys, window):
        yield Message(self.state(), keys=keys)


def test_mergeable_reduce_equals_opaque(spark, monkeypatch):
    df = rows(spark, [(f"k{i % 3}", i, "x") for i in range(300)]).repartition(5)
    merged = G.reduce_mergeable(df, "1 minute", CountRows)
    opaque = G.reduce_handler(df, "1 minute", count_all)
    pick = lambda d: sorted((str(r.window), r["keys"], bytes(r.value).removeprefix(b"counter:")) for r in d.collect())
    assert pick(merged) == pick(opaque)
    monkeypatch.setattr(G, "MAX_OPEN", 1)
    assert pick(G.reduce_mergeable(df, "1 minute", CountRows)) == pick(opaque)


def test_mergeable_needs_its_methods(spark):
    class Half:
        def add(self, d): ...

    with pytest.raises(TypeError, match="state, merge, result"):
        G.reduce_mergeable(rows(spark, []), "1 minute", Half)
    with pytest.raises(TypeError):
        G.reduce_mergeable(rows(spark, []), "1 minute", CountRows())


@pytest.mark.parametrize("block", [1, 4096])
def test_session_fixture_and_bridge(spark, block):
    # Two stretches that a row between them joins; another session far off.
    df = rows(spark, [("key1", s, "x") for s in (0, 5, 20, 12, 500)]).repartition(3)
    out = G.session_handler(df, "10 seconds", CountRows, block=block)
    got = sorted(
        (r.a - START, r.b - START, bytes(r.value), r["keys"])
        for r in out.select("keys", "value", F.unix_seconds("window.start").alias("a"), F.unix_seconds("window.end").alias("b")).collect()
    )
    assert got == [(0, 30, b"4", ["key1"]), (500, 510, b"1", ["key1"])]


def test_accumulator_fixture(spark):
    class Counter:
        def __init__(self):
            self.n = 0

        async def handler(self, datums):
            async for d in datums:
                self.n += 1
                yield Message.of(d, value=f"counter:{self.n}".encode())

    out = G.accumulate_handler(rows(spark, [("k", i, "x") for i in range(5)]), Counter)
    got = out.orderBy("pos").select("value", "keys", "id", F.unix_seconds("window.end").alias("e")).collect()
    assert [(bytes(r.value), r["keys"], r.id) for r in got] == [(f"counter:{i + 1}".encode(), ["k"], str(i)) for i in range(5)]
    assert [r.e for r in got] == [START + i - 5 for i in range(5)]
    ten = G.accumulate_handler(rows(spark, [(f"k{i}", i, "x") for i in range(10)]), Counter)
    assert {bytes(r.value) for r in ten.select("value").collect()} == {b"counter:1"}


def test_accumulator_timeout_starts_afresh(spark):
    def number(datums):
        for n, d in enumerate(datums, 1):
            yield Message(str(n).encode(), keys=d.keys, id=d.id)

    df = rows(spark, [("k", s, "x") for s in (0, 5, 100, 104)])
    out = G.accumulate_handler(df, number, timeout="10 seconds")
    got = out.select("id", "value", "stretch").orderBy("id").collect()
    assert [(r.id, bytes(r.value), r.stretch) for r in got] == [("0", b"1", 1), ("1", b"2", 1), ("2", b"1", 2), ("3", b"2", 2)]


def test_accumulator_handler_error_fails(spark):
    def bad(datums):
        yield Message.of(next(datums))
        raise RuntimeError("second row")

    with pytest.raises(Exception, match="second row"):
        G.accumulate_handler(rows(spark, [("k", 0, "x"), ("k", 1, "x")]), bad).select("value").collect()
