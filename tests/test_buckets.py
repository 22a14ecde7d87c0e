"""Many keys in one group of a stateful operator: keys stay apart, sessions share runs of the event loop, replays use all cores."""

from __future__ import annotations

import pickle
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from msgflow.constants import EPOCH_TIME
from msgflow.message import Datum, Message
from msgflow.operators import scan, session_form
from msgflow.session import ship_package
from msgflow.streaming import reduce as SR
from msgflow.streaming import replay as RP
from msgflow.streaming import run, stateful
from tests.test_stream_state import Words
from tests.test_streams import END, files, result


@pytest.fixture(scope="module", autouse=True)
def ship(spark):
    ship_package(spark)


def test_sessions_of_a_bucket_stay_apart(spark, tmp_path):
    rnd = random.Random(3)
    batches = [[(k, t) for k in "abcde" for t in sorted(rnd.sample(range(1 + i * 200, 190 + i * 200), 8))] for i in range(3)]
    rows = files(spark, tmp_path, *batches, [("a", END)])
    out = result(stateful.session_handler_stream(rows, "20 seconds", session_form.session_form(Words), buckets=1))
    got = sorted((r["keys"][0], int(r.window.start.timestamp()), int(r.window.end.timestamp()), bytes(r.value)) for r in out.filter("value like '%rows'").collect())
    want = []
    for k in "abcde":
        times = sorted(t for batch in batches for key, t in batch if key == k)
        low = 0
        for i, t in enumerate(times):
            if i + 1 == len(times) or times[i + 1] - t > 20:
                want.append((k, times[low], t + 20, f"{i + 1 - low} rows".encode()))
                low = i + 1
    assert got == sorted(want)
    assert out.filter("value not like '%rows'").count() == sum(map(len, batches))


def test_sessions_share_runs_of_the_event_loop(monkeypatch):
    runs = []
    loop = session_form._loop()
    monkeypatch.setattr(session_form, "_loop", lambda: type("Loop", (), {"run_until_complete": staticmethod(lambda work: (runs.append(1), loop.run_until_complete(work))[1])}))
    form = session_form.session_form(Words)
    sessions = [form() for _ in range(100)]
    for i, session in enumerate(sessions):
        for n in range(i % 3):  # the first has no rows
            session.add(Datum({"keys": [str(i)], "value": str(n).encode()}))
    states = form.states(sessions)
    ends = [form() for _ in range(50)]
    form.merges([(end, states[2 * i : 2 * i + 2]) for i, end in enumerate(ends)])
    said = form.results([(end, ["k"], None) for end in ends])
    assert len(runs) == 3
    for i, messages in enumerate(said):
        counts = (2 * i % 3, (2 * i + 1) % 3)
        assert [m.value.decode() for m in messages] == [*(str(n) for c in counts for n in range(c)), f"{sum(counts)} rows"]


class Pairs(SR.StreamReducer):
    """Says every second row's place, and how many there were with the last event time."""

    def __init__(self):
        self.count, self.last = 0, None

    async def add(self, datum):
        self.count, self.last = self.count + 1, datum
        if self.count % 2 == 0:
            yield Message(f"{datum.id} {int(datum.event_time.timestamp())}".encode(), keys=datum.keys)

    async def close(self):
        return [Message(f"{self.count} {self.last.id} {int(self.last.event_time.timestamp())}".encode(), keys=self.last.keys)]


class PlainPairs(Pairs):
    def add(self, datum):
        self.count, self.last = self.count + 1, datum
        return [Message(f"{datum.id} {int(datum.event_time.timestamp())}".encode(), keys=datum.keys)] if self.count % 2 == 0 else None


@pytest.mark.parametrize("handler, buckets, columns", [(Pairs, 1, ("id",)), (Pairs, 1024, ("id", "s")), (PlainPairs, 1, ("id", "s"))])
def test_resumable_reducers_of_a_bucket_stay_apart(spark, tmp_path, handler, buckets, columns):
    rnd = random.Random(5)
    batches = [[(k, t) for t in rnd.sample(range(1 + i * 100, 101 + i * 100), 9) for k in "abcd"] for i in range(3)]
    rows = files(spark, tmp_path, *batches, [("a", END)], [("b", 250), ("e", 250)])
    out = result(SR.reduce_resumable_stream(rows, "120 seconds", handler, columns=columns, order=("event_time",), buckets=buckets))
    got = sorted((r["keys"][0], int(r.window.start.timestamp()), r.pos, r.final, bytes(r.value).decode()) for r in out.collect())
    want = []
    for k in "abcd":
        for start in (0, 120, 240):
            own = [(t, f"{i}-{n}") for i, b in enumerate(batches) for t, n in sorted((t, n) for n, (key, t) in enumerate(b) if key == k) if start <= t < start + 120]
            want += [(k, start, i // 2, False, f"{own[i][1]} {own[i][0]}") for i in range(1, len(own), 2)]
            want.append((k, start, len(own) // 2, True, f"{len(own)} {own[-1][1]} {own[-1][0]}"))
    assert got == sorted(want)


@pytest.mark.parametrize("columns", [("id",), ("id", "headers")])
def test_resumable_reducer_gets_no_row_behind_the_watermark(spark, tmp_path, columns):
    rows = files(spark, tmp_path, [("a", 500)], [("a", 600)], [("a", 100), ("a", 595), ("b", 100), ("b", 599)], [("a", END)])
    out = result(SR.reduce_resumable_stream(rows, "1000 seconds", Pairs, columns=columns))
    got = sorted((r["keys"][0], r.final, bytes(r.value).decode()) for r in out.collect())
    assert got == [("a", False, "1-0 600"), ("a", True, "3 2-1 595"), ("b", True, "1 2-3 599")]


def test_resumable_reducers_share_runs_of_the_event_loop():
    runs = []

    class Loop(scan.Loop):
        def run(self, awaitable):
            runs.append(1)
            return super().run(awaitable)

    workers = [[0, Pairs()] for _ in range(100)]
    rows = [{"id": str(i), "keys": ["k"], "event_time": EPOCH_TIME} for i in range(300)]
    with Loop() as loop:
        said = list(SR._answers(((workers[i % 100], workers[i % 100][1].add, (Datum(r),)) for i, r in enumerate(rows)), loop))
    assert len(runs) == 1 and [m.value for _, m in said] == [f"{i} 0".encode() for i in range(100, 200)]


def test_rows_of_a_batch_are_rows(spark):
    batch = pa.RecordBatch.from_pylist([{"id": "a", "keys": ["x"], "value": b"1"}, {"id": "b", "keys": [], "value": None}])
    first, second = map(Datum, scan.batch_rows(batch))
    assert (first.id, first.keys, first.value, second.keys, second.value, second.headers) == ("a", ["x"], b"1", [], None, None)
    assert pickle.loads(pickle.dumps(second))._row == {"id": "b", "keys": [], "value": None}


def test_large_parts_are_replayed_in_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(RP, "SMALL", 10)
    monkeypatch.setattr(RP, "shared_dir", lambda *_: str(tmp_path / "parts"))
    df = spark.range(300).select("id")
    parts = [F.col("id") < 70, F.col("id") == 75, F.col("id") < 0, F.col("id") >= 80]
    seen = {}
    run.run_each_batch(RP.replay(df, parts), lambda b, i: seen.__setitem__(i, sorted(r.id for r in b.collect())), str(tmp_path / "check"))
    assert seen == {0: list(range(70)), 1: [75], 2: [], 3: list(range(80, 300))}
    assert len(list((tmp_path / "parts").glob("*.parquet"))) == 4 * 8
