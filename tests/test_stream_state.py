"""State over several micro-batches: early emission, two-level state, ordered sums, late rows, sessions row by row, errors."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from msgflow.functions import scalars as S
from msgflow.message import Message, Response
from msgflow.operators import envelope as E
from msgflow.operators import group_handlers as G
from msgflow.operators.session_form import session_form
from msgflow.session import ship_package
from msgflow.streaming import late, redelivery, run, sinks, stateful
from msgflow.streaming import reduce as SR
from msgflow.streaming.acks import OffsetLog, acknowledging, unacknowledged
from msgflow.streaming.replay import replay
from tests.test_handlers import CountRows
from tests.test_streams import END, files, result


@pytest.fixture(scope="module", autouse=True)
def ship(spark):
    ship_package(spark)


class Pairs(SR.StreamReducer):
    """Speaks at every second row and at the end; its words tell what it has seen."""

    def __init__(self):
        self.seen = []

    def add(self, datum):
        self.seen.append(datum.value.decode())
        return [Message("+".join(self.seen).encode(), keys=datum.keys)] if len(self.seen) % 2 == 0 else None

    def close(self):
        return [Message(f"end {len(self.seen)}".encode())]


def test_resumable_reducer_speaks_before_its_window_closes(spark, tmp_path):
    rows = files(spark, tmp_path / "in", [("a", 1), ("a", 2)], [("a", 3)], [("a", 5), ("b", 4)])
    out = result(SR.reduce_resumable_stream(rows, "60 seconds", Pairs, order=("event_time",)))
    got = sorted((r.pos, r.final, bytes(r.value).decode()) for r in out.collect())
    assert got == [(0, False, "1+2"), (1, False, "1+2+3+5")]  # no window has closed


def test_resumable_reducer_closes_and_drops_late_rows(spark, tmp_path):
    rows = files(spark, tmp_path / "in", [("a", 1)], [("a", END)], [("a", END + 1)], [("a", 2)], [("a", END + 2)])
    out = result(SR.reduce_resumable_stream(rows, "60 seconds", Pairs, keyed=False))
    assert [(r.pos, r.final, bytes(r.value)) for r in out.orderBy("window", "pos").collect()] == [(0, True, b"end 1"), (0, False, b"1000000+1000001")]


def test_resumable_reducer_must_be_a_class_of_its_kind(spark, tmp_path):
    rows = files(spark, tmp_path / "in", [("a", 1)])
    with pytest.raises(TypeError, match="StreamReducer"):
        SR.reduce_resumable_stream(rows, "1 minute", CountRows)


def test_mergeable_rows_are_combined_before_the_exchange(spark, tmp_path):
    rows = files(spark, tmp_path / "in", [("a", 1)] * 40, [("a", 2)] * 30, [("a", END)])
    out = SR.reduce_mergeable_stream(rows, "60 seconds", CountRows)
    plan = out._jdf.queryExecution().logical().toString()
    assert plan.index("TransformWithState") < plan.index("MapInArrow")  # children come after
    got = [(list(r["keys"]), bytes(r.value)) for r in result(out).collect()]
    assert [k for k, _ in got] == [["a"]] and got[0][1] == b"70"


def test_mergeable_without_keys(spark, tmp_path):
    rows = files(spark, tmp_path / "in", [("a", 1), ("b", 2)], [("c", 3)], [("a", END)])
    out = result(SR.reduce_mergeable_stream(rows, "60 seconds", CountRows, keyed=False))
    assert [(list(r["keys"]), bytes(r.value)) for r in out.collect()] == [([], b"3")]


@pytest.mark.parametrize("seed", range(2))
def test_early_sum_of_shuffled_rows_equals_the_fold(spark, tmp_path, seed):
    rnd = random.Random(seed)
    times = sorted(rnd.sample(range(1, 3000), 60))
    data = [(k, t, rnd.randint(-5, 9)) for t in times for k in "ab"]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(data)], "i long, k string, s long, v long")
    raw = replay(df, [F.col("s") <= 1000, F.col("s").between(1001, 2000), F.col("s") > 2000])
    rows = E.to_envelope(raw, keep=["i", "v"], keys=E.strings(F.col("k")), event_time=F.timestamp_seconds("s"))
    rows = rows.withWatermark("event_time", "100 seconds")
    out = result(SR.early_sum_stream(rows, "20 minutes", F.col("v"), F.col("i"), 20, bucket="5 minutes"))
    got = sorted((int(r.window.start.timestamp()), r["keys"][0], r.emit, r.total, r.final) for r in out.collect())
    mark = max(times) - 100
    want = []
    for start in (0, 1200, 2400):
        for k in "ab":
            acc, emit = 0, 0
            for key, t, v in data:
                if key != k or not start <= t < start + 1200 or (start + 1200 > mark and (t // 300 + 1) * 300 > mark):
                    continue
                acc += v
                if acc >= 20:
                    emit += 1
                    want.append((start, k, emit, acc, False))
                    acc = 0
            if start + 1200 <= mark:
                want.append((start, k, emit + 1, acc, True))
    assert got == sorted(want)


def test_late_batches_replay_and_split(spark, tmp_path):
    batch = lambda *s: spark.createDataFrame([(x,) for x in s], "s long").select("s", F.timestamp_seconds("s").alias("event_time"))
    write = late.late_batches(str(tmp_path), "10 seconds")
    for i, rows in enumerate([(100, None), (90, 91, None), (95, 200), (189, 191)]):
        for _ in range(2):  # a replayed batch overwrites itself
            write(batch(*rows), i)
    on_time, behind = late.split_rows(spark, str(tmp_path))
    assert sorted(r.s for r in behind.collect()) == [90, 189]
    assert sorted(r.s or 0 for r in on_time.collect()) == [0, 0, 91, 95, 100, 191, 200]


class Words:
    """Says each row at once, and the number of rows at the end."""

    def __init__(self, mark=""):
        self.count, self.mark = 0, mark

    async def session_reduce(self, keys, datums):
        async for d in datums:
            self.count += 1
            yield Message(self.mark.encode() + d.value)
        yield Message(f"{self.count} rows".encode(), keys=keys)

    async def accumulator(self):
        return str(self.count).encode()

    async def merge_accumulator(self, held):
        self.count += int(held)


def _sessions(spark, n):
    df = spark.createDataFrame([(str(i), "a", 1 + i * 7 + (100 if i >= n // 2 else 0)) for i in range(n)], "id string, k string, s long")
    return E.to_envelope(
        df, id=F.col("id"), keys=E.strings(F.col("k")), value=S.text_to_bytes(F.col("id")), event_time=F.timestamp_seconds("s")
    )


def test_session_form_reads_rows_and_hands_over(spark):
    rows = _sessions(spark, 600).repartition(4)
    out = G.session_handler(rows, "10 seconds", session_form(Words, ("w",)), block=4).collect()
    by = {}
    for r in out:
        by.setdefault(r.window.start, []).append(bytes(r.value).decode())
    first, second = (by[k] for k in sorted(by))
    assert first[-1] == second[-1] == "300 rows"
    assert sorted(first[:-1]) == sorted(f"w{i}" for i in range(300)) and sorted(second[:-1]) == sorted(f"w{i}" for i in range(300, 600))


def test_session_form_on_a_stream_bridges_sessions(spark, tmp_path):
    rows = files(spark, tmp_path / "in", [("a", 1), ("a", 21)], [("a", 11)], [("a", END)])
    out = result(stateful.session_handler_stream(rows, "10 seconds", session_form(Words)))
    assert [bytes(r.value) for r in out.orderBy("window", "pos").collect()][-1] == b"3 rows"


def test_session_form_raises_what_the_handler_raises():
    class Bad(Words):
        async def session_reduce(self, keys, datums):
            async for _ in datums:
                raise ValueError("no")
            yield Message()

    session = session_form(Bad)()
    session.add(type("Row", (), {"keys": ["a"], "value": b""})())
    with pytest.raises(ValueError, match="no"):
        session.state()
    with pytest.raises(TypeError, match="accumulator"):
        session_form(CountRows)


def test_captured_group_keeps_its_earlier_output(spark):
    rows = _sessions(spark, 20)

    def handler(keys, datums, window):
        for d in datums:
            if d.id == "5":
                raise KeyError("five")
            yield Message(d.value, keys=keys)

    out = G.reduce_handler(rows, "1 hour", handler, on_error="capture", container="mine").collect()
    assert [bytes(r.value) for r in out if r.error is None] == [b"0", b"1", b"2", b"3", b"4"]
    (bad,) = [r for r in out if r.error is not None]
    assert bad.error.message == "KeyError: 'five'" and bad.error.container == "mine" and bad["keys"] == ["a"] and bad.window is not None
    with pytest.raises(Exception, match="five"):
        G.reduce_handler(rows, "1 hour", handler).collect()


def test_captured_sink_failure_keeps_answers(spark):
    rows = _sessions(spark, 6).select("id", "value").coalesce(1)

    def handler(datums):
        for d in datums:
            if d.id == "4":
                raise OSError("gone")
            yield Response.success(d.id)

    out = {r.id: (r.status, r.error and r.error.message) for r in sinks.sink_handler(rows, handler, on_error="capture").collect()}
    assert [out[str(i)][0] for i in range(6)] == ["SUCCESS"] * 4 + ["FAILURE"] * 2
    assert out["5"][1] == "OSError: gone"


def test_open_windows_at_an_earlier_batch(spark, tmp_path):
    rows = files(spark, tmp_path / "in", [("a", 1)], [("a", 70)], [("a", END)])
    out = rows.groupBy(F.window("event_time", "60 seconds")).count()
    run.run_to_table(out, partitions=2, checkpoint=str(tmp_path / "check"))
    held = lambda batch: sorted(int(r.window.start.timestamp()) for r in late.open_windows(spark, str(tmp_path / "check"), batch_id=batch).collect())
    assert held(0) == [0] and held(1) == [0, 60] and held(None) == [END // 60 * 60]


def test_acknowledged_offsets_survive_a_kill_and_fold(spark, tmp_path):
    rows = spark.range(60).select("id", (F.col("id") % 2).alias("p"))
    batches = [rows.filter(f"id >= {i * 10} and id < {i * 10 + 10}") for i in range(6)]
    log = lambda: OffsetLog(spark, str(tmp_path / "log"), every=2)
    done = []

    def write(batch, batch_id):
        if batch_id == 3 and len(done) == 3:
            raise RuntimeError("killed")
        done.append(batch_id)

    each = acknowledging(write, log(), F.col("p"), F.col("id"))
    assert log().acknowledged().count() == 0 and unacknowledged(rows, log(), F.col("p"), F.col("id")).count() == 60
    for i in range(3):
        each(batches[i], i)
    with pytest.raises(RuntimeError, match="killed"):
        each(batches[3], 3)
    done.append("restart")
    assert sorted(map(tuple, log().acknowledged().collect())) == [(0, 28, 15), (1, 29, 15)]
    assert sorted(r.id for r in unacknowledged(rows, log(), F.col("p"), F.col("id")).collect()) == list(range(30, 60))
    for i in (0, 2, 3, 3, 4, 5):  # replays change nothing
        each(batches[i], i)
    assert sorted(map(tuple, log().acknowledged().collect())) == [(0, 58, 30), (1, 59, 30)]
    assert len(log().entries()) <= 3
    with pytest.raises(ValueError, match="positive"):
        OffsetLog(spark, "x", every=0)


def test_redelivery_keeps_the_order_of_a_key(spark, tmp_path):
    rows = files(spark, tmp_path / "in", [("a", 1), ("a", 2), ("b", 1)], [("a", 3), ("c", 4)]).select("id", "keys", "event_time", "s")

    def handler(datums):
        for d in datums:
            refuse = d.keys == ["a"] and ((d.s == 1 and d.attempt < 1) or d.s == 2)
            yield Response.failure(d.id, "no") if refuse else Response.success(d.id)

    out = redelivery.run_until_empty(redelivery.redeliver(rows, handler, tries=2, pause_ms=20), partitions=2, at_most=120)
    got = {(r["keys"][0], r.s): (r.attempts, r.outcome) for r in out.collect()}
    assert got == {("a", 1): (2, "taken"), ("a", 2): (2, "dead"), ("a", 3): (1, "taken"), ("b", 1): (1, "taken"), ("c", 4): (1, "taken")}
    with pytest.raises(ValueError, match="positive"):
        redelivery.redeliver(rows, handler, tries=0)
