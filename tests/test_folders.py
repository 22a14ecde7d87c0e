"""Stream and source queries over a table that is a folder of files, and silences of any length."""

from __future__ import annotations

import datetime as dt
import functools
import os

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from msgflow.operators import watermarks as WM
from msgflow.streaming import run
from tests.oracle import compare, connect

BASE = "/root/testdata/sf0.001"
NAMES = ["stream_reduce", "stream_transform", "stream_sessions", "stream_sink_routes", "source_read", "source_stream", "source_pushdown"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("tables")
    (base / "events.parquet").mkdir()
    events = pq.read_table(f"{BASE}/events.parquet")
    third = events.num_rows // 3
    for i in range(3):
        part = events.slice(i * third, third if i < 2 else None)
        pq.write_table(part, base / "events.parquet" / f"part-{i}.parquet", row_group_size=100)
    return str(base)


@pytest.mark.parametrize("name", NAMES)
def test_folder_table(spark, folder, name):
    assert compare(entry.queries()[name](spark, folder), connect(BASE), entry.oracle_sql()[name]) is None


STATEFUL = [
    "stream_reduce", "stream_transform", "stream_sessions", "stream_session_handler", "stream_sorter", "stream_early_counter",
    "stream_reduce_handler", "stream_accumulator", "stream_sink_routes",
]


@pytest.fixture(scope="module")
def in_order(tmp_path_factory):
    """The events in time order, four files."""
    base = tmp_path_factory.mktemp("ordered")
    (base / "events.parquet").mkdir()
    events = pq.read_table(f"{BASE}/events.parquet").sort_by([("ts", "ascending"), ("event_id", "ascending")])
    part = -(-events.num_rows // 4)
    for i in range(4):
        pq.write_table(events.slice(i * part, part), base / "events.parquet" / f"part-{i}.parquet")
        os.utime(base / "events.parquet" / f"part-{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return str(base)


@pytest.mark.parametrize("name", STATEFUL)
def test_one_file_a_micro_batch(spark, in_order, monkeypatch, name):
    monkeypatch.setattr(run, "read_parquet_stream", functools.partial(run.read_parquet_stream, files_per_batch=1))
    assert compare(entry.queries()[name](spark, in_order), connect(BASE), entry.oracle_sql()[name]) is None


def test_heartbeats_of_long_silences(spark, monkeypatch):
    rows = "(0, timestamp'0001-01-01 00:00:00'), (0, timestamp'2024-01-01 00:00:00'), (0, timestamp'2024-01-01 00:01:40')"
    df = spark.sql(f"SELECT * FROM VALUES {rows} AS t(source, event_time)")
    monkeypatch.setattr(WM, "CHUNK", 7)
    beats = WM.idle_heartbeats(df, ["source"], ["event_time"], threshold="10 seconds", step="1 second", increment="1 second")
    got = sorted(r.heartbeat_at for r in beats.collect())
    start = dt.datetime(2024, 1, 1)
    assert got == [start + dt.timedelta(seconds=10 + k) for k in range(91)]
