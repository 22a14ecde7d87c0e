"""Running aggregates, early sums and sessions: split groups must give what whole groups give."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from msgflow.operators import accumulate as A
from msgflow.operators import early as EA
from msgflow.operators import ordered as O
from msgflow.operators import session as SE
from msgflow.operators import watermarks as WM

START = datetime(2024, 1, 1)
SPLIT = {"hot_rows": 40}


def skewed(seed: int, n: int = 3000) -> list[tuple]:
    """One key holds a third of all rows, and one instant a third of that key."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if r.random() < 0.34 else f"k{r.randrange(30)}"
        second = 500 if key == "hot" and r.random() < 0.33 else r.randrange(1000)
        at = None if r.random() < 0.01 else START + timedelta(seconds=second)
        out.append((key, at, i, r.randrange(-5, 60) if r.random() < 0.95 else None))
    r.shuffle(out)
    return out


@pytest.fixture(scope="module", params=[1, 2])
def data(request):
    return skewed(request.param)


def frame(spark, data):
    return spark.createDataFrame(data, "k string, t timestamp, s bigint, v bigint")


def in_order(data):
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    low = datetime.min
    return {k: sorted(rows, key=lambda x: (x[1] or low, x[2])) for k, rows in groups.items()}


@pytest.mark.parametrize("exclusive", [False, True])
def test_running_against_brute_force(spark, data, exclusive):
    df = frame(spark, data)
    aggs = {
        "n": O.Running("count"),
        "nv": O.Running("count", F.col("v")),
        "sum": O.Running("sum", F.col("v")),
        "max": O.Running("max", F.col("v")),
        "min": O.Running("min", F.col("v")),
    }
    assert O.segmented(df, ["k"], ["t", "s"], **SPLIT) is not None
    got = {r.s: (r.n, r.nv, r["sum"], r["max"], r["min"]) for r in O.running(df, ["k"], ["t", "s"], aggs, exclusive=exclusive, **SPLIT).collect()}
    want = {}
    for rows in in_order(data).values():
        for i, row in enumerate(rows):
            seen = rows[: i if exclusive else i + 1]
            vals = [x[3] for x in seen if x[3] is not None]
            want[row[2]] = (
                len(seen), len(vals), sum(vals) if vals else None, max(vals, default=None), min(vals, default=None)
            )
    assert got == want


def test_segments_are_small_and_ordered(spark, data):
    seg = O.segmented(frame(spark, data), ["k"], ["t", "s"], **SPLIT)
    rows = seg.filter("_hot").orderBy("k", F.col("t").asc_nulls_first(), "s").select("k", "_seg").collect()
    assert rows
    sizes = defaultdict(int)
    last = {}
    for r in rows:
        s = tuple(r._seg)
        assert last.get(r.k, s) <= s
        last[r.k] = s
        sizes[r.k, s] += 1
    assert max(sizes.values()) <= 4 * SPLIT["hot_rows"]


def test_no_split_without_hot_groups(spark, data):
    assert O.segmented(frame(spark, data), ["k"], ["t", "s"]) is None
    plan = O.running_count(frame(spark, data), ["k"], ["t", "s"])._jdf.queryExecution().toString()
    assert "_seg" not in plan


def test_text_ties_are_allowed(spark, data):
    df = frame(spark, data).withColumn("s", F.format_string("%06d", "s"))
    whole = O.running_count(df, ["k"], ["t", "s"])
    assert O.running_count(df, ["k"], ["t", "s"], **SPLIT).exceptAll(whole).count() == 0


def sizes_in_order(seg, order):
    """Rows per segment; segments must ascend along the order."""
    rows = seg.filter("_hot").orderBy("k", *[F.col(c).asc_nulls_first() for c in order]).select("k", "_seg").collect()
    sizes, last = defaultdict(int), {}
    for r in rows:
        s = tuple(r._seg)
        assert last.get(r.k, s) <= s
        last[r.k] = s
        sizes[r.k, s] += 1
    return sizes


def test_one_instant_with_text_ids_is_split(spark):
    """All rows of the hot key at one instant, ids of several lengths with a long common start."""
    r = random.Random(3)
    ids = [f"event-of-the-day-{i}" + "\u00e9" * r.randrange(3) + "\0" * r.randrange(3) for i in range(2000)]
    df = spark.createDataFrame([("hot", START, i) for i in [*ids, None, ""]] + [("k", START, "x")], "k string, t timestamp, id string")
    sizes = sizes_in_order(O.segmented(df, ["k"], ["t", "id"], **SPLIT), ["t", "id"])
    assert sum(sizes.values()) == 2002 and max(sizes.values()) <= 3 * SPLIT["hot_rows"]
    whole = O.running_count(df, ["k"], ["t", "id"])
    assert O.running_count(df, ["k"], ["t", "id"], **SPLIT).exceptAll(whole).count() == 0


def test_big_pieces_are_cut_again(spark, data, monkeypatch):
    monkeypatch.setattr(O, "PIECES", 4)
    df = frame(spark, data)
    sizes = sizes_in_order(O.segmented(df, ["k"], ["t", "s"], **SPLIT), ["t", "s"])
    assert max(sizes.values()) <= 3 * SPLIT["hot_rows"]
    whole = O.running_count(df, ["k"], ["t", "s"])
    assert O.running_count(df, ["k"], ["t", "s"], **SPLIT).exceptAll(whole).count() == 0


def test_a_small_share_of_many_rows_is_split(spark):
    """A bound in rows alone: 200 rows of 100,000 are hot where 40 are the bound."""
    rows = spark.range(100_000).select(
        F.when(F.col("id") < 200, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.timestamp_seconds("id").alias("t"), F.col("id").alias("s"),
    )
    sizes = sizes_in_order(O.segmented(rows, ["k"], ["t", "s"], **SPLIT), ["t", "s"])
    assert sum(sizes.values()) == 200 and max(sizes.values()) <= 2 * SPLIT["hot_rows"]


def test_large_numbers_are_told_apart(spark):
    """Ties beyond 2^53, where quantiles as doubles can't tell neighbours apart."""
    rows = spark.range(500).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.lit(5)).alias("t"), (F.col("id") + 2**62).alias("s"))
    sizes = sizes_in_order(O.segmented(rows, ["k"], ["t", "s"], **SPLIT), ["t", "s"])
    assert sum(sizes.values()) == 500 and max(sizes.values()) <= 3 * SPLIT["hot_rows"]


def test_large_cut_tables_are_not_broadcast(spark, data, monkeypatch):
    monkeypatch.setattr(O, "BROADCAST_BYTES", 0)
    df = frame(spark, data)
    out = O.running_count(df, ["k"], ["t", "s"], **SPLIT)
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()
    assert out.exceptAll(O.running_count(df, ["k"], ["t", "s"])).count() == 0


def test_text_first_order_column_is_refused(spark, data):
    with pytest.raises(TypeError):
        O.running_count(frame(spark, data), ["k"], ["k"])


def test_shuffle_key_includes_the_segment(spark, data):
    plan = O.running_count(frame(spark, data), ["k"], ["t", "s"], **SPLIT)._jdf.queryExecution().toString()
    assert "hashpartitioning(k#" in plan and "_seg#" in plan.split("hashpartitioning(")[1]


# Early results -------------------------------------------------------------------


def test_early_counter_fixture(spark):
    df = spark.range(10).select(F.lit("k").alias("k"))
    rows = EA.early_counter(df, ["k"], threshold=2).orderBy("emit").collect()
    assert [(r.counter, r.final) for r in rows] == [(3, False)] * 3 + [(1, True)]


def test_early_counter_with_nothing_left(spark):
    df = spark.range(9).select(F.lit("k").alias("k"))
    assert [(r.counter, r.final) for r in EA.early_counter(df, ["k"], threshold=2).orderBy("emit").collect()][-1] == (0, True)


def test_early_every(spark):
    df = spark.range(25).select(F.lit("k").alias("k"))
    rows = EA.early_every(df, ["k"]).orderBy("emit").collect()
    assert [(r.counter, r.final) for r in rows] == [(10, False), (20, False), (25, True)]


def test_many_emissions_are_chunked(spark, monkeypatch):
    monkeypatch.setattr(EA, "CHUNK", 7)
    df = spark.range(100).select(F.lit("k").alias("k"))
    rows = EA.early_every(df, ["k"], every=1).filter("not final").orderBy("emit").collect()
    assert [r.counter for r in rows] == list(range(1, 101))


def test_early_sum_fixture(spark):
    rows = [("k", START + timedelta(seconds=i), i, v) for i, v in enumerate([60, 50, 30, 80, 5])]
    out = EA.early_sum(frame(spark, rows), ["k"], ["t", "s"], "v").orderBy("emit").collect()
    assert [(r.total, r.final) for r in out] == [(110, False), (110, False), (5, True)]


@pytest.mark.parametrize("threshold", [100, 7])
def test_early_sum_split_equals_fold(spark, data, threshold):
    split = EA.early_sum(frame(spark, data), ["k"], ["t", "s"], "v", threshold, **SPLIT)
    got = defaultdict(list)
    for r in split.orderBy("k", "emit").collect():
        got[r.k].append((not r.final, r.total))
    want = {
        k: list(EA.fold_sum(0, (x[3] for x in rows if x[3] is not None), threshold)) for k, rows in in_order(data).items()
    }
    assert got == want


def test_early_sum_same_on_both_paths(spark, data):
    """Numbers and rows don't depend on splitting; nor do groups of NULLs alone."""
    nulls = [("none", START + timedelta(seconds=i), i, None) for i in range(50)]
    gap = [("gap", START + timedelta(seconds=i), i, None if 20 <= i < 60 else 9) for i in range(80)]
    rows = frame(spark, [*data, *nulls, *gap])
    names = ["k", "emit", "total", "final"]
    plain = EA.early_sum(rows, ["k"], ["t", "s"], "v", 50).select(names).collect()
    split = EA.early_sum(rows, ["k"], ["t", "s"], "v", 50, **SPLIT).select(names).collect()
    assert sorted(plain) == sorted(split)
    assert [tuple(r) for r in plain if r.k == "none"] == [("none", 1, 0, True)]


def test_early_sum_refuses(spark):
    with pytest.raises(TypeError):
        EA.early_sum(spark.createDataFrame([("k", 1, 1.5)], "k string, t int, v double"), ["k"], ["t"], "v")
    with pytest.raises(ValueError):
        EA.early_sum(spark.createDataFrame([("k", 1, 1)], "k string, t int, v int"), ["k"], ["t"], "v", 0)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.integers(-80, 150), max_size=60),
    st.integers(1, 120),
    st.integers(0, 60),
)
def test_sum_steps_compose(values, threshold, cut):
    floor = 2 * sum(min(v, 0) for v in values) - 3
    step = EA.SumStep(threshold, floor)
    step.feed(np.array(values[:cut], dtype=np.int64))
    step.feed(np.array(values[cut:], dtype=np.int64))
    for acc in range(floor, threshold):
        want = list(EA.fold_sum(acc, values, threshold))[-1][1]
        assert EA.apply_step(acc, step.lows, step.outs(), step.total) == want


# Sessions ------------------------------------------------------------------------


def brute_sessions(times: list[int], gap: int):
    out = []
    for t in sorted(times):
        if out and t - out[-1][1] <= gap:
            out[-1][1] = t
            out[-1][2] += 1
        else:
            out.append([t, t, 1])
    return out


@pytest.mark.parametrize("block", [1, 2, 5, 4096])
@pytest.mark.parametrize("spread", [50, 2000, 100_000])
def test_sessions_against_brute_force(spark, block, spread):
    r = random.Random(block * spread)
    data = [("hot" if r.random() < 0.4 else f"k{r.randrange(5)}", r.randrange(spread)) for _ in range(800)]
    df = spark.createDataFrame(data, "k string, s bigint").withColumn("event_time", F.timestamp_seconds("s"))
    out = SE.session_reduce(df, "30 seconds", {"n": SE.Mergeable("count")}, by=["k"], block=block)
    got = sorted(
        (x.k, x.a, x.b - 30, x.n)
        for x in out.select("k", F.unix_seconds("window.start").alias("a"), F.unix_seconds("window.end").alias("b"), "n").collect()
    )
    groups = defaultdict(list)
    for k, s in data:
        groups[k].append(s)
    assert got == sorted((k, *s) for k, times in groups.items() for s in brute_sessions(times, 30))


def test_session_gap_boundary(spark):
    df = spark.createDataFrame([(0,), (30_000_000,), (60_000_001,)], "u bigint")
    df = df.select(F.lit("k").alias("k"), F.timestamp_micros("u").alias("event_time"))
    out = SE.session_reduce(df, "30 seconds", {"n": SE.Mergeable("count")}, by=["k"])
    assert sorted(r.n for r in out.collect()) == [1, 2]
    native = SE.session_reduce_stream(df, "30 seconds", F.count(F.lit(1)).alias("n"), by=["k"])
    assert sorted(r.n for r in native.collect()) == [1, 2]


def test_sessions_equal_native_ones(spark, data):
    df = frame(spark, data).filter("t is not null").withColumnRenamed("t", "event_time")
    aggs = {"n": SE.Mergeable("count"), "v": SE.Mergeable("sum", F.col("v"))}
    ours = SE.session_reduce(df, "3 seconds", aggs, by=["k"], block=3).select("window.start", "window.end", "k", "n", "v")
    native = SE.session_reduce_stream(
        df, "3 seconds", F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"), by=["k"]
    ).select("window.start", "window.end", "k", "n", "v")
    assert ours.exceptAll(native).count() == 0 and native.exceptAll(ours).count() == 0


def test_close_on_timeout(spark):
    df = spark.createDataFrame([("a", 0), ("a", 5), ("a", 100), ("b", 7)], "k string, s bigint")
    df = df.withColumn("event_time", F.timestamp_seconds("s"))
    out = A.close_on_timeout(df, "10 seconds", by=["k"])
    got = sorted((r.k, r.e, r["rows"], r.eof) for r in out.select("k", F.unix_seconds("window.end").alias("e"), "rows", "eof").collect())
    assert got == [("a", 15, 2, True), ("a", 110, 1, True), ("b", 17, 1, True)]


# Accumulators and watermarks -------------------------------------------------------


def test_output_window_is_monotone_and_ignores_nulls(spark):
    wms = [None, 5, 3, None, 9]
    rows = [("k", i, w) for i, w in enumerate(wms)]
    df = spark.createDataFrame(rows, "k string, s bigint, w bigint").select(
        "k", "s", F.timestamp_seconds("s").alias("event_time"), F.timestamp_seconds("w").alias("watermark")
    )
    out = A.output_window(df, ["k"], ["event_time", "s"])
    got = [tuple(r) for r in out.orderBy("s").select(F.unix_seconds("window.start"), F.unix_seconds("window.end")).collect()]
    assert got == [(0, 0), (0, 5), (0, 5), (0, 5), (0, 9)]


def test_sorter_fixture(spark):
    df = spark.createDataFrame([("k", t) for t in (30, 10, 20, 40)], "k string, s bigint")
    df = df.withColumn("event_time", F.timestamp_seconds("s"))
    assert [r.s for r in A.sort_stream(df, ["k"], ["event_time"]).collect()] == [10, 20, 30, 40]


def test_sort_spreads_a_hot_key(spark, data):
    df = frame(spark, data).filter("k = 'hot'")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = A.sort_stream(df, ["k"], ["t", "s"]).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert parts > 1


def test_late_rows_against_brute_force(spark, data):
    rows = [(r[0], r[1] or START, r[2]) for r in data]
    df = spark.createDataFrame(rows, "k string, event_time timestamp, s bigint")
    marked = WM.with_watermark_column(df, ["k"], ["s"], "100 seconds", **SPLIT)
    on_time, late = WM.split_late(marked)
    want, top = set(), {}
    for k, t, s in sorted(rows, key=lambda x: x[2]):
        top[k] = max(top.get(k, t), t)
        if t < top[k] - timedelta(seconds=100):
            want.add(s)
    assert {r.s for r in late.collect()} == want
    assert on_time.count() + late.count() == len(rows) and want


def test_heartbeats(spark):
    df = spark.createDataFrame([("a", 0), ("a", 100), ("b", 0), ("b", 19)], "p string, s bigint")
    df = df.withColumn("event_time", F.timestamp_seconds("s"))
    out = WM.idle_heartbeats(
        df, ["p"], ["event_time", "s"], threshold="20 seconds", step="30 seconds", increment="40 seconds"
    )
    got = sorted(tuple(r) for r in out.select("p", F.unix_seconds("heartbeat_at"), F.unix_seconds("watermark")).collect())
    assert got == [("a", 20, 40), ("a", 50, 80), ("a", 80, 100)]


def test_arrival_order_does_not_matter(spark, data):
    df = frame(spark, data)
    again = frame(spark, list(reversed(data)))
    for make in (
        lambda d: O.running_count(d, ["k"], ["t", "s"]).select("s", "counter"),
        lambda d: EA.early_sum(d, ["k"], ["t", "s"], "v", 50),
    ):
        assert make(df).exceptAll(make(again)).count() == 0
