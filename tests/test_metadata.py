from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from msgflow.functions import metadata as M


def value(spark, col):
    got = spark.range(1).select(col.alias("x")).first().x
    return {g: {k: bytes(v) for k, v in kv.items()} for g, kv in got.items()} if isinstance(got, dict) else got


def md(**groups):
    return M.meta_from_dict(groups)


CASES = [
    ("add to a new group", lambda: M.meta_add_key(md(), "g", "k", b"v"), {"g": {"k": b"v"}}),
    ("add to a group", lambda: M.meta_add_key(md(g={"a": "1"}), "g", "k", "v"), {"g": {"a": b"1", "k": b"v"}}),
    ("overwrite", lambda: M.meta_add_key(md(g={"k": "1"}), "g", "k", "2"), {"g": {"k": b"2"}}),
    ("same key in two groups", lambda: M.meta_add_key(md(g={"k": "1"}), "h", "k", "2"), {"g": {"k": b"1"}, "h": {"k": b"2"}}),
    ("remove key", lambda: M.meta_remove_key(md(g={"a": "1", "b": "2"}), "g", "a"), {"g": {"b": b"2"}}),
    ("remove last key", lambda: M.meta_remove_key(md(g={"a": "1"}, h={"b": "2"}), "g", "a"), {"h": {"b": b"2"}}),
    ("keep emptied group", lambda: M.meta_remove_key(md(g={"a": "1"}), "g", "a", keep_empty=True), {"g": {}}),
    ("remove absent key", lambda: M.meta_remove_key(md(g={"a": "1"}), "g", "z"), {"g": {"a": b"1"}}),
    ("absent key, empty group", lambda: M.meta_remove_key(M.meta_create_group(md(), "e"), "e", "z"), {"e": {}}),
    ("remove key of absent group", lambda: M.meta_remove_key(md(g={"a": "1"}), "z", "a"), {"g": {"a": b"1"}}),
    ("remove group", lambda: M.meta_remove_group(md(g={"a": "1"}, h={}), "g"), {"h": {}}),
    ("remove absent group", lambda: M.meta_remove_group(md(g={"a": "1"}), "z"), {"g": {"a": b"1"}}),
    ("set group", lambda: M.meta_set_group(md(g={"a": "1"}), "g", M.group_from({"b": "2"})), {"g": {"b": b"2"}}),
    ("create kept", lambda: M.meta_create_group(md(g={"a": "1"}), "g"), {"g": {"a": b"1"}}),
    ("delete group", lambda: M.meta_del_group(md(g={"a": "1"}), "g"), {}),
    ("clear", lambda: M.meta_clear(), {}),
    ("empty names and values", lambda: M.meta_add_key(md(), "", "", b""), {"": {"": b""}}),
    ("special characters", lambda: M.meta_add_key(md(), "g/ü", "k\n\t", "ä"), {"g/ü": {"k\n\t": "ä".encode()}}),
    ("large value", lambda: M.meta_add_key(md(), "g", "k", b"x" * 100_000), {"g": {"k": b"x" * 100_000}}),
    ("null metadata", lambda: M.meta_add_key(F.lit(None).cast(M.METADATA_TYPE), "g", "k", "v"), {"g": {"k": b"v"}}),
]


@pytest.mark.parametrize("make,want", [c[1:] for c in CASES], ids=[c[0] for c in CASES])
def test_algebra(spark, make, want):
    assert value(spark, make()) == want


def test_reads(spark):
    m = lambda: md(b={"k": "v", "a": "1"}, a={})
    assert value(spark, M.meta_groups(m())) == ["a", "b"]
    assert value(spark, M.meta_keys(m(), "b")) == ["a", "k"]
    assert value(spark, M.meta_keys(m(), "z")) == []
    assert bytes(value(spark, M.meta_value(m(), "b", "k"))) == b"v"
    assert value(spark, M.meta_value(m(), "z", "k")) is None
    assert value(spark, M.meta_contains(m(), "a")) is True
    assert value(spark, M.meta_len(m())) == 2
    assert value(spark, M.meta_get_group(m(), "z", strict=False)) is None


@pytest.mark.parametrize("make", [lambda: M.meta_get_group(md(), "z"), lambda: M.meta_del_group(md(), "z")])
def test_absent_group_fails_when_strict(spark, make):
    with pytest.raises(Exception, match="no such metadata group: z"):
        value(spark, make())


def test_many_groups(spark):
    groups = {f"g{i}": {f"k{j}": str(j) for j in range(5)} for i in range(40)}
    got = value(spark, M.meta_remove_key(M.meta_from_dict(groups), "g7", "k3"))
    assert len(got) == 40 and len(got["g7"]) == 4
