from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from msgflow.functions import scalars as S


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


@pytest.mark.parametrize("data", [b"", b"\x01", b"\x00\x01", b"\xff" * 7, b"\xff" * 7 + b"\x7f"])
def test_little_endian(spark, data):
    assert one(spark, S.le_bytes_to_int(F.lit(data))) == int.from_bytes(data, "little")


def test_little_endian_too_long(spark):
    with pytest.raises(Exception, match="longer than 8 bytes"):
        one(spark, S.le_bytes_to_int(F.lit(b"\x00" * 9)))


def test_little_endian_round_trip(spark):
    df = spark.range(0, 3000, 7)
    assert df.filter(S.le_bytes_to_int(S.int_to_le_bytes("id")) != F.col("id")).count() == 0


def test_text_numbers(spark):
    assert one(spark, S.text_to_int(F.lit(b"42"))) == 42
    assert one(spark, S.text_to_int(F.lit(b"x"), strict=False)) is None
    with pytest.raises(Exception):
        one(spark, S.text_to_int(F.lit(b"x")))


def test_primes(spark):
    got = {r.id: (r.loose, r.exact) for r in spark.range(0, 400).select(
        "id", S.is_prime("id").alias("loose"), S.is_prime("id", strict=True).alias("exact")).collect()}
    for n, (loose, exact) in got.items():
        assert loose == all(n % i for i in range(2, math.ceil(math.sqrt(n)))), n
        assert exact == (n > 1 and all(n % i for i in range(2, n))), n
    assert got[4][0] and got[9][0] and got[25][0]


def test_split_keeps_empty_parts(spark):
    assert one(spark, S.split_text(F.lit(""))) == [""]
    assert one(spark, S.split_text(F.lit("a,,"))) == ["a", "", ""]


def test_clamp(spark):
    def text(seconds):
        return one(spark, S.clamp_epoch_seconds(F.lit(seconds)).cast("string"))

    assert text(8210266876799) == "9999-12-31 23:59:59.999999"
    assert text(-8210266876799) == "0001-01-01 00:00:00"
    assert text(1662998400) == "2022-09-12 16:00:00"


def test_payload_text(spark):
    at = F.timestamp_seconds(F.lit(1662998400))
    later = F.timestamp_seconds(F.lit(1662998460))
    want = "payload:test_mock_message event_time:2022-09-12 16:00:00+00:00 watermark:2022-09-12 16:01:00+00:00"
    assert one(spark, S.payload_text(F.lit(b"test_mock_message"), at, later)) == want
