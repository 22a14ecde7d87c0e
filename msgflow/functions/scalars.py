"""Scalar helpers on payload, number and time columns. All are plain Column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from msgflow import constants as C

PYTHON_TIME = "yyyy-MM-dd HH:mm:ssxxx"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it.

    Without this, functions that use an argument several times multiply when they are chained.
    """
    return F.get(F.transform(F.array(value), body), 0)


def bytes_to_text(value: Column | str) -> Column:
    return F.decode(_col(value), "UTF-8")


def text_to_bytes(text: Column | str) -> Column:
    return F.encode(_col(text), "UTF-8")


def split_text(text: Column | str, delimiter: str = ",") -> Column:
    """Split on a literal delimiter, keeping trailing empty parts."""
    # Java regex quoting: re.escape output is valid there for every ASCII delimiter.
    return F.split(_col(text), re.escape(delimiter), -1)


def _swap_bytes(digits: Column) -> Column:
    """16 hex digits with the order of their byte pairs reversed."""
    return let(digits, lambda d: F.concat(*[F.substring(d, p, 2) for p in range(15, 0, -2)]))


def le_bytes_to_int(value: Column | str) -> Column:
    """Unsigned little-endian bytes as BIGINT. Empty is 0; more than 8 bytes is an error."""
    too_long = F.raise_error(F.lit("integer payload is longer than 8 bytes"))

    def number(v: Column) -> Column:
        digits = F.rpad(F.hex(v), 16, "0")
        return F.when(F.octet_length(v) > 8, too_long.cast("bigint")).otherwise(
            F.conv(_swap_bytes(digits), 16, 10).cast("bigint")
        )

    return let(_col(value), number)


def int_to_le_bytes(number: Column | str) -> Column:
    """BIGINT as 8 little-endian bytes."""
    return F.unhex(_swap_bytes(F.lpad(F.hex(_col(number).cast("bigint")), 16, "0")))


def text_to_int(value: Column | str, *, strict: bool = True) -> Column:
    """Text payload as BIGINT. A bad number fails the query, or is NULL with ``strict=False``."""
    text = bytes_to_text(value)
    return text.cast("bigint") if strict else text.try_cast("bigint")


def is_even(number: Column | str) -> Column:
    return _col(number) % 2 == 0


def is_prime(number: Column | str, *, strict: bool = False) -> Column:
    """Trial division inside Catalyst.

    The default keeps an exclusive square-root bound, under which squares of primes pass;
    ``strict=True`` is the mathematical test.
    """
    def test(n: Column) -> Column:
        root = F.ceil(F.sqrt(n.cast("double"))).cast("bigint")
        last = root if strict else root - 1
        divisible = F.exists(F.sequence(F.lit(2).cast("bigint"), last), lambda d: (n % d == 0) & (d < n))
        result = F.when(last < 2, F.lit(True)).otherwise(~divisible)
        return (n >= 2) & result if strict else result

    return let(_col(number).cast("bigint"), test)


def payload_text(value: Column | str, event_time: Column | str, watermark: Column | str) -> Column:
    return F.format_string(
        C.PAYLOAD_FORMAT,
        bytes_to_text(value),
        F.date_format(_col(event_time), PYTHON_TIME),
        F.date_format(_col(watermark), PYTHON_TIME),
    )


def window_text(fmt: str, number: Column, window: Column) -> Column:
    """A counter payload with the bounds of its window."""
    return F.format_string(
        fmt,
        number,
        F.date_format(window["start"], PYTHON_TIME),
        F.date_format(window["end"], PYTHON_TIME),
    )


def from_epoch_millis(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms).cast("bigint"))


def to_epoch_millis(ts: Column | str) -> Column:
    return F.unix_millis(_col(ts))


def clamp_epoch_seconds(seconds: Column | str) -> Column:
    """Epoch seconds as TIMESTAMP; values outside years 1 to 9999 take the nearest bound."""
    low = F.unix_seconds(F.lit(C.MISSING_EVENT_TIME).cast("timestamp"))
    high_ts = F.lit(C.MAX_TIME).cast("timestamp")

    def clamp(s: Column) -> Column:
        return F.when(s > F.unix_seconds(high_ts), high_ts).otherwise(F.timestamp_seconds(F.greatest(s, low)))

    return let(_col(seconds).cast("bigint"), clamp)


def payload_contains(value: Column | str, text: str) -> Column:
    return F.contains(bytes_to_text(value), F.lit(text))


def payload_equals(value: Column | str, text: str) -> Column:
    return _col(value) == text_to_bytes(F.lit(text))


def before(ts: Column | str, bound: str) -> Column:
    return _col(ts) < F.lit(bound).cast("timestamp")


def interval_micros(text: str) -> Column:
    """An interval such as '6 hours' as microseconds; folded to a constant."""
    zero = F.lit("1970-01-01").cast("timestamp")
    return F.unix_micros(zero + F.expr(f"interval {text}")) - F.unix_micros(zero)
