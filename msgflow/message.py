"""What Python handlers receive and return."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any, NamedTuple

from msgflow import constants as C


def _check(value: Any, keys: Any, tags: Any) -> None:
    if not isinstance(value, bytes | bytearray):
        raise TypeError(f"value must be bytes, not {type(value).__name__}")
    for name, items in (("keys", keys), ("tags", tags)):
        if not isinstance(items, list) or not all(isinstance(i, str) for i in items):
            raise TypeError(f"{name} must be a list of str")


def _utc(t: Any) -> datetime | None:
    if t is None:
        return None
    if not isinstance(t, datetime):
        raise TypeError(f"times must be datetime, not {type(t).__name__}")
    return t if t.tzinfo else t.replace(tzinfo=timezone.utc)


@dataclass(slots=True)
class Message:
    """One output row. Only what is set here leaves a handler: nothing is inherited from the input."""

    value: bytes = b""
    keys: list[str] | None = None
    tags: list[str] | None = None
    user_metadata: dict[str, dict[str, bytes]] | None = None
    event_time: datetime | None = None
    watermark: datetime | None = None
    headers: dict[str, str] | None = None
    id: str | None = None

    def __post_init__(self) -> None:
        self.value = self.value or b""
        self.keys = self.keys or []
        self.tags = self.tags or []
        _check(self.value, self.keys, self.tags)
        self.event_time, self.watermark = _utc(self.event_time), _utc(self.watermark)

    @classmethod
    def drop(cls, event_time: datetime | None = None) -> Message:
        return cls(b"", tags=[C.DROP], event_time=event_time)

    @classmethod
    def of(cls, datum: Datum, **changes: Any) -> Message:
        """A copy of an input row, with changes; tags start empty."""
        fields = {n: getattr(datum, n) for n in ("value", "keys", "event_time", "watermark", "headers", "id")}
        return cls(**{**fields, **changes})


class Datum:
    """One input row. Columns that were not sent to the handler read as None."""

    __slots__ = ("_row",)
    _maps = ("headers", "user_metadata", "system_metadata")

    def __init__(self, row: dict[str, Any]) -> None:
        self._row = row

    def __getattr__(self, name: str) -> Any:
        value = self._row.get(name)
        if name in self._maps and value is not None:
            value = dict(value)
            if name != "headers":
                value = {g: dict(kv or []) for g, kv in value.items()}
        return value

    def __reduce__(self):
        return Datum, (self._row,)


class Interval(NamedTuple):
    """The window given to a reduce handler."""

    start: datetime
    end: datetime


@dataclass
class BatchResponse:
    """The outputs of one row of a batch."""

    id: str
    messages: list[Message] = field(default_factory=list)


def make_factory(handler: Any, init_args: tuple = (), init_kwargs: dict | None = None) -> Callable[[], Callable]:
    """A function that gives the callable for one group: a class is built anew each time.

    A function with constructor arguments, or an instance of a handler class where a class is
    expected to be built, is a TypeError.
    """
    kwargs = init_kwargs or {}
    if inspect.isclass(handler):
        if not callable(getattr(handler, "handler", None)):
            raise TypeError(f"{handler.__name__} has no handler method")
        return lambda: handler(*init_args, **kwargs).handler
    if not inspect.isroutine(handler) and callable(getattr(handler, "handler", None)):
        raise TypeError("pass the handler class, not an instance: each group gets its own")
    if not callable(handler):
        raise TypeError(f"a handler must be a function or a class, not {type(handler).__name__}")
    if init_args or kwargs:
        raise TypeError("constructor arguments need a handler class, not a function")
    return lambda: handler


def row_function(handler: Any) -> Callable:
    """The callable of a map-like handler: a function, a callable, or an object with ``handler``."""
    method = getattr(handler, "handler", None)
    if callable(method) and not inspect.isclass(handler):
        return method
    if inspect.isclass(handler) or not callable(handler):
        raise TypeError("a map handler must be a function, a callable or an object with a handler method")
    return handler


@dataclass
class Response:
    """What a sink handler answers for one row."""

    id: str
    status: str
    err_msg: str | None = None
    payload: bytes | None = None
    message: Message | None = None

    @classmethod
    def success(cls, id: str) -> Response:
        return cls(id, "SUCCESS")

    @classmethod
    def failure(cls, id: str, err_msg: str) -> Response:
        return cls(id, "FAILURE", err_msg=err_msg)

    @classmethod
    def fallback(cls, id: str) -> Response:
        return cls(id, "FALLBACK")

    @classmethod
    def on_success(cls, id: str, message: Message | None = None) -> Response:
        """``message`` replaces the row in the on-success sink; None sends the row itself."""
        return cls(id, "ON_SUCCESS", message=message)

    @classmethod
    def serve(cls, id: str, payload: bytes) -> Response:
        return cls(id, "SERVE", payload=payload)
