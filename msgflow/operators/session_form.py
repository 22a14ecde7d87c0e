"""Session reducers that read their session row by row and can hand over what they have midway.

A handler class has ``session_reduce(keys, datums)``, an async generator of messages over an async iterator of rows, and the
coroutines ``accumulator() -> bytes`` and ``merge_accumulator(bytes)``. :func:`session_form` makes it a mergeable handler,
so that sessions of any size combine before their shuffle, on tables (``group_handlers.session_handler``) and on streams
(``stateful.session_handler_stream``): a stretch of rows is fed to one instance, which hands over its accumulator when the
stretch has to join others; the instance that ends a session merges the accumulators and then finds no more rows.
"""

from __future__ import annotations

import asyncio
import inspect
import pickle
import sys
from collections import deque
from collections.abc import AsyncIterator, Coroutine, Iterable
from typing import Any

from msgflow.message import Datum, Interval, Message

CHUNK = 256  # rows that wait before the handler reads them


class _Feed:
    """Rows for an async reader, who waits where there are none yet."""

    def __init__(self) -> None:
        self.rows: deque[Datum] = deque()
        self.ended = False
        self.waiter: asyncio.Future | None = None

    def waiting(self) -> bool:
        return not self.rows and self.waiter is not None and not self.waiter.done()

    def end(self) -> None:
        self.ended = True
        self._wake()

    def _wake(self) -> None:
        if self.waiter is not None and not self.waiter.done():
            self.waiter.set_result(None)

    def __aiter__(self) -> AsyncIterator[Datum]:
        return self

    async def __anext__(self) -> Datum:
        while not self.rows:
            if self.ended:
                raise StopAsyncIteration
            self.waiter = asyncio.get_running_loop().create_future()
            await self.waiter
        return self.rows.popleft()


_loops: list[asyncio.AbstractEventLoop] = []  # of this process: many sessions are open at once


def _loop() -> asyncio.AbstractEventLoop:
    if not _loops or _loops[0].is_closed():
        _loops[:] = [asyncio.new_event_loop()]
    return _loops[0]


def _task(work: Coroutine) -> asyncio.Task:
    """A task that runs at once up to where it waits; older Pythons begin it a turn later."""
    loop = asyncio.get_running_loop()
    return asyncio.Task(work, loop=loop, eager_start=True) if sys.version_info >= (3, 12) else loop.create_task(work)


async def _ended(tasks: list[asyncio.Task]) -> None:
    """Wait for cancelled tasks, whatever they end with."""
    await asyncio.sleep(0)
    if left := [t for t in tasks if not t.done()]:
        await asyncio.wait(left)
    for t in tasks:
        if not t.cancelled():
            t.exception()


class _Session:
    """One instance of the handler, fed a chunk of rows at a time.

    ``states``, ``merges`` and ``results`` serve many sessions in one run of the event loop: a run of its own for each step
    of each session costs far more than the step. Each session still has its own task.
    """

    build: Any = None

    def __init__(self) -> None:
        self.handler = type(self).build()
        self.feed = _Feed()
        self.task: asyncio.Task | None = None
        self.fed = False
        self.keys: list[str] = []
        self.out: list[Message] = []

    async def _read(self) -> None:
        async for message in self.handler.session_reduce(self.keys, self.feed):
            self.out.append(message)

    async def _drain(self) -> None:
        """Let the handler read until it waits for another row, or has ended."""
        if not self.fed:
            return
        if self.task is None:
            self.task = _task(self._read())
        elif self.feed.rows:
            self.feed._wake()
        while not self.task.done() and not self.feed.waiting():
            await asyncio.sleep(0)
        if self.task.done():
            self.task.result()

    def add(self, datum: Datum) -> None:
        if not self.fed:
            self.fed, self.keys = True, datum.keys
        self.feed.rows.append(datum)
        if len(self.feed.rows) >= CHUNK:
            _loop().run_until_complete(self._drain())

    def state(self) -> bytes:
        return type(self).states([self])[0]

    @classmethod
    def states(cls, sessions: list[_Session]) -> list[bytes]:
        """What each handler has said and what it holds; they read no more rows."""

        async def held() -> list[Any]:
            found, open_tasks = [], []
            for session in sessions:
                await session._drain()
                found.append(await session.handler.accumulator())
                if session.task is not None and not session.task.done():
                    session.task.cancel()
                    open_tasks.append(session.task)
            if open_tasks:
                await _ended(open_tasks)
            return found

        return [pickle.dumps((s.out, h)) for s, h in zip(sessions, _loop().run_until_complete(held()))]

    def merge(self, state: bytes) -> None:
        type(self).merges([(self, [state])])

    @classmethod
    def merges(cls, pairs: list[tuple[_Session, Iterable[bytes]]]) -> None:
        """Add states to what each handler holds."""

        async def merged() -> None:
            for session, states in pairs:
                await session._drain()
                for state in states:
                    said, held = pickle.loads(state)
                    session.out.extend(said)
                    await session.handler.merge_accumulator(held)

        _loop().run_until_complete(merged())

    def result(self, keys: list[str], window: Interval) -> Iterable[Message]:
        return type(self).results([(self, keys, window)])[0]

    @classmethod
    def results(cls, calls: list[tuple[_Session, list[str], Interval]]) -> list[Iterable[Message]]:
        """Let each handler read to the end of its session."""

        async def read() -> None:
            for session, keys, _ in calls:
                if not session.fed:
                    session.fed, session.keys = True, keys
                session.feed.end()
                if session.task is None:
                    session.task = _task(session._read())
                await session.task

        _loop().run_until_complete(read())
        return [session.out for session, _, _ in calls]


def session_form(handler: type, init_args: tuple = (), init_kwargs: dict | None = None) -> type:
    """The mergeable handler class of a session reducer.

    Messages that the handler yields before its rows end travel with the accumulator and come out with the session, before
    those of its end.
    """
    if not inspect.isclass(handler):
        raise TypeError("a session reducer must be a class: each stretch gets its own")
    missing = [m for m in ("session_reduce", "accumulator", "merge_accumulator") if not callable(getattr(handler, m, None))]
    if missing:
        raise TypeError(f"{handler.__name__} lacks {', '.join(missing)}")
    kwargs = init_kwargs or {}

    class Session(_Session):
        build = staticmethod(lambda: handler(*init_args, **kwargs))

    return Session
