"""Periodic runs of words, found by dyadic square catching, and texts with their repeats collapsed.

A run is a longest stretch of consecutive words with smallest period q: words q apart are equal, and no neighbouring word
extends it. Kept are runs of at least ``EXPONENT`` periods and ``LEAST`` words.

Catchers: the words of a text are cut into completed blocks of 2^k words, for each k. Block j of level k has one catcher,
which looks for a copy of the block at distances 2^k to 2^(k+1) - 1. An appended word ends one suffix of 2^k words, and
this suffix lies in the reach of exactly one catcher of the level: so each word costs one comparison of two hashes a
level, and hashes of a level are made from two of the level below. The comparisons of all words of many texts are one
array operation a level; texts leave at the levels that are too long for them. A run of four periods q, 2^k <= q < 2^(k+1),
holds two neighbouring blocks of level k with copies q further on, so one caught square per stretch is enough: the first.
It is extended word by word (words are compared, not hashes), and the squares of a run merge into it. A square whose stretch
lies in a run found at a lower level only repeats that run with a multiple of its period and is not extended: so a text of
one word a million times over costs n log n too. A hash of 64 bits only ever proposes; that two different stretches share
one and so hide a first block is the only way to miss a run.

Nulls and empty texts have no words, no runs and an empty collapsed text. Repeated rows and ids are worked on each. An
empty table gives no rows. A text's words are held in one task: memory follows the longest text. Columns besides those
asked for are not read; the output's own names win.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow.llm.common import text_of

EXPONENT, LEAST = 4, 6
SLAB_WORDS = 1 << 18  # words compared at once
OUT_BYTES = 8 << 20

RUNS = "array<struct<start:long,length:long,period:long>>"
Prepare = Callable[[object, list], list]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _agree(codes: np.ndarray, at: int, distance: int, low: int, high: int) -> tuple[int, int]:
    """The longest [left, right) around ``at`` where a word equals the one ``distance`` further on; empty if ``at`` differs."""
    right, step = at, 64
    while right < high - distance:
        end = min(high - distance, right + step)
        differ = codes[right:end] != codes[right + distance : end + distance]
        if differ.any():
            right += int(differ.argmax())
            break
        right, step = end, step * 2
    if right == at:
        return at, at
    left, step = at, 64
    while left > low:
        begin = max(low, left - step)
        differ = codes[begin:left] != codes[begin + distance : left + distance]
        if differ.any():
            left -= int(differ[::-1].argmax())
            break
        left, step = begin, step * 2
    return left, right


class Catchers:
    """Catchers over the words of one or many texts, level by level."""

    def __init__(self, exponent: int = EXPONENT, least: int = LEAST):
        if exponent < 4:
            raise ValueError("two neighbouring blocks are only sure from four periods on")
        self.exponent, self.least = exponent, least

    def runs(self, codes: np.ndarray, lengths: Sequence[int]) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs, starts counted over the concatenated texts, ascending."""
        lengths = np.asarray(lengths, dtype=np.int64)
        total = int(lengths.sum())
        ends = np.cumsum(lengths)
        begin, end = np.repeat(ends - lengths, lengths), np.repeat(ends, lengths)
        place = np.arange(total) - begin
        found: list[tuple[int, int, int]] = []
        reach = np.zeros(total, dtype=np.int64)  # furthest end of the runs that start at a word
        covered = reach
        hashes = _mixed(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        size, longest = 1, int(lengths.max(initial=0))
        while size * self.exponent <= longest:
            at = np.flatnonzero((place >= size) & (np.arange(total) + size <= end) & (end - begin >= self.exponent * size))
            caught = np.zeros(total + size, dtype=bool)
            caught[at] = hashes[at] == hashes[at - size - place[at] % size]
            at = at[caught[at] & caught[at + size] & ~((place[at] >= size) & caught[at - size])]
            distance = size + place[at] % size
            block = at - distance
            new = covered[block] < at + 2 * size
            before = len(found)
            for b, d in zip(block[new].tolist(), distance[new].tolist()):
                left, right = _agree(codes, b, d, int(begin[b]), int(end[b]))
                length = right + d - left
                if right > left and length >= max(self.least, self.exponent * d):
                    found.append((left, length, d))
                    reach[left] = max(reach[left], left + length)
            if len(found) > before:
                covered = np.maximum.accumulate(reach)
            ahead = np.zeros(total, dtype=np.uint64)
            ahead[: max(total - size, 0)] = hashes[size:]
            hashes = _mixed(hashes * np.uint64(0xD6E8FEB86659FD93) + ahead + np.uint64(size))
            size *= 2
        return sorted(set(found), key=lambda r: (r[0], r[2]))


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run has after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words), dtype=bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return [words[i] for i in np.flatnonzero(~gone)]


def _slab(texts: list[list], catchers: Catchers) -> Iterator[tuple[list, bytes]]:
    """The runs and the collapsed text of each of some texts."""
    numbers = defaultdict(count().__next__)
    lengths = [len(x) for x in texts]
    codes = np.fromiter((numbers[w] for x in texts for w in x), dtype=np.int32, count=sum(lengths))
    all_runs, k, start = catchers.runs(codes, lengths), 0, 0
    for words in texts:
        own = []
        while k < len(all_runs) and all_runs[k][0] < start + len(words):
            own.append((all_runs[k][0] - start, *all_runs[k][1:]))
            k += 1
        start += len(words)
        yield own, b" ".join(collapsed(words, own))


def periodic_runs(docs: DataFrame, columns: Sequence[str] = ("doc_id",), text: str = "text", prepare: Prepare | None = None) -> DataFrame:
    """A row for each row: ``columns``, n_words, runs (by start, then period) and the collapsed text.

    ``prepare(first column's value, words as UTF-8)`` may change the words before the search.
    """
    source = docs.select(*columns, text_of(F.col(text)).alias("__text"))
    kinds = [f for f in source.schema.fields[:-1] if f.name not in ("n_words", "runs", "collapsed")]
    schema = T.StructType(kinds + T.StructType.fromDDL(f"n_words long, runs {RUNS}, collapsed string").fields)
    kept = [f.name for f in kinds]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        catchers = Catchers()
        runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

        def out(batch: pa.RecordBatch, first: int, texts: list) -> Iterator[pa.RecordBatch]:
            begun, size, runs, plain = first, 0, [], []

            def flush() -> pa.RecordBatch:
                part = batch.slice(begun, len(runs))
                listed = pa.array([[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs], type=runs_type)
                text = pa.array(plain, type=pa.binary()).cast(pa.string())
                sizes = pa.array([len(x) for x in texts[begun - first : begun - first + len(runs)]], type=pa.int64())
                return pa.RecordBatch.from_arrays([*[part.column(n) for n in kept], sizes, listed, text], names=[*kept, "n_words", "runs", "collapsed"])

            for own, joined in _slab(texts, catchers):
                runs.append(own)
                plain.append(joined)
                size += len(joined)
                if size >= OUT_BYTES:
                    yield flush()
                    begun, size, runs, plain = begun + len(runs), 0, [], []
            if runs:
                yield flush()

        for batch in batches:
            keys = batch.column(0)
            texts, first, held = [], 0, 0
            for i, body in enumerate(batch.column(batch.num_columns - 1)):
                words = body.as_buffer().to_pybytes().split()
                if prepare is not None:
                    words = prepare(keys[i].as_py(), words)
                texts.append(words)
                held += len(words)
                if held >= SLAB_WORDS:
                    yield from out(batch, first, texts)
                    texts, first, held = [], i + 1, 0
            if texts:
                yield from out(batch, first, texts)

    return source.mapInArrow(find, schema)


def planted(doc_id: object, words: list) -> list:
    """The words with a repeat planted in the texts whose crc32(id as text) is divisible by 10; a null id has none."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * -(-(n - a) // len(unit)))[: n - a]


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest exponent (ties: least start, then period), and digests of runs and collapsed text."""
    better = lambda r, s: s.isNull() | (r["length"] * s["period"] > s["length"] * r["period"])
    least = F.lit(None).cast(RUNS[len("array<") : -1])
    best = F.aggregate("runs", least, lambda s, r: F.when(better(r, s), r).otherwise(s))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
