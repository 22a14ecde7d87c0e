"""Running aggregates over ordered groups, safe when one group holds much of the data.

A plain window function sorts each group inside one task. That is fine until a group (a key, a
source, a missing event time) outgrows a task. :func:`running` therefore counts the groups first.
If none is hot it is the plain window function. Otherwise each hot group is cut at quantiles of
its own order into segments, each segment is summarised once, and the running total before a
segment enters it as one extra *carry row*. The shuffle key is (group, segment), so hot groups
spread over many tasks, and there is still one shuffle of the rows and no join on the hot key.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow.functions.scalars import let

HOT_ROWS = 4_000_000  # a group below this many rows is never split; about the size of a piece of one that is
PIECES = 2_000  # at most this many pieces per cut; a piece that is still too big is cut again
STRIDE = 50  # the cut search looks at every STRIDE-th cut first
CHUNK = 6  # bytes of a text that are compared as one number
EXACT = 2**53  # quantiles are doubles: larger numbers are cut in steps of STEP, then by the rest
STEP = 2048
BROADCAST_BYTES = 64 << 20  # cut tables beyond this are joined without a broadcast

_LOWEST = -(2**63)

_INTEGRAL = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)


@dataclass(frozen=True)
class Running:
    """A running aggregate: ``kind`` is count, sum, max or min. NULL inputs are ignored."""

    kind: str
    value: Column | None = None

    def row_value(self) -> Column:
        if self.kind == "count":
            seen = F.lit(1) if self.value is None else F.when(self.value.isNotNull(), 1).otherwise(0)
            return seen.cast("bigint")
        if self.kind not in ("sum", "max", "min") or self.value is None:
            raise ValueError(f"running aggregate needs count, or sum/max/min with a value: {self.kind}")
        return self.value

    def total(self, col: str) -> Column:
        return {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}[self.kind](col)


def _rank_type(df: DataFrame, name: str) -> str | None:
    dt = df.schema[name].dataType
    if isinstance(dt, T.TimestampType):
        return "time"
    if isinstance(dt, T.StringType):
        return "text"
    return "int" if isinstance(dt, _INTEGRAL) else None


def _as_number(df: DataFrame, name: str) -> Column:
    number = F.unix_micros(name) if _rank_type(df, name) == "time" else F.col(name).cast("bigint")
    return F.coalesce(number, F.lit(_LOWEST))  # NULLs sort first, as in the windows below


def _chunk_number(name: str, at: int) -> Column:
    """Bytes ``at``.. of a text as a number that keeps their order."""
    part = F.hex(F.substring(F.encode(name, "UTF-8"), at + 1, CHUNK))
    return F.coalesce(F.conv(F.rpad(part, 2 * CHUNK, "0"), 16, 10).cast("bigint"), F.lit(_LOWEST))


def _steps(number: Column) -> Column:
    """A number that doubles hold exactly; large ones are taken down to a multiple of STEP."""
    return F.when(number.between(-EXACT, EXACT), number).otherwise(number - F.pmod(number, F.lit(STEP)))


def _numbers(df: DataFrame, order: Sequence[str]) -> Iterator[tuple[Column, bool]]:
    """What to cut along, one number after the other: each splits the rows that are equal in those before it.

    The flag marks numbers that only tell large values of the number before apart.
    """
    for name in order:
        kind = _rank_type(df, name)
        if kind is None:
            return
        if kind != "text":
            number = _as_number(df, name)
            yield _steps(number), False
            yield number - _steps(number), True
            continue
        length = F.octet_length(name)
        longest = df.agg(F.max(length)).first()[0] or 0
        for at in range(0, longest, CHUNK):
            yield _chunk_number(name, at), False
        yield F.coalesce(length.cast("bigint"), F.lit(_LOWEST)), False  # tells trailing zero bytes from none


@dataclass(frozen=True)
class _Table:
    """A small table as driver literals: cut points must not change when a stage is recomputed.

    It holds hot groups with their cuts, at most one cut for every ``hot_rows`` rows of the input.
    """

    rows: DataFrame
    data: pa.Table


def _frozen(df: DataFrame) -> _Table:
    data = df.toArrow()
    return _Table(df.sparkSession.createDataFrame(data, df.schema), data)


def _lookup(df: DataFrame, table: _Table, cols: Sequence[str], *, how: str) -> DataFrame:
    """Attach the other columns of ``table``: broadcast up to BROADCAST_BYTES, else joined as Spark sees fit."""
    right = table.rows.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    joined = df.join(F.broadcast(right) if table.data.nbytes <= BROADCAST_BYTES else right, cond, how)
    return joined.drop(*[f"_r_{c}" for c in cols])


def hot_groups(df: DataFrame, group: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Groups of more than ``hot_rows`` rows, with their row counts ``_n``."""
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)


def _cuts(df: DataFrame, group: Sequence[str], number: Column, hot: _Table, hot_rows: int) -> DataFrame:
    """Sorted cut points of ``number`` per hot group, about one per ``hot_rows`` rows.

    ``_coarse`` is every STRIDE-th cut; ``_spikes`` are the values that fill more than one piece.
    ``_size`` is the number of rows between two cuts.
    """
    rows = _lookup(df, hot, group, how="inner")
    shares = ",".join(f"{i / PIECES}D" for i in range(1, PIECES))
    points = F.expr(f"percentile_approx(_number, array({shares}), 10000)")
    rows = rows.select(*group, number.alias("_number"), "_n")
    found = rows.groupBy(*group).agg(points.alias("_all"), F.max("_n").alias("_n"))
    step = F.greatest(F.lit(1), F.floor(F.lit(PIECES).cast("bigint") * hot_rows / F.col("_n")).cast("int"))
    found = found.withColumns(
        {"_cuts": F.filter("_all", lambda _, i: (i + 1) % step == 0), "_size": F.ceil(F.col("_n") * step / PIECES)}
    )
    return found.select(
        *group,
        "_cuts",
        "_size",
        F.filter("_cuts", lambda _, i: (i + 1) % STRIDE == 0).alias("_coarse"),
        F.array_distinct(F.filter("_cuts", lambda c, i: (i > 0) & (F.get("_cuts", i - 1) == c))).alias("_spikes"),
    )


def _piece(number: Column) -> Column:
    """How many cuts are at or below ``number``: coarse cuts first, then one stride of fine ones."""

    def count(cuts: Column, x: Column) -> Column:
        return F.size(F.filter(cuts, lambda c: c <= x))

    def fine(skip: Column, x: Column) -> Column:
        return skip + count(F.slice("_cuts", skip + 1, F.lit(STRIDE)), x)

    place = let(number, lambda x: let(count(F.col("_coarse"), x) * STRIDE, lambda skip: fine(skip, x)))
    return F.when(F.col("_cuts").isNull(), 0).otherwise(place)


class _Pieces:
    """Rows with the numbers of the pieces they fall into, one pair of columns per cut: the piece, and
    1 for rows that follow the piece's first value where that value fills more than one piece."""

    def __init__(self, df: DataFrame, group: Sequence[str], hot_rows: int) -> None:
        self.rows, self.ids, self.hot_rows = df, list(group), hot_rows
        self.parts: list[str] = []

    def _cut(self, number: Column, hot: _Table) -> tuple[DataFrame, DataFrame]:
        """Cut the groups of ``hot``; returns the single values, and the pieces, that are still too big."""
        table = _frozen(_cuts(self.rows, self.ids, number, hot, self.hot_rows))
        old, piece, after = self.ids, f"_piece{len(self.parts)}", f"_after{len(self.parts)}"
        rows = _lookup(self.rows, table, old, how="left")
        follows = F.when(F.array_contains("_spikes", number), 0).otherwise(1)
        new = {piece: _piece(number), after: F.when(F.col("_cuts").isNull(), 0).otherwise(follows)}
        if not self.parts:
            new["_hot"] = F.col("_cuts").isNotNull()
        self.rows = rows.withColumns(new).drop("_cuts", "_coarse", "_spikes", "_size")
        self.ids, self.parts = [*old, piece, after], [*self.parts, piece, after]

        value = F.col("_value")
        wide = (value >= EXACT) | ((value <= -EXACT) & (value != _LOWEST))
        filled = F.size(F.filter("_cuts", lambda c: c == value))
        spikes = table.rows.select(*old, "_cuts", "_size", F.explode("_spikes").alias("_value")).select(
            *old,
            F.size(F.filter("_cuts", lambda c: c <= value)).alias(piece),
            F.lit(0).alias(after),
            (filled * F.col("_size")).alias("_n"),
            wide.alias("_wide"),
        )
        large = table.rows.filter(F.col("_size") > self.hot_rows).select(
            *old,
            F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias(piece),
            F.lit(1).alias(after),
            F.col("_size").alias("_n"),
        )
        return spikes, large

    def split(self, number: Column, hot: _Table) -> _Table:
        """Cut along ``number`` until no piece of several values is too big; returns the values that are."""
        left: list[DataFrame] = []
        while hot.data.num_rows:
            before = self.ids
            spikes, large = self._cut(number, hot)
            fresh = {c: F.lit(0) for c in self.ids if c not in before}
            left = [*(s.withColumns(fresh) for s in left), spikes]
            hot = _frozen(large)
        names = [*self.ids, "_n", "_wide"]
        return _frozen(functools.reduce(DataFrame.unionByName, [s.select(names) for s in left]))


def segmented(df: DataFrame, group: Sequence[str], order: Sequence[str], *, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Add ``_seg``, equal for rows of one segment and ascending along ``order`` within each group,
    and ``_hot``, true for rows of hot groups; other groups are one segment.

    Returns None when no group has more than ``hot_rows`` rows. The first order column is cut at
    quantiles; rows that share one of its values and are still too many are cut along the next one,
    and so on. Texts are cut by a few bytes at a time. Columns of other types end the search, so only
    rows equal in all columns before, or in ``order`` as a whole, can stay together beyond ``hot_rows``.
    """
    if _rank_type(df, order[0]) not in ("time", "int"):
        raise TypeError(f"the first order column must be a timestamp or an integer: {order[0]}")
    hot = _frozen(hot_groups(df, group, hot_rows))
    if not hot.data.num_rows:
        return None
    pieces = _Pieces(df, group, hot_rows)
    for number, only_wide in _numbers(df, order):
        if only_wide and not pc.any(hot.data["_wide"]).as_py():
            continue
        hot = pieces.split(number, hot)
        if not hot.data.num_rows:
            break
    return pieces.rows.withColumn("_seg", F.array(*pieces.parts)).select(*df.columns, "_seg", "_hot")


def running(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    aggs: Mapping[str, Running],
    *,
    exclusive: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add running aggregates over the rows of ``group`` up to the current row along ``order``.

    ``order`` should be unique within a group. ``exclusive`` leaves the current row out.
    Finding hot groups runs a small aggregation when this is called.
    """
    group, order = list(group), list(order)
    inputs = {f"_in_{name}": agg.row_value() for name, agg in aggs.items()}
    end = -1 if exclusive else Window.currentRow
    split = segmented(df, group, order, hot_rows=hot_rows)
    columns = [*df.columns, *aggs]

    if split is None:
        frame = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
        out = df.withColumns(inputs)
        totals = {name: agg.total(f"_in_{name}").over(frame) for name, agg in aggs.items()}
        return out.withColumns(_zero_counts(totals, aggs)).select(*columns)

    rows = split.withColumns(inputs).withColumn("_kind", F.lit(1))
    # Only hot groups have several segments, so only their rows are summarised.
    hot = rows.filter("_hot")
    summary = hot.groupBy(*group, "_seg").agg(*[a.total(f"_in_{n}").alias(f"_in_{n}") for n, a in aggs.items()])
    earlier = Window.partitionBy(*group).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.withColumns({f"_in_{n}": a.total(f"_in_{n}").over(earlier) for n, a in aggs.items()})
    carry = carry.withColumn("_kind", F.lit(0))
    frame = (
        Window.partitionBy(*group, "_seg").orderBy("_kind", *order).rowsBetween(Window.unboundedPreceding, end)
    )
    totals = {name: agg.total(f"_in_{name}").over(frame) for name, agg in aggs.items()}
    out = rows.unionByName(carry, allowMissingColumns=True)
    return out.withColumns(_zero_counts(totals, aggs)).filter(F.col("_kind") == 1).select(*columns)


def _zero_counts(totals: dict[str, Column], aggs: Mapping[str, Running]) -> dict[str, Column]:
    return {n: F.coalesce(t, F.lit(0).cast("bigint")) if aggs[n].kind == "count" else t for n, t in totals.items()}


def running_count(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "counter", **opts) -> DataFrame:
    return running(df, group, order, {name: Running("count")}, **opts)
