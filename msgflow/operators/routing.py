"""Conditional forwarding by tags, fan-out, fan-in and the parity router."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.functions import scalars as S
from msgflow.operators import envelope as E


def has_any_tag(tags: Sequence[str]) -> Column:
    return F.arrays_overlap("tags", E.strings(*tags))


def route(df: DataFrame, edges: Mapping[str, Sequence[str] | None]) -> dict[str, DataFrame]:
    """One DataFrame per edge: the rows that carry any tag of the edge, or all rows for ``None``.

    Dropped rows go nowhere. Each edge is a plain filter, so Catalyst pushes it towards the scan.
    """
    live = E.drop_marked(df)
    return {name: live if tags is None else live.filter(has_any_tag(tags)) for name, tags in edges.items()}


def route_labelled(df: DataFrame, edges: Mapping[str, Sequence[str] | None]) -> DataFrame:
    """All edges in one pass: each row appears once per edge it takes, named in column ``edge``."""
    hits = [
        F.lit(name) if tags is None else F.when(has_any_tag(tags), F.lit(name)) for name, tags in edges.items()
    ]
    return E.drop_marked(df).withColumn("edge", F.explode(F.array_compact(F.array(*hits))))


def fan_in(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Several inputs as one; columns that an input lacks are NULL."""
    out = first
    for df in others:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def even_odd(df: DataFrame, number: Column | None = None) -> DataFrame:
    """Key and tag each row by the parity of its little-endian integer payload.

    ``number`` names a typed column to read instead of decoding the payload.
    """
    n = number if number is not None else S.le_bytes_to_int("value")
    even = S.is_even(n)
    return df.withColumns(
        {
            "keys": F.when(even, E.strings("even")).otherwise(E.strings("odd")),
            "tags": F.when(even, E.strings("even-tag")).otherwise(E.strings("odd-tag")),
        }
    )
