"""Native one-to-many maps: projections, filters and splits that stay in Catalyst."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.functions import scalars as S
from msgflow.operators import envelope as E


def map_messages(df: DataFrame, items: Column, *, keep: tuple[str, ...] = ("id", "event_time", "watermark", "headers")) -> DataFrame:
    """One output row per message struct in ``items``; ``pos`` keeps the order inside one input row.

    Output keys, value, tags and user metadata come only from the message. ``keep`` names the input
    columns that travel along.
    """
    carried = [c for c in keep if c in df.columns]
    exploded = df.select(*carried, F.posexplode(items).alias("pos", "_m"))
    return exploded.select(*carried, "pos", "_m.*")


def forward(df: DataFrame, *, keep_tags: bool = False) -> DataFrame:
    """Identity map: value and keys pass, tags start empty."""
    return df if keep_tags else E.from_datum(df)


def filter_value(df: DataFrame, text: str) -> DataFrame:
    """Drop the rows whose payload equals ``text``."""
    return df.filter(~S.payload_equals("value", text))


def flat_map(df: DataFrame, delimiter: str = ",", *, text: Column | None = None) -> DataFrame:
    """Split each payload on a delimiter, one output row per part, in order.

    ``text`` names a typed text column to split instead of decoding the payload.
    """
    source = text if text is not None else S.bytes_to_text("value")
    rest = [c for c in df.columns if c not in ("value", "tags")]
    parts = df.select(*rest, F.posexplode(S.split_text(source, delimiter)).alias("pos", "_part"))
    return parts.select(*rest, "pos", S.text_to_bytes("_part").alias("value"), E.strings().alias("tags"))


def pair_responses(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """How many responses each id got: OK, MISSING (none), DUPLICATE (several) or UNKNOWN (no request).

    Both sides are counted per id before and after the shuffle, so a repeated id stays cheap.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    both = requests.select("id", one.alias("req"), zero.alias("resp")).unionByName(
        responses.select("id", zero.alias("req"), one.alias("resp"))
    )
    counted = both.groupBy("id").agg(F.sum("req").alias("requests"), F.sum("resp").alias("responses"))
    verdict = (
        F.when(F.col("requests") == 0, "UNKNOWN")
        .when(F.col("responses") == 0, "MISSING")
        .when(F.col("responses") > F.col("requests"), "DUPLICATE")
        .otherwise("OK")
    )
    return counted.withColumn("verdict", verdict)
