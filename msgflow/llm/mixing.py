"""Mixing sources to target weights by capped water-filling, with whole and fractional repetitions.

Every source has a weight and may be repeated at most ``max_epochs`` times. The mix is ``share`` times the size of all
rows. A source whose weighted share lies above its cap is held at the cap; what it cannot take goes to the others by
weight, until none is above. With sources in order of cap / weight the capped ones come first, so one running sum per
source finds the level and no rounds are needed; sums stay integers until the last division.

A target of r times the source is floor(r) whole repetitions of every row, and one more of some rows: those first in a
seeded order, up to the row at which the rest is met most nearly. The order is a hash of id and text, read in buckets:
sizes are summed per (source, bucket), and only a bucket's own rows are ordered, so a source with a third of all rows is
spread over as many tasks as it has buckets.

Nulls: a null text has size 0, a null source is a source of its own and comes last; a null id is an id. Repeated rows
(same id and text) are ordered beside each other and count as rows. An empty table gives an empty mix. A source whose
rows are all empty has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgflow.llm.common import text_of, word_count

BUCKETS = 65536
MIX_COLUMNS = ("size", "source_size", "target", "repeats", "taken")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: tuple[int, int] = (3, 2), max_epochs: int = 2
) -> DataFrame:
    """Targets of sources. ``sizes`` has (source, source_size), one row per source: the only table that one task holds.

    ``share`` is numerator and denominator. Returns source, source_size, weight, target.
    """
    position = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source")))
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    frame = sizes.withColumn("weight", F.get(cycle, (position - 1) % F.lit(len(weights))).cast("long"))
    frame = frame.withColumn("cap", F.col("source_size") * F.lit(int(max_epochs)))
    # Least cap per weight first; the last position decides ties, so that the order is total.
    by_level = Window.orderBy(
        F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source")
    )
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    num, den = share
    total = F.sum("source_size").over(whole) * F.lit(num)  # in units of 1/den
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0)) * F.lit(den)
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    frame = frame.withColumns({"left": left, "weight_left": weight_left})
    # Capped: its cap is no more than its share of what the sources before it leave.
    capped = F.col("cap") / F.col("weight") <= F.col("left") / (F.col("weight_left") * F.lit(den))
    frame = frame.withColumn("capped", capped)
    first_free = Window.orderBy(F.col("capped"), F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    level_left = F.first("left").over(first_free.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level_weight = F.first("weight_left").over(
        first_free.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        (level_left * F.col("weight")).cast("double") / (level_weight * F.lit(den)).cast("double")
    )
    return frame.select("source", "source_size", "weight", target.alias("target"))


def _draw(key: Column, text: Column, seed: str) -> Column:
    """A seeded number of 40 bits."""
    digest = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(key.cast("string"), F.lit("")), F.lit("|"), F.md5(text_of(text))))
    return F.conv(F.substring(digest, 1, 10), 16, 10).cast("long")


def _bucket(draw: Column) -> Column:
    """The first 16 bits: one of BUCKETS."""
    return F.shiftright(draw, 24).cast("int")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: tuple[int, int] = (3, 2),
    max_epochs: int = 2,
    seed: str = "mix",
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, source) with size, source_size, target, repeats and taken.

    ``keep`` lists the columns of docs to return (doc_id if not given); those named as a result column give way. Columns
    not kept are not shuffled. ``taken`` is repeats times size.
    """
    keep = ["doc_id"] if keep is None else [c for c in keep if c not in MIX_COLUMNS]
    key = [F.coalesce(F.col("source"), F.lit("")).alias("_source"), F.col("source").isNull().alias("_null")]
    draw = _draw(F.col("doc_id"), F.col("text"), seed)
    size = word_count(F.col("text")).alias("size")
    # Sizes per (source, bucket): at most BUCKETS rows for a source, whatever its rows.
    slim = docs.select(*key, size, _bucket(draw).alias("_bucket"))
    by_bucket = slim.groupBy("_source", "_null", "_bucket").agg(F.sum("size").alias("_size"))
    sources = by_bucket.groupBy("_source", "_null").agg(F.sum("_size").alias("source_size"))
    named = F.when(~F.col("_null"), F.col("_source")).alias("source")
    targets = source_targets(sources.select(named, "source_size"), weights, share, max_epochs).select(*key, "source_size", "target")
    order = Window.partitionBy("_source", "_null").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_bucket.withColumn("_before", F.coalesce(F.sum("_size").over(order), F.lit(0))).drop("_size")
    plan = offsets.join(targets, ["_source", "_null"])
    base = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("_row"),
        *key,
        size,
        draw.alias("_draw"),
        F.col("doc_id").alias("_id"),
    ).withColumn("_bucket", _bucket(F.col("_draw")))
    inside = Window.partitionBy("_source", "_null", "_bucket").orderBy("_draw", "_id")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = base.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(plan, ["_source", "_null", "_bucket"])
    # One step for each whole or partial repetition; a row is in when its middle lies before the rest of the target.
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - whole * F.col("source_size")
    more = (F.col("_before") + F.col("_inside")).cast("double") + F.col("size") / F.lit(2.0) < rest
    rows = rows.withColumn("repeats", (whole + more.cast("int")).cast("long"))
    return rows.select(
        "_row.*", "size", "source_size", "target", "repeats", (F.col("repeats") * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as it is repeated, with the columns of ``docs``."""
    # Carried in a struct, so that no column of docs can clash with one of the mix.
    boxed = docs.select("doc_id", "text", "source", F.struct(*[F.col(c) for c in docs.columns]).alias("_all"))
    mixed = mix(boxed, keep=["_all"], **options)
    times = F.sequence(F.lit(1), F.col("repeats").cast("int"))
    return mixed.where(F.col("repeats") > 0).select("_all", F.explode(times).alias("_n")).select("_all.*")
