"""Line dedup by overlapping windows of three lines.

A window is three consecutive lines of a document, blank lines left out. Windows are hashed to 128 bits and grouped over
all documents. The first occurrence, by (doc_id, document hash, line), stays; at every later one the lines it covers are
marked. Marked windows overlap, so covered positions are merged per document, and the lines they cover are taken out.

Hash groups are aggregated before the shuffle, and only the first place of a repeated window goes back to its
occurrences, by a join that adaptive execution splits where a passage is hot; no group of occurrences is ever gathered.
What is gathered is the covered positions of one document.

Only lines inside a repeated window go: a repeated passage of one or two lines between differing neighbours stays as it
is. A document of fewer than three lines that are not blank has no window, or with ``short`` one of all its lines, which
only equals that of another such document. The query's SQL states the rule without it. Blank lines stay. Lines are compared exactly. A null text stays null and has no lines. Repeated
rows (same id and text) are one document: a window is not a repetition of itself, so they get the same result. A null id
comes before every other. Extra columns are returned unchanged, unless named as a result column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.llm.common import SPACE, identity

SIZE = 3
LINE_COLUMNS = ("text_deduped", "n_lines", "n_removed", "removed_spans")


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _solid(lines: Column) -> Column:
    """Lines that are not blank, each with its place among all lines."""
    numbered = F.transform(lines, lambda line, at: F.struct(at.alias("at"), line.alias("line")))
    return F.filter(numbered, lambda x: F.regexp_replace(x["line"], SPACE, "") != "")


def _windows(solid: Column) -> Column:
    """Every window: two hashes, and the places of its first and last line. Fewer than SIZE lines are one window."""

    def one(x: Column, at: Column) -> Column:
        parts = [x["line"], *[F.get(solid, at + i)["line"] for i in range(1, SIZE)]]
        return F.struct(
            F.xxhash64(*parts).alias("h"),
            F.xxhash64(F.lit("second"), *parts).alias("g"),
            at.alias("first"),
            (F.least(at + SIZE, F.size(solid)) - 1).alias("last"),
        )

    return F.slice(F.transform(solid, one), 1, F.greatest(F.size(solid) - F.lit(SIZE - 1), F.lit(1)))


def repeated_lines(docs: DataFrame, short: bool = False) -> DataFrame:
    """Documents with windows that occurred earlier: doc (identity) and covered, the merged line runs as (from, to).

    Runs count solid lines from 0. With ``short``, documents of fewer than SIZE solid lines are one window each.
    """
    base = docs.select(
        F.col("doc_id"), identity(F.col("doc_id"), F.col("text")).alias("doc"), _solid(_lines(F.col("text"))).alias("_s")
    ).where(F.size("_s") >= (1 if short else SIZE))
    spots = base.select("doc_id", "doc", F.explode(_windows(F.col("_s"))).alias("_w"))
    spots = spots.select("_w.h", "_w.g", F.struct("doc_id", "doc", F.col("_w.first").alias("at"), "_w.last").alias("spot"))
    # Repeated: first and last occurrence differ. One row a window and task is shuffled.
    firsts = spots.groupBy("h", "g").agg(F.min("spot").alias("_first"), F.max("spot").alias("_last"))
    firsts = firsts.where(F.col("_first") != F.col("_last")).select("h", "g", "_first")
    later = spots.join(firsts, ["h", "g"]).where(F.col("spot") != F.col("_first"))
    marked = later.groupBy(F.col("spot.doc").alias("doc")).agg(F.sort_array(F.collect_set(F.struct("spot.at", "spot.last"))).alias("_at"))
    empty = F.array().cast("array<struct<from:int,to:int>>")

    def merge(runs: Column, window: Column) -> Column:
        at, to, last = window["at"], window["last"], F.get(runs, F.size(runs) - 1)
        fresh = F.struct(at.alias("from"), to.alias("to"))
        joined = F.struct(last["from"].alias("from"), to.alias("to"))
        touches = (F.size(runs) > 0) & (at <= last["to"] + 1)
        return F.when(
            touches, F.concat(F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0))), F.array(joined))
        ).otherwise(F.concat(runs, F.array(fresh)))

    return marked.select("doc", F.aggregate("_at", empty, merge).alias("covered"))


def dedup_lines(docs: DataFrame, keep: list[str] | None = None, short: bool = False) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with text_deduped, n_lines, n_removed and removed_spans (runs of solid lines).

    ``keep`` lists the columns to return (doc_id if not given). ``short`` also finds copies of documents of fewer than
    SIZE solid lines.
    """
    keep = ["doc_id"] if keep is None else [c for c in keep if c not in LINE_COLUMNS]
    rows = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("_row"),
        F.col("text").alias("_text"),
        identity(F.col("doc_id"), F.col("text")).alias("doc"),
    )
    rows = rows.join(repeated_lines(docs, short), "doc", "left")
    lines = _lines(F.col("_text"))
    solid = _solid(lines)
    gone = F.flatten(
        F.transform("covered", lambda run: F.slice(solid, run["from"] + 1, run["to"] - run["from"] + 1)["at"])
    )
    left = F.filter(lines, lambda line, at: ~F.array_contains(F.col("_gone"), at))
    rows = rows.withColumn("_gone", F.coalesce(gone, F.array().cast("array<int>")))
    changed = F.when(F.size("_gone") == 0, F.col("_text")).otherwise(F.array_join(left, "\n"))
    return rows.select(
        "_row.*",
        changed.alias("text_deduped"),
        F.when(F.col("_text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.size("_gone").cast("long").alias("n_removed"),
        F.col("covered").alias("removed_spans"),
    )
