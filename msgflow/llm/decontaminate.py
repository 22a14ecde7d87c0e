"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is contained in a document when the document has at least ``threshold`` of the item's distinct word shingles.
Items are short and documents long, so the Jaccard similarity of the two says nothing; the search sketches only the
item. Items are partitioned by shingle count (powers of two), and the sketch of an item is its least hash values, as many
as its partition needs: an item of at most u shingles that is contained misses at most floor((1 - threshold) * u) of
them, so one more than that is a sketch of which at least one value is in every document that contains the item. The
search has no false negatives. A partition with short items keeps short sketches, which is what partitioning is for.

Documents that share a sketch value are candidates; the exact share of all the item's shingles in each candidate
decides. Shingles are 64-bit hashes of their words.

The set of a text: distinct shingles of five words; with fewer words, all of them as one; none without words. So a short
item is found only where it is the whole text. Words are lower-cased (A-Z) runs of anything but white space.

Nulls: a null or empty text contains nothing, a null or empty item is contained nowhere; null ids are ids. Repeated rows
(same id and text) are one document and give one row per item; items of the same id and text are one item. Empty tables
give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.llm.common import identity, stored, words

WIDTH = 5
THRESHOLD = 0.75
BROADCAST_ROWS = 2_000_000  # of sketch values, 8 bytes and an item key each; beyond it both sides are shuffled


def shingles(text: Column, width: int = WIDTH) -> Column:
    """Hashes of the shingles of a text in order, repeats included."""
    tokens = words(text)

    def of(w: Column) -> Column:
        many = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(w) - F.lit(width), F.lit(0))),
            lambda at: F.xxhash64(*[F.get(w, at + F.lit(i)) for i in range(width)]),
        )
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(many)

    return F.transform(F.array(tokens), of)[0]


def sketches(items: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(item, item_id, n, h) of all shingles of all items, and the rows of it that are in sketches, with their partition."""
    sets = items.select(
        identity(F.col("item_id"), F.col("text")).alias("item"),
        "item_id",
        F.array_sort(F.array_distinct(shingles(F.col("text")))).alias("_set"),
    ).distinct()
    sets = sets.where(F.size("_set") > 0).withColumn("n", F.size("_set"))
    # The partition's upper bound: the next power of two.
    bound = F.pow(F.lit(2.0), F.ceil(F.log2("n"))).cast("int")
    may_miss = F.floor((F.lit(1.0) - F.lit(threshold)) * F.least(bound, 2 * F.col("n")) + F.lit(1e-9))
    size = F.least(F.col("n").cast("long"), may_miss + 1).cast("int")
    # Hash values are signed; mixing them again makes the least ones a sample in no order of the words.
    ranked = F.array_sort(F.transform("_set", lambda h: F.struct(F.xxhash64(h).alias("m"), h.alias("h"))))
    full = sets.select("item", "item_id", "n", F.explode("_set").alias("h"))
    least = sets.select("item", bound.alias("partition"), F.explode(F.slice(ranked["h"], F.lit(1), size)).alias("h"))
    return full, least


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of a document and an item it contains: doc_id, doc (identity), item_id, n_item, n_shared, containment."""
    full, least = sketches(items, threshold)
    full, least = stored(full, "items"), stored(least, "sketches")
    wanted = full.count()
    hint = F.broadcast if wanted <= BROADCAST_ROWS else (lambda frame: frame)
    base = docs.select(
        "doc_id", identity(F.col("doc_id"), F.col("text")).alias("doc"), shingles(F.col("text")).alias("_s")
    )
    hits = base.select("doc", F.explode("_s").alias("h")).join(hint(least), "h")
    candidates = stored(hits.select("doc", "item").distinct(), "candidates")
    docs_hit = candidates.select("doc").distinct()
    # Only candidates are shingled again; each shingle meets the items that have it.
    again = docs.select("doc_id", "text", identity(F.col("doc_id"), F.col("text")).alias("doc"))
    again = again.join(docs_hit, "doc", "left_semi").select(
        "doc_id", "doc", F.explode(F.array_distinct(shingles(F.col("text")))).alias("h")
    )
    shared = again.join(hint(full), "h").groupBy("doc_id", "doc", "item", "item_id", "n")
    shared = shared.agg(F.count_distinct("h").alias("n_shared"))
    # Integer test of the share, at a thousandth.
    enough = F.col("n_shared") * 1000 >= F.col("n") * F.lit(round(threshold * 1000))
    return (
        shared.where(enough)
        .join(candidates, ["doc", "item"], "left_semi")
        .select(
            "doc_id",
            "doc",
            "item_id",
            F.col("n").cast("long").alias("n_item"),
            "n_shared",
            (F.col("n_shared") / F.col("n")).alias("containment"),
        )
    )


def clean_documents(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that contain no item, all columns unchanged."""
    leaks = contained(docs, items, threshold).select("doc").distinct()
    boxed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), identity(F.col("doc_id"), F.col("text")).alias("doc"))
    return boxed.join(leaks, "doc", "left_anti").select("_row.*")
