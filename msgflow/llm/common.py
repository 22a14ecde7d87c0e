"""What the operators share: words, document identity, stored intermediate tables, sizes.

Two rows with the same id and the same text are one document throughout; ``identity`` is what tells documents apart.
Words are runs of anything but ASCII white space; only A-Z is lower-cased, so Spark, Python and SQL agree.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.session import shared_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = re.compile(WORD)
ASCII_LOWER = str.maketrans(UPPER, LOWER)


def text_of(text: Column) -> Column:
    """The text, empty where null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column, lower: bool = True) -> Column:
    """The words of a text in order; null and empty texts have none."""
    plain = text_of(text)
    if lower:
        plain = F.translate(plain, UPPER, LOWER)
    return F.filter(F.split(plain, SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def crc(column: Column) -> Column:
    return F.crc32(column.cast("string").cast("binary"))


def remainder(key: Column, modulus: int) -> Column:
    """crc32(key as text) mod ``modulus``; null for a null key."""
    return crc(key) % F.lit(modulus)


def uniform(*columns: Column) -> Column:
    """A number in [0, 1) that the values decide."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def identity(key: Column, text: Column) -> Column:
    """128 bits that tell documents apart: id and text, nulls included."""
    parts = [key.isNull(), key.cast("string"), text.isNull(), text.cast("string")]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit("second"), *parts).alias("b"))


def stored(frame: DataFrame, purpose: str, partition_by: list[str] | None = None) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends there, and a lost executor costs nothing."""
    spark = frame.sparkSession
    path = shared_dir(spark, purpose)
    writer = frame.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def pieces_for(spark: SparkSession, amount: float, per_piece: float) -> int:
    """Number of pieces of at most ``per_piece``, no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(amount / per_piece))


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")
