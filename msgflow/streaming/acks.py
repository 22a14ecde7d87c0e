"""A log of acknowledged offsets in shared storage: written by each micro-batch, compacted, read to resume.

The log is a folder that Spark's own file systems reach, so driver and executors may be anywhere. An entry is written
aside and renamed into place: it is there whole or not at all. Every ``every`` entries the log is folded into one, and only
then are the older ones removed; a crash between the two leaves entries that the folded one covers, and readers skip them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "partition_id int, offset bigint, n_rows bigint"
_ENTRY = re.compile(r"(batch|upto)-(\d+)$")


class OffsetLog:
    """Highest acknowledged offset and number of acknowledged rows of each partition."""

    def __init__(self, spark: SparkSession, path: str, every: int = 20) -> None:
        if every < 1:
            raise ValueError("every must be positive")
        self.spark, self.path, self.every = spark, path.rstrip("/"), every

    def _at(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _files(self):
        return self._at().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _put(self, rows: DataFrame, name: str) -> None:
        aside, files = f"_aside-{uuid.uuid4().hex}", self._files()
        rows.coalesce(1).write.parquet(f"{self.path}/{aside}")
        files.delete(self._at(name), True)  # of a replayed batch, which says the same
        if not files.rename(self._at(aside), self._at(name)):
            raise OSError(f"{self.path}/{name} can't be put in place")

    def entries(self) -> list[str]:
        """The entries that count: the last folded one and the batches after it, in order."""
        files = self._files()
        if not files.exists(self._at()):
            return []
        found = [m for s in files.listStatus(self._at()) if (m := _ENTRY.search(str(s.getPath().getName())))]
        folded = max((int(m[2]) for m in found if m[1] == "upto"), default=-1)
        later = sorted(int(m[2]) for m in found if m[1] == "batch" and int(m[2]) > folded)
        return ([f"upto-{folded}"] if folded >= 0 else []) + [f"batch-{b}" for b in later]

    def _rows(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/{n}" for n in names])
        return rows.groupBy("partition_id").agg(F.max("offset").alias("offset"), F.sum("n_rows").alias("n_rows"))

    def acknowledged(self) -> DataFrame:
        """partition_id, offset (the highest), n_rows."""
        return self._rows(self.entries())

    def commit(self, batch_id: int, rows: DataFrame, partition: Column, offset: Column) -> None:
        """Acknowledge the rows of a micro-batch. A batch that a folded entry covers is a replay and changes nothing."""
        names = self.entries()
        if names and names[0].startswith("upto-") and batch_id <= int(names[0][5:]):
            return
        own = rows.groupBy(partition.cast("int").alias("partition_id"))
        self._put(own.agg(F.max(offset.cast("bigint")).alias("offset"), F.count(F.lit(1)).alias("n_rows")), f"batch-{batch_id}")
        if len(self.entries()) > self.every:
            self._fold(batch_id)

    def _fold(self, batch_id: int) -> None:
        names = self.entries()
        self._put(self._rows(names), f"upto-{batch_id}")
        for name in names:
            self._files().delete(self._at(name), True)


def acknowledging(
    write: Callable[[DataFrame, int], None], log: OffsetLog, partition: Column, offset: Column
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: write the batch, then acknowledge its offsets. What failed to write is not acknowledged."""

    def each(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        log.commit(batch_id, batch, partition, offset)

    return each


def unacknowledged(df: DataFrame, log: OffsetLog, partition: Column, offset: Column) -> DataFrame:
    """The rows of a table beyond the acknowledged offset of their partition: where a new run resumes."""
    known = log.acknowledged().select(F.col("partition_id").alias("_p"), F.col("offset").alias("_o"))
    joined = df.join(known, partition.cast("int") == F.col("_p"), "left")
    return joined.filter(F.col("_o").isNull() | (offset.cast("bigint") > F.col("_o"))).select(*[df[c] for c in df.columns])
