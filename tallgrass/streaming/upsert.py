"""A keyed latest-value table for update-mode streams.

Each micro-batch writes the rows that it changed as one delta folder named by
the batch id. Every ``every`` batches the deltas and the last base are folded
into a new base: the latest row of each key. So the table holds one row per key
in its base and at most ``every`` deltas, however long the stream runs, and a
batch that runs again overwrites its own delta or finds itself in the base: it
changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrass.session import delete_path, path_exists

NO_BASE = -1


class LatestTable:
    """The latest row of each key, below ``path`` of the shared store. ``schema``
    is that of a batch; ``keys`` are its key columns (null is a key like any
    other). One stream writes; a reader sees the batches that are complete."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], every: int = 8):
        if not keys:
            raise ValueError("a latest-value table needs key columns")
        self.spark, self.path, self.keys, self.every = spark, path, keys, every
        self.values = [f.name for f in schema.fields if f.name not in keys]
        self.stored = T.StructType([*schema.fields, T.StructField("_batch", T.LongType())])

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the complete folders of a kind (a few, whatever the data)."""
        sc = self.spark.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(int(n) for n in names if path_exists(self.spark, f"{self.path}/{kind}/{n}/_SUCCESS"))

    def base(self) -> int:
        """The last batch that the newest base holds."""
        return max(self._numbers("base"), default=NO_BASE)

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` function: the rows of ``batch`` replace those of the same keys."""
        base = self.base()
        if batch_id <= base:
            return  # merged by an earlier attempt
        batch.withColumn("_batch", F.lit(batch_id).cast("long")).select(*self.stored.names) \
            .write.mode("overwrite").parquet(f"{self.path}/delta/{batch_id}")
        if batch_id - base >= self.every:
            self._latest(base, batch_id).write.mode("overwrite").parquet(f"{self.path}/base/{batch_id}")
            for kind in ("base", "delta"):
                for old in self._numbers(kind):
                    if old < batch_id or (kind == "delta" and old == batch_id):
                        delete_path(self.spark, f"{self.path}/{kind}/{old}")

    def _latest(self, base: int, upto: int | None = None) -> DataFrame:
        deltas = [k for k in self._numbers("delta") if k > base and (upto is None or k <= upto)]
        paths = [f"{self.path}/delta/{k}" for k in deltas] + ([f"{self.path}/base/{base}"] if base != NO_BASE else [])
        if not paths:
            return self.spark.createDataFrame([], self.stored)
        rows = self.spark.read.schema(self.stored).parquet(*paths)
        newest = F.max_by(F.struct(*self.values, "_batch"), F.col("_batch")).alias("_v")
        return rows.groupBy(*self.keys).agg(newest).select(*self.keys, "_v.*").select(*self.stored.names)

    def read(self) -> DataFrame:
        """The latest row of each key."""
        return self._latest(self.base()).drop("_batch")
