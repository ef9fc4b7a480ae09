"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import fresh
from ..session import Scratch, checkpoint_root, cut_lineage, holding

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows and bytes that one Arrow batch may hold: a Python worker sees a few MB at a time.
BATCH_ROWS, BATCH_BYTES = 2000, "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers get, whatever the row length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor sees."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: cuts lineage,
    survives lost executors, and is computed once however often it is read; with
    a folder for each value of the column ``by``, if one is named. ``release``
    deletes it; so it does the ``borrowed`` result of an operator."""
    if by is None:
        return cut_lineage(df, name)
    path = shared_path(df.sparkSession, name)
    df.write.partitionBy(by).parquet(path)
    return owning(df.sparkSession.read.schema(df.schema).parquet(path), path)


def owning(df: DataFrame, path: str) -> DataFrame:
    """``df``, which reads the folder ``path``: releasing it deletes the folder."""
    df._scratch = Scratch(path)
    return df


def borrowed(result: DataFrame, *tables: DataFrame, folder: str | None = None) -> DataFrame:
    """``result``, which reads ``tables`` and the files of ``folder``: releasing it deletes them."""
    out = holding(result, *tables)
    if folder is not None:
        out._scratch += (Scratch(folder),)
    return out


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else. ``lower`` does that to pure ASCII text and is
    far faster than ``translate``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def id_crc(col: str = "doc_id") -> Column:
    """CRC-32 of an id written as decimal text."""
    return F.crc32(F.col(col).cast("string").cast("binary"))
