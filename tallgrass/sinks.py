"""Sinks (K1-K5): text, tab-separated key/value and record-only outputs.

All are distributed writes, one file per partition; ``num_files`` deals the rows
out to that many partitions first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _files(df: DataFrame, num_files: int | None) -> DataFrame:
    """K5: control the output file count. A repartition, not a coalesce: the
    work in front of the write keeps its own number of tasks."""
    return df if num_files is None else df.repartition(num_files)


def write_text(df: DataFrame, path: str, col: str = "value", num_files: int | None = None) -> None:
    """K1 ``saveAsTextFile``: one line per row; overwrite replaces an old output."""
    _files(df.select(F.col(col).cast("string").alias("value")), num_files).write.mode("overwrite").text(path)


def write_records(df: DataFrame, path: str, col: str = "record", num_files: int | None = None) -> None:
    """K3 record-only output (the reducer's null key writes nothing)."""
    write_text(df, path, col, num_files)


def write_key_values(df: DataFrame, path: str, key: str, value: str, sort: bool = True,
                     num_files: int | None = None) -> None:
    """K2/T10 ``key<TAB>value`` lines, as a reducer writes them. ``sort`` orders
    the output by key across files (a range-partitioned sort, not one task)."""
    lines = df.select(F.col(key).alias("_k"), F.concat_ws("\t", F.col(key).cast("string"),
                                                          F.col(value).cast("string")).alias("value"))
    if not sort:
        out = _files(lines, num_files)
    elif num_files is None:
        out = lines.orderBy("_k")
    else:
        out = lines.repartitionByRange(num_files, "_k").sortWithinPartitions("_k")
    out.select("value").write.mode("overwrite").text(path)


def read_key_values(spark, path: str, key_type: str = "string", value_type: str = "bigint",
                    key: str = "key", value: str = "value") -> DataFrame:
    """Read ``key<TAB>value`` lines back (the last tab separates)."""
    line = F.col("value")
    k = F.regexp_extract(line, r"^(.*)\t([^\t]*)$", 1)
    v = F.regexp_extract(line, r"^(.*)\t([^\t]*)$", 2)
    return spark.read.text(path).select(k.cast(key_type).alias(key), v.cast(value_type).alias(value))
