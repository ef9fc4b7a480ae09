"""Session construction and shared-scratch helpers.

Every operator takes and returns DataFrames; nothing here holds data. The
helpers below only decide *where* lineage cuts and streaming state live:
always under the cluster-wide ``spark.checkpoint.dir`` when the session names
one, and only in local (test) mode under a fresh temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Streaming state (running counts over a whole vocabulary, window counts)
    # lives in RocksDB off the JVM heap and is checkpointed incrementally.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tallgrass", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming state.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset and
    the session is local (tests, single machine) a private temp folder is
    created and registered; on a cluster an unset value is an error, because a
    machine-local folder is not visible to the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative or streaming jobs")
    local_dir = tempfile.mkdtemp(prefix="tallgrass-ckpt-")
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir() or local_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


@dataclass(frozen=True)
class Scratch:
    """What a materialized intermediate holds on to: its folder, and its
    catalog table if it has one."""
    path: str
    table: str | None = None


def _tracked(df: DataFrame, path: str, table: str | None = None) -> DataFrame:
    df._scratch = Scratch(path, table)  # the handle goes with the DataFrame object
    return df


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialize ``df`` as a parquet table in the shared checkpoint folder and
    read it back.

    Used between the rounds of iterative algorithms. Like a reliable
    checkpoint it survives executor loss and keeps the plan one round long;
    unlike ``Dataset.checkpoint`` the re-read table carries its real on-disk
    size as statistics, so size estimates (and broadcast decisions) do not
    compound from round to round.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return _tracked(spark.read.schema(df.schema).parquet(path), path)


def num_buckets(spark: SparkSession) -> int:
    """Bucket count for co-partitioned iteration tables: the session's shuffle
    partition count, so a shuffle on the same key lines up with the buckets
    (fewer buckets were measured slower: every round pays a re-shuffle)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def shuffle_partitions(spark: SparkSession, most: int | None) -> Iterator[None]:
    """What is planned inside uses ``most`` shuffle partitions, or the session's if those are fewer or ``most`` is None."""
    key, before = "spark.sql.shuffle.partitions", num_buckets(spark)
    spark.conf.set(key, str(min(before, most or before)))
    try:
        yield
    finally:
        spark.conf.set(key, str(before))


def cut_lineage_bucketed(df: DataFrame, col: str, name: str = "stage", buckets: int | None = None,
                         prepartitioned: bool = False) -> DataFrame:
    """Like ``cut_lineage`` but written as a table bucketed (and sorted) by
    ``col``. Joins of two such tables on their bucket columns, or with a
    shuffle on the same key and partition count, need no exchange: in an
    iteration the large static side (edges) is written once and never moves
    again. Rows are hash-partitioned by ``col`` first, so every task writes
    exactly one bucket file -- callers keep rows of hot keys out of it;
    ``prepartitioned`` skips that shuffle when the input already is (the
    output of a join or aggregate on ``col`` with the session's shuffle
    partition count equal to ``buckets``)."""
    spark = df.sparkSession
    n = buckets or num_buckets(spark)
    path = scratch_path(spark, name)
    tname = f"tallgrass_{name.replace('-', '_')}_{uuid.uuid4().hex[:12]}"
    aligned = prepartitioned and n == num_buckets(spark)
    (df if aligned else df.repartition(n, col)).write.bucketBy(n, col).sortBy(col) \
        .option("path", path).mode("overwrite").saveAsTable(tname)
    return _tracked(spark.table(tname), path, tname)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store."""
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(jpath, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder of that name in the shared store?"""
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(sc._jsc.hadoopConfiguration()).exists(jpath)


def release(*tables: DataFrame) -> None:
    """Delete the tables behind ``cut_lineage`` results once nothing reads them
    any more. DataFrames that hold no table are left alone."""
    for df in tables:
        held = df.__dict__.pop("_scratch", None)
        for scratch in held if isinstance(held, tuple) else (held,):
            if scratch is None:
                continue
            if scratch.table is not None:
                df.sparkSession.sql(f"DROP TABLE IF EXISTS {scratch.table}")
            delete_path(df.sparkSession, scratch.path)


def holding(result: DataFrame, *tables: DataFrame) -> DataFrame:
    """``result``, which reads ``tables``: it is not computed before a caller
    asks for rows, and releasing it deletes them."""
    held = [t.__dict__.get("_scratch") for t in tables]
    result._scratch = tuple(s for h in held for s in (h if isinstance(h, tuple) else (h,)) if s is not None)
    return result


def settled(result: DataFrame, *tables: DataFrame, name: str = "result") -> DataFrame:
    """``result`` as a table of its own, the intermediate ``tables`` that it was
    made of deleted, where they are larger or more than the result. ``release``
    deletes the result too."""
    out = cut_lineage(result, name)
    release(*tables)
    return out
