"""Run a Structured Streaming query over a bounded replay and return its
complete output as a batch DataFrame (S10, S11, K4, W1, W2, W11, W12).

``event_time_slices`` sorts a table into slices of event time; the replay feeds
them in order, a micro-batch each, so the watermark follows the data and state
is evicted as windows close: what is held at any time is the open windows, not
the table. One running query takes all slices. A slice becomes visible by one
rename of its folder in the shared store, which has to be atomic there, as the
stream's own checkpoint asks too.

A bounded replay in Flink closes every window when the source ends. Spark's
append mode only emits a window once the watermark passes its end, so the
last windows would be withheld. The replay is therefore followed by a sentinel
row with a far-future event time: the watermark jumps, the no-data batch that
follows emits every pending window, and the sentinel's own (still open) window
is never emitted. Stateless queries drop the sentinel by its marker.

Each step waits until all that is visible has been processed; no timing decides
when a stream is done.

Output goes to a parquet file sink (exactly-once via the sink's commit log)
or, for update mode, through ``foreachBatch`` into a ``LatestTable``.
Checkpoint and feed folders are deleted at the end; the output is the result's
own table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrass.session import _tracked, delete_path, scratch_path, shuffle_partitions
from tallgrass.streaming.upsert import LatestTable

#: Rows of a slice at most, and slices at least, of an event-time replay.
SLICE_ROWS, LEAST_SLICES = 20_000_000, 4


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    """A streaming source over a table path -- one file or a folder of
    part files -- with an explicit schema. ``max_files`` limits the files of a
    micro-batch; leave it unset for a replay, whose files are in no order."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(sc._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        # a stream lists folders only: the file's folder, for files of just this name
        return reader.option("pathGlobFilter", at.getName()).load(at.getParent().toString())
    return reader.load(path)


def event_time_slices(df: DataFrame, time_col: str, slice_rows: int = SLICE_ROWS, least: int = LEAST_SLICES) -> list[str]:
    """``df`` as folders of parquet files, each an event-time range, in order:
    ``least`` of them, or as many as hold ``slice_rows`` rows each.

    One range-partitioned write; equal times may be cut between slices, which
    makes no row late. ``df`` should be a scan or a written table. The folders
    lie below one of the shared store, named by the first entry's parent.
    """
    spark = df.sparkSession
    slices = max(least, -(-df.count() // slice_rows))
    files = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // slices))  # of a slice, read side by side
    root = scratch_path(spark, "slices")
    row, part = "_slice_row", "_slice"
    ordered = (df.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(slices * files, time_col, row)
               .withColumn(part, F.floor(F.spark_partition_id() / files)).drop(row))
    ordered.write.partitionBy(part).parquet(root)
    return [f"{root}/{part}={k}" for k in range(slices)]


def run_bounded_stream(spark: SparkSession, source: DataFrame | None, build: Callable[[DataFrame], DataFrame],
                       phases: Iterable[DataFrame] = (), output_mode: str = "append",
                       keys: list[str] | None = None, name: str = "stream", slices: Iterable[str] = (),
                       schema: T.StructType | None = None, progress: list[dict] | None = None,
                       partitions: int | None = None) -> DataFrame:
    """Run ``build(source, then slices, then phases)`` to the end and return
    what the sink holds.

    * ``source``: a streaming DataFrame, or None if the slices are all there is;
      then ``schema`` gives the columns.
    * ``slices``: folders of ``event_time_slices``, fed in order.
    * ``phases``: batch DataFrames with the source's columns. Each is fed after
      everything before it has been processed and the watermark has moved; the
      last is usually a sentinel that flushes open windows.
    * ``output_mode="update"`` needs ``keys``: the result is the last value
      emitted per key.
    * ``progress``: gets one entry per micro-batch: ``batch``, ``rows``, and for
      each stateful operator ``state_rows`` and ``dropped`` (rows that came after
      the watermark, as that operator received them).
    * ``partitions``: of the state, the session's shuffle partitions at most and
      by default. A micro-batch loads and commits every partition of every
      operator whether it has rows or not.
    """
    feed, out_dir, ckpt = (scratch_path(spark, f"{name}-{x}") for x in ("feed", "out", "ckpt"))
    stage = scratch_path(spark, f"{name}-stage")
    phases, slices = list(phases), list(slices)
    schema = schema if source is None else source.schema
    stream = source
    if phases or slices:
        spark.createDataFrame([], schema).write.parquet(f"{feed}/empty")
        fed = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(feed)
        stream = fed if source is None else source.unionByName(fed)
    result = build(stream)

    if output_mode == "update":
        if not keys:
            raise ValueError("update mode needs the key columns")
        table = LatestTable(spark, out_dir, result.schema, keys)
        writer = result.writeStream.outputMode("update").foreachBatch(table.upsert)
    else:
        spark.createDataFrame([], result.schema).write.mode("append").parquet(out_dir)
        writer = result.writeStream.outputMode(output_mode).format("parquet").option("path", out_dir)
    with shuffle_partitions(spark, partitions):  # a query keeps those that it starts with
        query = writer.option("checkpointLocation", ckpt).start()
    try:
        query.processAllAvailable()
        seen = _note(query, -1, progress)
        for k, folder in enumerate(slices):
            _move(spark, folder, f"{feed}/slice-{k:06d}")
            query.processAllAvailable()
            seen = _note(query, seen, progress)
        for k, phase in enumerate(phases):
            phase.select(*schema.names).write.parquet(f"{stage}/phase-{k}")
            _move(spark, f"{stage}/phase-{k}", f"{feed}/phase-{k}")
            query.processAllAvailable()
            seen = _note(query, seen, progress)
    finally:
        query.stop()
    for path in (ckpt, feed, stage, *([slices[0].rpartition("/")[0]] if slices else [])):
        delete_path(spark, path)
    return _tracked(table.read() if output_mode == "update" else spark.read.schema(result.schema).parquet(out_dir), out_dir)


def _move(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder of the shared store; a slice without rows has none."""
    sc = spark.sparkContext
    a, b = sc._jvm.org.apache.hadoop.fs.Path(old), sc._jvm.org.apache.hadoop.fs.Path(new)
    fs = a.getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.exists(a) and not fs.rename(a, b):
        raise OSError(f"{old} could not be renamed")


def _note(query, after: int, into: list[dict] | None) -> int:
    """Append what the batches beyond ``after`` reported; the last batch's number."""
    last = after
    for p in query.recentProgress:
        if p.batchId > after:
            last = max(last, p.batchId)
            if into is not None:
                into.append({"batch": p.batchId, "rows": p.numInputRows,
                             "state_rows": [s.numRowsTotal for s in p.stateOperators],
                             "dropped": [s.numRowsDroppedByWatermark for s in p.stateOperators]})
    return last
