"""Exact top-k search by inner product, in tiles.

Queries and candidates are packed into matrix files of bounded size in the
shared store. A tile is one query file against one candidate file: a matrix
product, then a partial selection of each query's best rows. A task merges the
tiles it has of one query file; the lists of different tasks are merged by a
tree of bounded fan-in. No vector is shuffled, nothing is broadcast, and only
pairs of file names are paired up.

Vectors become integers ``floor(256 * x)``, and scores are exact: a tile is
multiplied in float32 or float64 where every partial sum is an integer that the
type holds, else in Python's integers.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import delete_path, release
from .common import partitions, shared_path, small_batches, written
from .worker import Folder

QUERY_ROWS, SHARD_ROWS, FAN_IN, SHARDS_A_TASK = 1024, 4096, 16, 64
LONG = np.iinfo(np.int64)


def scaled(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector's ``floor(256 * x)``; None for vectors that take no part:
    null ones, and those with a null or non-finite component (also one so
    large that 256 times it is not finite)."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    with np.errstate(over="ignore", invalid="ignore"):  # a null component becomes NaN
        x = np.floor(256.0 * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    ends, wrong = np.cumsum(sizes), np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    good = column.is_valid().to_numpy(zero_copy_only=False) & (wrong[ends] == wrong[ends - sizes])
    return [x[e - n:e] if g else None for g, n, e in zip(good.tolist(), sizes.tolist(), ends.tolist(), strict=True)]


def write_matrices(df: DataFrame, folder: str, rows: int, vec_id: str, vector: str) -> DataFrame:
    """Vectors of ``df`` as matrix files of at most ``rows`` rows of one
    length, in order of their id; returns ``dim``, ``file`` and ``n``."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Folder(folder)
        held: dict[int, list[tuple[int | None, np.ndarray]]] = {}

        def close(dim: int) -> pa.RecordBatch:
            some = sorted(held.pop(dim), key=lambda r: (r[0] is None, r[0] or 0))
            ids = np.array([LONG.max if i is None else i for i, _ in some], np.int64)
            buf = io.BytesIO()
            np.savez(buf, ids=ids, null=np.array([i is None for i, _ in some]), x=np.array([x for _, x in some]).reshape(len(some), dim))
            return pa.RecordBatch.from_arrays([pa.array([dim]), pa.array([out.write(".npz", buf.getvalue())]), pa.array([len(some)])],
                                              names=["dim", "file", "n"])

        for batch in batches:
            for i, x in zip(batch.column(0).to_pylist(), scaled(batch.column(1)), strict=True):
                if x is not None:
                    held.setdefault(len(x), []).append((i, x))
                    if len(held[len(x)]) >= rows:
                        yield close(len(x))
        for dim in list(held):
            yield close(dim)

    packed = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("x")).mapInArrow(run, "dim long, file string, n long")
    return written(packed, "matrices")


def load(store: Folder, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    with np.load(io.BytesIO(store.read(name))) as z:
        return z["ids"], z["null"], z["x"]


def product(q: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Exact inner products, as float64 if they fit it, else as integers cut to the range of a long."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(s).max(initial=0)) * max(1, q.shape[1])
    if bound < 2**24:
        return (q.astype(np.float32) @ s.astype(np.float32).T).astype(np.float64)
    if bound < 2**53:
        return q @ s.T
    a, b = ([[int(v) for v in row] for row in m] for m in (q, s))
    return np.array([[sum(map(int.__mul__, x, y)) for y in b] for x in a], object)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the ``k`` highest scores of each row (fewer columns if there
    are fewer), the earlier column first on ties, and which of them count.
    ``own`` marks cells that take no part."""
    n = scores.shape[1]
    if scores.dtype == object or np.abs(scores).max(initial=0) * n >= 2**53:
        rows = [sorted(range(n), key=lambda j: (own[i, j], -int(scores[i, j]), j))[:k] for i in range(len(scores))]
        at = np.array(rows, np.int64).reshape(len(scores), min(k, n))
    else:  # one number orders scores and then columns
        key = np.where(own, np.inf, -(scores * n) + np.arange(n))
        part = np.argpartition(key, k - 1, axis=1)[:, :k] if n > k else np.broadcast_to(np.arange(n), scores.shape)
        at = np.take_along_axis(part, np.argsort(np.take_along_axis(key, part, 1), axis=1, kind="stable"), 1)
    return at, ~np.take_along_axis(own, at, 1)


def as_long(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array([[min(max(int(v), LONG.min), LONG.max) for v in row] for row in scores], np.int64).reshape(scores.shape)
    return scores.astype(np.int64)


def tile(q: tuple, s: tuple, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Scores, ids, null-id marks and validity of each query's best rows of a candidate file."""
    scores = product(q[2], s[2])
    own = (q[0][:, None] == s[0][None, :]) & ~s[1][None, :]
    at, valid = best_of(scores, s[0], k, own)
    return as_long(np.take_along_axis(scores, at, 1)), s[0][at], s[1][at], valid


def merged(a: tuple | None, b: tuple, k: int) -> tuple:
    """The best ``k`` of two lists per query: higher score, then smaller id (null last)."""
    if a is not None:
        b = tuple(np.hstack(x) for x in zip(a, b, strict=True))
    order = np.lexsort((b[1], b[2], ~b[0], ~b[3]), axis=1)[:, :k]
    return tuple(np.take_along_axis(x, order, 1) for x in b)


def best_entries(lists: Column, k: int) -> Column:
    """The first ``k`` entries of several sorted lists of (turned score, null id, id)."""
    return F.slice(F.array_sort(F.flatten(lists)), 1, k)


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k``
    rows of ``vectors`` with the highest inner product with each row of
    ``queries`` (all, if fewer), ties to the smaller id (null last).

    Rows with a query's own id are not its candidates. Only vectors of equal
    length are compared. Queries with a null id take no part; a repeated query
    row gives its list again. Scores beyond a long stop at its limits. Empty
    tables give an empty result.
    """
    spark = vectors.sparkSession
    folder = shared_path(spark, "top-k")
    asked = queries.filter(F.col(vec_id).isNotNull())
    blocks = write_matrices(asked.repartition(max(1, math.ceil(asked.count() / QUERY_ROWS))), folder, QUERY_ROWS, vec_id, vector)
    shards = write_matrices(vectors, folder, SHARD_ROWS, vec_id, vector)
    n_blocks, n_shards = blocks.count(), shards.count()
    # every candidate file meets every query file of its length; a task has some candidate files of one query file
    spread = max(1, math.ceil(2 * partitions(spark) / max(1, n_blocks)), math.ceil(n_shards / SHARDS_A_TASK))
    numbered = blocks.select("dim", F.col("file").alias("block"),
                             (F.row_number().over(Window.partitionBy("dim").orderBy("file")) - 1).alias("g"))
    pairs = (shards.select("dim", "file", F.explode(F.sequence(F.lit(0), F.lit(max(0, n_blocks - 1)))).alias("g"))
             .join(numbered, ["dim", "g"])
             .select("block", "file", F.pmod(F.xxhash64("file"), F.lit(spread)).alias("node")))
    tasks = pairs.repartition(max(1, min(n_blocks * spread, 4 * partitions(spark))), "block", "node") \
        .sortWithinPartitions("block", "node", "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at, top, q = Folder(folder), None, None, None

        def close() -> pa.RecordBatch:
            score, ids, null, valid = top
            n, size = score.shape[0], valid.sum(1)
            entry = pa.StructArray.from_arrays(
                [pa.array(~score[valid]), pa.array(null[valid]), pa.array(ids[valid], mask=null[valid])], names=["turned", "late", "id"])
            cols = [pa.array([at[0]] * n), pa.array([at[1]] * n, pa.int64()), pa.array(np.arange(n)), pa.array(q[0]),
                    pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), entry)]
            return pa.RecordBatch.from_arrays(cols, names=["block", "node", "row", "query_id", "top"])

        for batch in batches:
            for block, file, node in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != (block, node):
                    if at:
                        yield close()
                    if not at or at[0] != block:
                        q = load(store, block)
                    at, top = (block, node), None
                top = merged(top, tile(q, load(store, file), k), k)
        if at:
            yield close()

    top = written(tasks.mapInArrow(run, "block string, node long, row long, query_id long, "
                                   "top array<struct<turned long, late boolean, id long>>"), "tile-tops")
    release(blocks, shards)
    delete_path(spark, folder)
    while spread > 1:  # merge the lists of FAN_IN tasks at a time
        spread = math.ceil(spread / FAN_IN)
        top = top.withColumn("node", F.floor(F.col("node") / FAN_IN)).groupBy("block", "row", "query_id", "node").agg(
            best_entries(F.collect_list("top"), k).alias("top"))
    return top.select("query_id", F.posexplode("top").alias("pos", "x")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("x.id").alias("vec_id"), F.bitwise_not("x.turned").alias("score"))
