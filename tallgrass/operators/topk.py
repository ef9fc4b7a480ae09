"""Top-k, distinct top-k, first-n and repeatable sampling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """``top(n, key)``: orderBy + limit plans as TakeOrderedAndProject -- each
    task keeps its own n best rows and only those are merged."""
    return df.orderBy(*order).limit(n)


def top_k_distinct(df: DataFrame, key: str, n: int = 10, keep_by: str = "Id",
                   payload: str = "record") -> DataFrame:
    """T6 the n highest *distinct* values of ``key``, one record per value.

    The reference keeps a TreeMap per mapper, so among records with the same
    key only one survives (arrival order decides); here the record with the
    highest ``keep_by`` survives (of equal ones the first in text order), which
    is repeatable; NULL keys come last.

    One scan. Like the reference's mappers each task keeps at most n keys: Arrow
    batches are pruned to the n best distinct keys of the task so far, and a
    task hands on n rows at the end, so the one merging task gets n rows from
    each task. Nothing is sorted or shuffled in full."""
    columns = [key, payload, keep_by]
    schema = df.select(*columns).schema

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = _best_distinct(new if held is None else pa.concat_tables([held, new]), n)
        if held is not None:
            yield from held.to_batches()

    per_task = df.select(*columns).mapInArrow(best, schema)
    return per_task.repartition(1).mapInArrow(best, schema).orderBy(F.col(key).desc()).limit(n)


def _best_distinct(rows: pa.Table, n: int) -> pa.Table:
    """Of columns (key, payload, keep_by): the n highest keys, each with its best row."""
    key, payload, keep_by = rows.column_names
    distinct = pc.unique(rows[key])
    top = distinct.take(pc.sort_indices(distinct, sort_keys=[("", "descending")], null_placement="at_end")[:n])
    rows = rows.filter(pc.is_in(rows[key], value_set=top))
    rows = rows.take(pc.sort_indices(rows, sort_keys=[(key, "descending"), (keep_by, "descending"), (payload, "ascending")],
                                     null_placement="at_end"))
    first = np.flatnonzero(np.diff(np.asarray(pc.index_in(rows[key], value_set=top)), prepend=-1))
    return rows.take(pa.array(first))


def first_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """T8 ``take(n)`` made repeatable: the first n rows in key order."""
    return df.orderBy(*order).limit(n)


def sample_n(df: DataFrame, n: int, key_cols: list[str], seed: int = 42) -> DataFrame:
    """T7 ``takeSample(False, n)``: exactly n distinct rows, uniformly by a
    seeded hash order. ``rand(seed)`` would depend on the partitioning; the
    md5 of (key, seed) does not, so reruns and retried tasks agree."""
    h = F.md5(F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols],
                       F.lit(f":{seed}")))
    return df.orderBy(h, *key_cols).limit(n)
