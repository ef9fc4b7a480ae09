"""Joins and ranks that no hot key slows down.

Spark splits a skewed join partition only where both sides are plain shuffles
of enough bytes. A lookup that is an aggregate on the join key is not one, so
rows that share a key all meet in one task. ``join_unique`` cuts such keys up
itself; ``ranked`` numbers the rows of each key without gathering a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.session import cut_lineage, num_buckets

#: A key is hot beyond 1 / (SHARES * partitions) of all rows, so there are at most SHARES * partitions hot keys.
SHARES = 8
#: Fewer rows than this are one piece, whatever their share.
LEAST_PIECE = 64


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, one for each of ``names``."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        cand = f"_{name}"
        while cand.lower() in have:
            cand = f"_{cand}"
        have.add(cand.lower())
        out.append(cand)
    return out


def hot_keys(counts: DataFrame, key: str, n: str) -> list[tuple]:
    """``(key, pieces)`` of the keys with more than ``1 / (SHARES * partitions)``
    of all rows, from ``counts`` (one row per key, ``n`` rows each). The list has
    at most ``SHARES * partitions`` entries, whatever the data."""
    shares = SHARES * num_buckets(counts.sparkSession)
    total = counts.agg(F.sum(n)).first()[0] or 0
    limit = max(LEAST_PIECE, -(-total // shares))
    hot = counts.where(F.col(n) > limit).select(key, F.ceil(F.col(n) / limit).cast("int"))
    return [tuple(r) for r in hot.collect()]


def join_unique(rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner",
                hot: list[tuple] | None = None, shuffled: bool = False) -> DataFrame:
    """``rows`` joined (``inner`` or ``left``) to ``lookup``, which has one row per ``key``.

    The bounded list of hot keys (counted here unless ``hot`` gives it) is cut
    into pieces by row number: their lookup rows are repeated once a piece, and
    each piece goes to a task of its own. All other keys join as usual. ``rows``
    should be a scan or a written table, so that a task that runs again numbers
    its rows the same way. Columns: those of ``rows``, then those of ``lookup``
    but its key. Null keys match nothing; in a left join they are spread like
    any other key. ``shuffled`` never broadcasts ``rows`` or ``lookup``, however
    small Spark takes them to be: it estimates a written table by its compressed
    files and rows that ``explode`` makes by what they are made of.
    """
    if hot is None:
        (n,) = fresh(rows, "n")
        hot = hot_keys(rows.groupBy(key).agg(F.count(F.lit(1)).alias(n)), key, n)
    rest = [c for c in lookup.columns if c != key]
    if not hot:
        return rows.join(lookup.hint("merge") if shuffled else lookup, key, how).select(*rows.columns, *rest)
    names = rows.select("*", *[F.lit(0).alias(c) for c in rest])
    hot_key, cut, piece, look = fresh(names, "hot", "cut", "piece", "look")
    kind = rows.schema[key].dataType.simpleString()
    few = F.broadcast(rows.sparkSession.createDataFrame(hot, f"`{hot_key}` {kind}, `{cut}` int"))
    cut_rows = (rows.withColumn(piece, F.monotonically_increasing_id())
                .join(few, F.col(key).eqNullSafe(F.col(hot_key)), "left")
                .select(*rows.columns, F.coalesce(F.pmod(F.col(piece), F.col(cut)), F.lit(0)).cast("int").alias(piece)))
    copies = (lookup.withColumnRenamed(key, look).join(few, F.col(look) == F.col(hot_key), "left")
              .select(look, *rest, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(cut), F.lit(1)) - 1)).alias(hot_key)))
    copies = copies.hint("merge") if shuffled else copies
    return (cut_rows.join(copies, (F.col(key) == F.col(look)) & (F.col(piece) == F.col(hot_key)), how)
            .select(*rows.columns, *rest))


def ranked(df: DataFrame, key: str, order: list[Column], n: str, rank: str, size: str, name: str = "ranked") -> DataFrame:
    """``df`` with ``rank``, the rows of its ``key`` before it in ``order``, and
    ``size``, all rows of the key, where a row stands for ``n`` equal ones.

    A range-partitioned sort spreads a hot key over many partitions; sums per
    key and partition (one row for each partition that a key touches) give each
    partition's first rank, and a running sum inside the partition the rest.
    ``order`` must put every two rows of a key apart, except for rows that may
    stand either way. The sorted rows are a written table; ``release`` of the
    result deletes it.
    """
    part, pos, first, start = fresh(df, "part", "pos", "first", "start")
    rows = cut_lineage(df.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
                       .withColumns({part: F.spark_partition_id(), pos: F.monotonically_increasing_id()}), name)
    sums = rows.groupBy(key, part).agg(F.sum(n).alias(first))
    of_key = Window.partitionBy(key)
    starts = sums.select(
        F.col(key).alias(start), F.col(part).alias(pos),
        F.coalesce(F.sum(first).over(of_key.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(first),
        F.sum(first).over(of_key).alias(size))
    inside = Window.partitionBy(key, part).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn(rank, F.coalesce(F.sum(n).over(inside), F.lit(0))).drop(pos)
    out = placed.join(starts, F.col(key).eqNullSafe(F.col(start)) & (F.col(part) == F.col(pos))).select(
        *df.columns, (F.col(rank) + F.col(first)).alias(rank), size)
    out._scratch = rows._scratch
    return out
