"""Mixing sources to target weights by systematic sampling.

Every row of a source expects ``target / source_size`` copies. Rows stand in a
fixed order within their source; the running sum of expected copies, moved by
one offset per source, crosses an integer boundary as often as the row is
emitted. All rows of a source expect the same number, so the running sum is
that number times the row's position.

Positions are found without gathering a source: the order is (size class,
hash bucket, size, id), blocks of (source, class, bucket) are counted with
partial aggregation, a window over the few block counts gives each block's
start, and positions inside a block complete it. Ordering by
size spreads the boundaries evenly over short and long rows, which keeps the
words taken near the target.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import borrowed, fresh, written

#: Fixed values of the mix: weights by source order, share of all words, most copies of a source.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0


def hash32(col: Column, seed: str) -> Column:
    """The first 32 bits of an MD5 as a long: the same in any SQL engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), col).cast("binary")), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, source: str = "source", size: str = "source_size") -> DataFrame:
    """``sizes`` (one row per source) with ``target``.

    Sources by code point, null last, weigh 5, 2, 1, repeating. A target is the
    smaller of ``MOST * size`` and ``weight * level``: handing the excess of
    full sources to the others by weight until none is above its limit ends
    there. In order of ``MOST * size / weight`` the full sources come first, so
    the level follows from running sums.
    """
    w, full_at, full, heavy, level = "_w", "_at", "_full", "_heavy", "_level"
    place = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in WEIGHTS]), ((place - 1) % len(WEIGHTS) + 1).cast("int"))
    by_limit = Window.orderBy(full_at, F.col(source).asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap = F.lit(MOST) * F.col(size)
    return (sizes.withColumn(w, weight)
            .withColumn(full_at, cap / F.col(w))
            .withColumn(full, F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
            .withColumn(heavy, F.sum(w).over(rest))
            .withColumn(level, (F.lit(SHARE) * F.sum(size).over(everything) - F.col(full)) / F.col(heavy))
            # the level if this source is the first that is not full; it falls from there on, and holds first at the true one
            .withColumn(level, F.max(F.when(F.col(level) <= F.col(full_at), F.col(level))).over(everything))
            .withColumn("target", F.least(cap, F.col(w) * F.coalesce(F.col(level), F.col(full_at))))
            .drop(w, full_at, full, heavy, level))


def word_count(text: str = "text") -> Column:
    """Words (runs of anything but ASCII white space) of a text; null has none."""
    col = F.coalesce(F.col(text), F.lit(""))
    pieces = F.size(F.split(col, r"[\x20\x09-\x0D]+"))
    outside = col.rlike(r"^[\x20\x09-\x0D]").cast("int") + col.rlike(r"[\x20\x09-\x0D]\z").cast("int")
    return F.when(col == "", 0).otherwise(pieces - outside).cast("long")


def systematic_copies(df: DataFrame, size: str = "size", source: str = "source", id_col: str = "doc_id",
                      seed: str = "mix") -> DataFrame:
    """``df`` with ``source_size``, ``target`` and ``copies`` (0, 1 or 2); the
    column ``size`` holds each row's words. ``df`` is read twice.

    Columns of ``df`` named like the added ones are replaced. Equal ids in a
    source take neighbouring positions; which of them comes first does not
    change the counts of the others. Null sources are one source, null ids
    stand last, null sizes count as 0; a source without words has target 0 and
    no copies. An empty table gives an empty result.
    """
    keep = [c for c in df.columns if c.lower() not in ("source_size", "target", "copies")]
    key, cls, bucket, n, words, first, pos, each, moved = fresh(
        df, "key", "cls", "bucket", "n", "words", "first", "pos", "each", "moved")
    # Rows of a block and blocks of a source both stay near the square root of all rows.
    buckets = math.ceil(math.sqrt(df.count()) / 8) or 1
    amount = F.coalesce(F.col(size), F.lit(0))
    placed = df.select(*keep).withColumns({
        key: F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")),
        cls: F.floor(F.log2(amount + 1)).cast("int"),
        bucket: F.pmod(hash32(F.coalesce(F.col(id_col).cast("string"), F.lit("")), seed), F.lit(buckets))})
    block = [key, cls, bucket]
    blocks = placed.groupBy(*block, source).agg(F.count("*").alias(n), F.sum(amount).alias(words))
    per_source = source_targets(blocks.groupBy(key, source).agg(F.sum(words).alias("source_size")), source)
    earlier = Window.partitionBy(key).orderBy(cls, bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = (blocks.select(*block, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(first))
              .join(per_source.drop(source), key))
    inside = Window.partitionBy(*block).orderBy(amount, F.col(id_col).asc_nulls_last())
    joined = placed.withColumn(pos, F.row_number().over(inside)).join(starts, block)
    last = F.col(first) + F.col(pos)
    crossed = F.floor(F.col(each) * last + F.col(moved)) - F.floor(F.col(each) * (last - 1) + F.col(moved))
    return joined.withColumns({
        each: F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0),
        moved: hash32(F.col(key), seed) / F.lit(2.0 ** 32),
    }).select(*keep, "source_size", "target", crossed.cast("int").alias("copies"))


def mix(df: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """``df`` with every row repeated as often as the mix takes it (0, 1 or 2
    times), all columns handed through. Null and empty texts have size 0 and
    stand with the shortest; null sources are one source, null ids come last, rows
    with equal ids next to each other. An empty table gives an empty result."""
    row, size = fresh(df, "row", "size")
    # texts are read and counted once; only numbers are ranked
    rows = written(df.withColumns({row: F.monotonically_increasing_id(), size: word_count(text)}), "mix-rows")
    slim = rows.select(F.col(row).alias("row"), F.col(source).alias("source"), F.col(id_col).alias("doc_id"), F.col(size).alias("size"))
    taken = systematic_copies(slim).filter("copies > 0").select(F.col("row").alias(row), F.sequence(F.lit(1), F.col("copies")).alias(size))
    out = rows.drop(size).join(taken, row).withColumn(size, F.explode(size)).select(*df.columns)
    return borrowed(out, rows)
