"""Key/value pair operators.

A pair collection is a DataFrame with a ``key`` and a ``value`` column. All
operators are column expressions, joins or hash aggregates; grouped lists are
paged (at most ``PAGE_SIZE`` values per row, see ``group_values``), so no row
or task ever holds a whole hot key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.session import cut_lineage, holding

# Values per row of a grouped list.
PAGE_SIZE = 4096


def keys(df: DataFrame) -> DataFrame:
    """P6 ``rdd.keys()`` (duplicates kept)."""
    return df.select("key")


def values(df: DataFrame) -> DataFrame:
    """P6 ``rdd.values()`` (duplicates kept)."""
    return df.select("value")


def map_pairs(df: DataFrame, key_fn: Callable[[Column], Column],
              value_fn: Callable[[Column], Column]) -> DataFrame:
    """P4 ``rdd.map(lambda kv: (f(k), g(v)))``."""
    return df.select(key_fn(F.col("key")).alias("key"), value_fn(F.col("value")).alias("value"))


def map_values(df: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    """P5 ``rdd.mapValues(f)``: keys untouched, so a following aggregate on
    ``key`` keeps any existing partitioning."""
    return df.withColumn("value", fn(F.col("value")))


def lookup(df: DataFrame, key) -> DataFrame:
    """F8 ``rdd.lookup(k)``: the values stored under one key (pushed to the scan)."""
    return df.where(F.col("key") == F.lit(key)).select("value")


def reduce_by_key(df: DataFrame, agg: Callable[[Column], Column] = F.sum) -> DataFrame:
    """A4 ``reduceByKey`` for a built-in aggregate: partial aggregate per task,
    final aggregate after the shuffle -- a hot key costs one row per task."""
    return df.groupBy("key").agg(agg(F.col("value")).alias("value"))


def _folded(values: str, fn: Callable[[Column, Column], Column]) -> Column:
    """One value from a list of (value) structs; the structs keep NULL values."""
    arr = F.collect_list(F.struct(F.col(values).alias("x")))
    return F.aggregate(F.slice(arr, 2, F.size(arr)), F.element_at(arr, 1)["x"], lambda acc, s: fn(acc, s["x"]))


def fold_by_key(df: DataFrame, fn: Callable[[Column, Column], Column]) -> DataFrame:
    """U7 ``reduceByKey(f)`` for an arbitrary associative, commutative binary
    column function; NULL values are passed to it like any other.

    Spark has no Python binary-reduce aggregate, and folding ``collect_list``
    per key would put a hot key's whole group in one task. Keys with more than
    a quarter of a mean partition's rows -- at most four times the partition
    count of them, so their list may be broadcast -- are cut into pieces by row
    number first; every other group is folded at once. A second grouping folds
    the pieces, of which a key has at most four times the partition count.
    """
    spark = df.sparkSession
    shares = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    limit = max(PAGE_SIZE, -(-(counts.agg(F.sum("_n")).first()[0] or 0) // shares))
    hot = counts.where(F.col("_n") > limit).select(F.col("key").alias("_hot"), F.ceil(F.col("_n") / limit).cast("bigint").alias("_cut"))
    rows = (df.select("key", "value", F.monotonically_increasing_id().alias("_row"))
            .join(F.broadcast(hot), F.col("key").eqNullSafe(F.col("_hot")), "left")
            .select("key", "value", F.coalesce(F.pmod("_row", "_cut"), F.lit(0)).alias("_piece")))
    pieces = rows.groupBy("key", "_piece").agg(_folded("value", fn).alias("value"))
    return pieces.groupBy("key").agg(_folded("value", fn).alias("value"))


def _paged(pairs: DataFrame, page_size: int, name: str) -> DataFrame:
    """``key, page, side, values`` of ``pairs`` (``key, side, value``): the
    page-th run of at most ``page_size`` of the values that a key has on a side,
    in sorted order, NULL values last. See ``group_values``."""
    order = ["key", "side", F.col("value").asc_nulls_last()]
    counted = pairs.groupBy("key", "side", "value").agg(F.count(F.lit(1)).alias("_n"))
    # No explicit partition count: AQE may merge small ranges.
    rows = cut_lineage(counted.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumns({"_pid": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()}), f"{name}-pairs")
    run = ["key", "side", "_pid"]
    before = Window.partitionBy("key", "side").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(*run).agg(F.sum("_n").alias("_sum"))
              .select(F.struct(*run).alias("_of"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy(*run).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (rows.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
              .join(starts, F.struct(*run).eqNullSafe(F.col("_of")))
              .select("key", "side", "value", "_n", (F.col("_start") + F.col("_in")).alias("_first")))
    last = F.col("_first") + F.col("_n") - 1
    paged = ranked.select("key", "side", "value", "_first", "_n", F.explode(F.sequence(
        F.floor(F.col("_first") / page_size), F.floor(last / page_size))).alias("page"))
    lo = F.greatest(F.col("_first"), F.col("page") * page_size)
    hi = F.least(last + 1, (F.col("page") + 1) * page_size)
    runs = paged.select("key", "page", "side", F.array_repeat("value", (hi - lo).cast("int")).alias("_run"))
    return holding(runs, rows)


def group_values(df: DataFrame, page_size: int = PAGE_SIZE, name: str = "group") -> DataFrame:
    """A5 ``groupByKey().mapValues(list)`` as paged lists: rows ``(key, page,
    values)`` where ``values`` is the page-th run of at most ``page_size`` of the
    key's values in sorted order, NULL values last. A key with up to
    ``page_size`` values is one row, exactly the reference's (key, list); a key
    holding a third of all rows becomes many bounded rows instead of one row
    the size of its group.

    Equal (key, value) pairs are counted first (partial aggregates), so a
    repeated pair is one row however often it occurs. A range-partitioned sort
    of the distinct pairs, the only thing written, spreads a hot key over many
    partitions; sums per (key, partition) -- one row per partition that a key
    touches -- and a running sum inside the partition give each pair's first
    rank, and the ranks its pages. ``release`` of the result deletes the pairs.
    """
    runs = _paged(df.select("key", F.lit(0).alias("side"), "value"), page_size, name)
    out = runs.groupBy("key", "page").agg(F.array_sort(F.flatten(F.collect_list("_run"))).alias("values"))
    return holding(out, runs)


def cogroup(left: DataFrame, right: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """J9 ``coGroup``: per key and page the values of both sides (sorted, NULL
    last, at most ``page_size`` per side and row), an empty array for a side
    without the key or that page.

    Both sides are tagged and sorted as one: one written table, one grouping,
    no join. Their values may have different types."""
    lt, rt = left.schema["value"].dataType, right.schema["value"].dataType
    both = (left.select("key", F.lit(0).alias("side"), F.struct(F.col("value").alias("l"), F.lit(None).cast(rt).alias("r")).alias("v"))
            .unionByName(right.select("key", F.lit(1).alias("side"), F.struct(F.lit(None).cast(lt).alias("l"), F.col("value").alias("r")).alias("v"))))
    # NULL values sort last on their own side
    value = F.struct((F.col("v.l").isNull() & F.col("v.r").isNull()).alias("none"), "v.l", "v.r")
    runs = _paged(both.select("key", "side", value.alias("value")), page_size, "cogroup")

    def of(side: int, field: str, kind) -> Column:
        found = F.array_sort(F.flatten(F.collect_list(F.when(F.col("side") == side, F.col("_run")))))
        return F.transform(found, lambda x: x[field])

    out = runs.groupBy("key", "page").agg(of(0, "l", lt).alias("left_values"), of(1, "r", rt).alias("right_values"))
    return holding(out, runs)


def join_pairs(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """J1/J8 ``a.join(b)`` on the key. Catalyst picks broadcast (only when the
    side's size estimate is below ``autoBroadcastJoinThreshold``) or
    sort-merge; AQE re-plans and splits skewed partitions at run time."""
    return left.join(right, "key", how)


def flat_map_range(df: DataFrame, col: str = "x", out: str = "v") -> DataFrame:
    """P7 ``flatMap(lambda x: range(0, x))``; x <= 0 emits nothing."""
    return df.where(F.col(col) > 0).select(F.explode(F.sequence(F.lit(0), F.col(col) - 1)).alias(out))


def range_list(x: Column) -> Column:
    """P8 ``list(range(0, x))`` as an array; empty for x <= 0."""
    return F.when(x > 0, F.sequence(F.lit(0), x - 1)).otherwise(F.array().cast("array<int>"))


def filter_even(df: DataFrame, col: str = "x") -> DataFrame:
    """F1 ``filter(x % 2 == 0)``."""
    return df.where(F.col(col) % 2 == 0)
