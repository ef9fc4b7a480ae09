"""The eight access-log analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.sources.weblog import with_weekday


def distinct_clients(logs: DataFrame, approx: bool = False) -> DataFrame:
    """A9 ``select(ip).distinct().count()``. Exact by default; ``approx``
    switches to HyperLogLog++ (no shuffle of the distinct set at scale)."""
    agg = F.approx_count_distinct("ipAddress") if approx else F.count_distinct("ipAddress")
    return logs.agg(agg.alias("n_clients"))


def client_sketches(logs: DataFrame, *by: str, lg_k: int = 12) -> DataFrame:
    """A9 one mergeable distinct-count sketch of ``ipAddress`` per group: a few
    kilobytes each, so a day's sketch can be stored and any days merged later
    without the log. ``2 ** lg_k`` registers: a relative error of about
    ``0.83 / sqrt(2 ** lg_k)`` (1.3 % at 12)."""
    return logs.groupBy(*by).agg(F.hll_sketch_agg("ipAddress", F.lit(lg_k)).alias("sketch"))


def merged_clients(sketches: DataFrame) -> DataFrame:
    """A9 the distinct clients of several sketches together (estimate)."""
    return sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_clients"))


def content_stats(logs: DataFrame) -> DataFrame:
    """A10 min / avg / max content size in one pass."""
    return logs.agg(F.min("contentSize").alias("min_size"), F.avg("contentSize").alias("avg_size"),
                    F.max("contentSize").alias("max_size"))


def code_counts(logs: DataFrame) -> DataFrame:
    """A6 count per response code (a NULL code is a group)."""
    return logs.groupBy("responseCode").agg(F.count(F.lit(1)).alias("count"))


def code_percentage(logs: DataFrame) -> DataFrame:
    """A11 share of all parsed rows per code, in percent, rounded half-up to 2
    places. The total is a scalar subquery summing the per-code counts, not a
    cross join; it repeats the count's aggregation, whose shuffle Spark reuses,
    so the log is scanned once. The rounding is done on integers so it is
    exact: round(100 * n / total, 2) = floor((20000 n + total) / (2 total)) / 100."""
    counts = code_counts(logs)
    total = counts.select(F.sum("count")).scalar()
    hundredths = F.floor((F.col("count") * 20000 + total) / (total * 2))
    return counts.withColumn("percentage", hundredths / F.lit(100.0))


def gold_customers(logs: DataFrame, n: int = 10) -> DataFrame:
    """T1 top-n clients by request count (ties: lowest address first).
    Plans as a partial count, a shuffle of (ip, count), and a per-task top-n
    merged once -- never a global sort."""
    return (logs.groupBy("ipAddress").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("ipAddress").asc()).limit(n))


def forbidden_sql(logs: DataFrame, view: str = "AccessLog") -> DataFrame:
    """F4 via SQL text over a temp view, as the reference does."""
    logs.createOrReplaceTempView(view)
    return logs.sparkSession.sql(f"SELECT dateTime, endpoint FROM {view} WHERE responseCode = 403")


def day_counts(logs: DataFrame) -> DataFrame:
    """A6/T9 requests per weekday (Monday = 0), sorted by day."""
    return (with_weekday(logs).groupBy("dayOfWeek").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("dayOfWeek"))


def _ip_day(logs: DataFrame) -> DataFrame:
    return with_weekday(logs).groupBy("ipAddress", "dayOfWeek").agg(F.count(F.lit(1)).alias("count"))


def ip_day_counts(logs: DataFrame) -> DataFrame:
    """A7/T4 requests per (client, weekday), sorted by both."""
    return _ip_day(logs).orderBy("ipAddress", "dayOfWeek")


def gold_access(logs: DataFrame, n: int = 10) -> DataFrame:
    """J2 weekday pattern of the top-n clients.

    Counting per (client, weekday) first and joining the top-n afterwards
    gives the same rows as the reference's join-then-count, but the join then
    sees one row per (client, weekday) instead of one per request, and the
    top-n is ranked from those same counts: the (client, weekday) aggregation
    is planned twice with identical shuffles, which Spark reuses, so the log
    is scanned once. The top-n side holds at most n rows by construction, so
    broadcasting it is size-safe; only the address is taken from it (the
    reference drags its count column along)."""
    # The parser never yields a NULL address; stating it on both branches keeps
    # them identical after filter inference, so the shuffle is reused.
    per_day = _ip_day(logs.where(F.col("ipAddress").isNotNull()))
    gold = (per_day.groupBy("ipAddress").agg(F.sum("count").alias("total"))
            .orderBy(F.col("total").desc(), F.col("ipAddress").asc()).limit(n).select("ipAddress"))
    return per_day.join(F.broadcast(gold), "ipAddress").orderBy("ipAddress", "dayOfWeek")
