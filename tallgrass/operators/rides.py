"""Taxi-ride operators.

Every function takes a batch *or* a streaming DataFrame of ride events with
``isStart``, integer micro-degree ends (``startLon_u`` ...) and an event-time
column ``eventTime``; the same logical plan runs either way. Streaming callers
attach the watermark first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.functions.geo import Box, Grid, ntz_from_instant

NEW_YORK = "America/New_York"


def clean(rides: DataFrame, box: Box) -> DataFrame:
    """Keep rides whose start *and* end lie in the box (stateless)."""
    return rides.where(box.contains(F.col("startLon_u"), F.col("startLat_u"))
                       & box.contains(F.col("endLon_u"), F.col("endLat_u")))


def with_cells(rides: DataFrame, grid: Grid) -> DataFrame:
    """Start and end cell ids and the start cell's centre."""
    sc = grid.cell(F.col("startLon_u"), F.col("startLat_u"))
    return rides.select(
        "rideId",
        sc.alias("startCell"),
        grid.cell(F.col("endLon_u"), F.col("endLat_u")).alias("endCell"),
        grid.center_lon(sc).alias("startCenterLon"),
        grid.center_lat(sc).alias("startCenterLat"),
    )


def event_cell(grid: Grid, side: str = "event") -> Column:
    """The cell of the side the event is about -- the start for a
    departure, the end for an arrival (``side="event"``), or always the start
    (``side="start"``, what the popular-places job does)."""
    start = grid.cell(F.col("startLon_u"), F.col("startLat_u"))
    if side == "start":
        return start
    return F.when(F.col("isStart"), start).otherwise(grid.cell(F.col("endLon_u"), F.col("endLat_u")))


def _epoch_millis(ts: Column, ntz: bool) -> Column:
    # unix_timestamp of a TIMESTAMP_NTZ reads it as UTC (no session zone).
    return F.unix_timestamp(ts) * 1000 if ntz else F.unix_millis(ts)


def popular_places(rides: DataFrame, box: Box, grid: Grid, threshold: int = 20,
                   size: str = "15 minutes", slide: str = "5 minutes",
                   cell_side: str = "start") -> DataFrame:
    """F5 -> P9 -> W4/W5 -> F7 -> P10.

    Count rides per (cell, isStart) in sliding event-time windows and keep
    counts strictly above ``threshold``. Output: cell centre, window end in
    epoch millis, isStart, count. The count is an incremental aggregate (one
    number per key and window), never a buffered window.
    """
    ntz = dict(rides.dtypes)["eventTime"] == "timestamp_ntz"
    counted = (clean(rides, box)
               .select(event_cell(grid, cell_side).alias("cell"), "isStart", "eventTime")
               .groupBy(F.window("eventTime", size, slide).alias("window"), "cell", "isStart")
               .agg(F.count(F.lit(1)).alias("count")))
    return (counted.where(F.col("count") > threshold)
            .select(grid.center_lon(F.col("cell")).alias("centerLon"),
                    grid.center_lat(F.col("cell")).alias("centerLat"),
                    _epoch_millis(F.col("window.end"), ntz).alias("windowEnd"),
                    "isStart", "count"))


def terminal_dimension(spark: SparkSession, terminals: dict[int, str]) -> DataFrame:
    """The (cell, terminal) lookup as a tiny DataFrame."""
    return spark.createDataFrame(sorted(terminals.items()), "cell int, terminal string")


def terminal_counts(rides: DataFrame, grid: Grid, terminals: DataFrame, size: str = "1 hour") -> DataFrame:
    """P9 -> F6/J7 -> W3/W5: rides per terminal per tumbling hour.

    The dimension is a handful of rows by definition, so it is broadcast; an
    event whose cell is no terminal finds no partner and is dropped (F6).
    Output keeps the window so a second window can chain on it.
    """
    events = rides.select(event_cell(grid, "event").alias("cell"), "eventTime")
    hits = events.join(F.broadcast(terminals), "cell")
    return (hits.groupBy(F.window("eventTime", size).alias("window"), "terminal")
            .agg(F.count(F.lit(1)).alias("count")))


def _ny_hour(start: Column, ntz: bool) -> Column:
    """X15 hour of day in New York of a window start."""
    if ntz:
        return F.hour(F.convert_timezone(F.lit("UTC"), F.lit(NEW_YORK), start))
    return F.hour(F.convert_timezone(F.lit("UTC"), F.lit(NEW_YORK), ntz_from_instant(start)))


def hourly_winner(counts: DataFrame, size: str = "1 hour") -> DataFrame:
    """Per hour the terminal with the most rides.

    Chains a second window on the first one's event time, so in a stream it
    is a windowed aggregate keyed by hour (spread over tasks), not the
    reference's single-task ``windowAll``. Ties go to the lowest terminal
    name (``min`` over (-count, terminal))."""
    ntz = dict(counts.select("window.start").dtypes)["start"] == "timestamp_ntz"
    best = (counts.groupBy(F.window(F.window_time("window"), size).alias("hour_window"))
            .agg(F.min(F.struct((-F.col("count")).alias("neg"), F.col("terminal"))).alias("best")))
    start = F.col("hour_window.start")
    return best.select(F.col("best.terminal").alias("terminal"),
                       (-F.col("best.neg")).alias("count"),
                       _ny_hour(start, ntz).alias("hour"),
                       start.alias("windowStart"))


def terminal_trends(rides: DataFrame, grid: Grid, terminals: DataFrame) -> DataFrame:
    """The airport-trends job: per-terminal hourly counts, then the winner."""
    return hourly_winner(terminal_counts(rides, grid, terminals))
