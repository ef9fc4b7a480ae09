"""Batch taxi-ride queries (F5-F7, P9, P10, X15, X18-X22, J7, A13, W3-W7) on
ride events derived from ``events`` (``tallgrass.sources.derived.ride_events``).

The city box, grids and terminal cells are ours: the reference reads them from
a jar that is not available. Window density of the driver tables is low, so
the popular-places threshold is 1 (strict), not the reference's 20.
"""

from __future__ import annotations

from tallgrass.functions.geo import Box, Grid
from tallgrass.operators import rides as R
from tallgrass.plans.registry import query
from tallgrass.sources.derived import ride_events
from tallgrass.sources.tables import table

BOX = Box.degrees(-74.0, -73.7, 40.5, 41.0)
PLACES_GRID = Grid.degrees(-74.0, 41.0, 0.1, 0.1, 3)
TERMINAL_GRID = Grid.degrees(-74.0, 41.0, 0.05, 0.05, 6)
TERMINALS = {8: "TERMINAL_1", 9: "TERMINAL_2", 14: "TERMINAL_3", 21: "TERMINAL_4", 27: "TERMINAL_5",
             33: "TERMINAL_6"}
THRESHOLD = 1

RIDES_SQL = """
WITH rides AS (
  SELECT event_id AS rideId, event_type IN ('view', 'click') AS isStart,
         -74050000 + ((event_id % 400000) * 7919) % 400000 AS slon,
         40450000 + ((event_id % 600000) * 104729) % 600000 AS slat,
         -74050000 + ((event_id % 400000) * 6101) % 400000 AS elon,
         40450000 + ((event_id % 600000) * 15485863) % 600000 AS elat,
         ts AS eventTime
  FROM events),
clean AS (
  SELECT * FROM rides
  WHERE slon BETWEEN -74000000 AND -73700000 AND slat BETWEEN 40500000 AND 41000000
    AND elon BETWEEN -74000000 AND -73700000 AND elat BETWEEN 40500000 AND 41000000)
"""


def _cell_sql(lon, lat, dx, ncols):
    return (f"CAST(floor(({lon} + 74000000) / {dx}) + floor((41000000 - {lat}) / {dx}) * {ncols} AS INTEGER)")


def rides(spark, sf_dir):
    return ride_events(table(spark, sf_dir, "events"))


@query("ride_cleaning", oracle=RIDES_SQL + """
    SELECT rideId, isStart, slon / 1e6 AS startLon, slat / 1e6 AS startLat, elon / 1e6 AS endLon,
           elat / 1e6 AS endLat, eventTime FROM clean""")
def ride_cleaning(spark, sf_dir):
    return R.clean(rides(spark, sf_dir), BOX).select(
        "rideId", "isStart", "startLon", "startLat", "endLon", "endLat", "eventTime")


_SC = _cell_sql("slon", "slat", 100000, 3)
_EC = _cell_sql("elon", "elat", 100000, 3)


@query("grid_cells", oracle=RIDES_SQL + f"""
    SELECT rideId, {_SC} AS startCell, {_EC} AS endCell,
           (2 * -74000000 + (2 * ({_SC} % 3) + 1) * 100000) / 2000000.0 AS startCenterLon,
           (2 * 41000000 - (2 * floor({_SC} / 3) + 1) * 100000) / 2000000.0 AS startCenterLat
    FROM clean""")
def grid_cells(spark, sf_dir):
    return R.with_cells(R.clean(rides(spark, sf_dir), BOX), PLACES_GRID)


@query("popular_places", oracle=RIDES_SQL + f"""
    , win AS (
      SELECT {_SC} AS cell, isStart, time_bucket(INTERVAL 5 MINUTE, eventTime) - k * INTERVAL 5 MINUTE AS wstart
      FROM clean, (VALUES (0), (1), (2)) t(k))
    SELECT (2 * -74000000 + (2 * (cell % 3) + 1) * 100000) / 2000000.0 AS centerLon,
           (2 * 41000000 - (2 * floor(cell / 3) + 1) * 100000) / 2000000.0 AS centerLat,
           epoch_ms(wstart + INTERVAL 15 MINUTE) AS windowEnd, isStart, count(*) AS count
    FROM win GROUP BY cell, isStart, wstart HAVING count(*) > {THRESHOLD}""")
def popular_places(spark, sf_dir):
    return R.popular_places(rides(spark, sf_dir), BOX, PLACES_GRID, THRESHOLD)


_TERMS_SQL = ", ".join(f"({c}, '{n}')" for c, n in sorted(TERMINALS.items()))
TRENDS_SQL = RIDES_SQL + f"""
    , ev AS (
      SELECT CASE WHEN isStart THEN {_cell_sql("slon", "slat", 50000, 6)}
                  ELSE {_cell_sql("elon", "elat", 50000, 6)} END AS cell, eventTime FROM rides),
    cnt AS (
      SELECT terminal, time_bucket(INTERVAL 1 HOUR, eventTime) AS ws, count(*) AS n
      FROM ev JOIN (VALUES {_TERMS_SQL}) t(cell, terminal) USING (cell) GROUP BY 1, 2),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY ws ORDER BY n DESC, terminal ASC) AS rn FROM cnt)
"""


@query("terminal_trends", oracle=TRENDS_SQL + """
    SELECT terminal, n AS count,
           CAST(hour(timezone('America/New_York', ws AT TIME ZONE 'UTC')) AS INTEGER) AS hour,
           ws AS windowStart
    FROM ranked WHERE rn = 1""")
def terminal_trends(spark, sf_dir):
    dim = R.terminal_dimension(spark, TERMINALS)
    return R.terminal_trends(rides(spark, sf_dir), TERMINAL_GRID, dim)


@query("terminal_counts", oracle=TRENDS_SQL + """
    SELECT terminal, n AS count, ws AS windowStart FROM cnt""")
def terminal_counts(spark, sf_dir):
    dim = R.terminal_dimension(spark, TERMINALS)
    c = R.terminal_counts(rides(spark, sf_dir), TERMINAL_GRID, dim)
    return c.select("terminal", "count", c["window.start"].alias("windowStart"))
