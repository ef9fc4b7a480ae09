"""Access-log queries (S6, A6, A7, A9-A11, T1, T4, T9, F4, J2, U1-U3) on log
lines derived from ``events`` (see ``tallgrass.sources.derived.clf_lines``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.functions.udfs import weekday_pudf
from tallgrass.operators import weblog as W
from tallgrass.plans.registry import query
from tallgrass.sources.derived import clf_lines
from tallgrass.sources.tables import table
from tallgrass.sources.weblog import parse_access_log

# The oracle rebuilds the parsed record from the original event columns.
LOGS_SQL = """
WITH logs AS (
  SELECT 'u' || user_id || '.example.net' AS ipAddress, '-' AS clientIdentd, '-' AS userId,
         strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400' AS dateTime,
         CAST(epoch(date_trunc('second', ts)) + 14400 AS DOUBLE) AS timestamp,
         strftime(ts, '%Y-%m-%d') AS date,
         'GET' AS method, '/' || event_type AS endpoint,
         CASE WHEN event_type = 'purchase' AND value >= 400 THEN '' ELSE 'HTTP/1.0' END AS protocol,
         CASE WHEN event_type = 'error' AND value < 25 THEN 403 WHEN event_type = 'error' THEN 500
              WHEN event_type = 'signup' THEN 302 ELSE 200 END AS responseCode,
         CASE WHEN value < 2 THEN 0 ELSE CAST(round(value * 100) AS BIGINT) END AS contentSize,
         CAST(isodow(ts) - 1 AS INTEGER) AS dayOfWeek
  FROM events WHERE NOT (value >= 10 AND value < 10.5))
"""


def logs(spark, sf_dir):
    return parse_access_log(clf_lines(table(spark, sf_dir, "events")))


@query("clf_parse", oracle=LOGS_SQL + """
    SELECT ipAddress, clientIdentd, userId, dateTime, timestamp, date, method, endpoint, protocol,
           responseCode, contentSize FROM logs""")
def clf_parse(spark, sf_dir):
    return logs(spark, sf_dir)


@query("distinct_clients", oracle=LOGS_SQL + "SELECT count(DISTINCT ipAddress) AS n_clients FROM logs")
def distinct_clients(spark, sf_dir):
    return W.distinct_clients(logs(spark, sf_dir))


@query("content_stats", oracle=LOGS_SQL + """
    SELECT min(contentSize) AS min_size, avg(contentSize) AS avg_size, max(contentSize) AS max_size FROM logs""")
def content_stats(spark, sf_dir):
    return W.content_stats(logs(spark, sf_dir))


@query("code_counts", oracle=LOGS_SQL + "SELECT responseCode, count(*) AS count FROM logs GROUP BY responseCode")
def code_counts(spark, sf_dir):
    return W.code_counts(logs(spark, sf_dir))


@query("code_percentage", oracle=LOGS_SQL + """
    SELECT responseCode, count, floor((count * 20000 + total) / (total * 2)) / 100.0 AS percentage
    FROM (SELECT responseCode, count(*) AS count FROM logs GROUP BY responseCode),
         (SELECT count(*) AS total FROM logs)""")
def code_percentage(spark, sf_dir):
    return W.code_percentage(logs(spark, sf_dir))


@query("gold_customers", oracle=LOGS_SQL + """
    SELECT ipAddress, count(*) AS count FROM logs GROUP BY ipAddress
    ORDER BY count DESC, ipAddress ASC LIMIT 10""")
def gold_customers(spark, sf_dir):
    return W.gold_customers(logs(spark, sf_dir), 10)


@query("sql_forbidden", oracle=LOGS_SQL + "SELECT dateTime, endpoint FROM logs WHERE responseCode = 403")
def sql_forbidden(spark, sf_dir):
    return W.forbidden_sql(logs(spark, sf_dir), "AccessLog")


@query("day_counts", oracle=LOGS_SQL + "SELECT dayOfWeek, count(*) AS count FROM logs GROUP BY dayOfWeek")
def day_counts(spark, sf_dir):
    return W.day_counts(logs(spark, sf_dir))


@query("weekday_udf", oracle=LOGS_SQL + "SELECT dayOfWeek, count(*) AS count FROM logs GROUP BY dayOfWeek")
def weekday_udf(spark, sf_dir):
    """The weekday computed by a vectorized (Arrow) pandas UDF."""
    return (logs(spark, sf_dir).withColumn("dayOfWeek", weekday_pudf(F.col("dateTime")))
            .groupBy("dayOfWeek").agg(F.count(F.lit(1)).alias("count")).orderBy("dayOfWeek"))


@query("ip_day_counts", oracle=LOGS_SQL + """
    SELECT ipAddress, dayOfWeek, count(*) AS count FROM logs GROUP BY ipAddress, dayOfWeek""")
def ip_day_counts(spark, sf_dir):
    return W.ip_day_counts(logs(spark, sf_dir))


@query("gold_access", oracle=LOGS_SQL + """
    SELECT l.ipAddress, l.dayOfWeek, count(*) AS count
    FROM logs l JOIN (SELECT ipAddress FROM logs GROUP BY ipAddress
                      ORDER BY count(*) DESC, ipAddress ASC LIMIT 10) g ON l.ipAddress = g.ipAddress
    GROUP BY l.ipAddress, l.dayOfWeek""")
def gold_access(spark, sf_dir):
    return W.gold_access(logs(spark, sf_dir), 10)


# Four standard errors of 2 ** 12 registers.
SKETCH_ERROR = 0.06


@query("distinct_clients_sketch", oracle=LOGS_SQL + """
    SELECT count(DISTINCT date) AS n_days, count(DISTINCT ipAddress) AS n_clients, true AS within
    FROM logs""")
def distinct_clients_sketch(spark, sf_dir):
    """A sketch per day, merged; ``within`` tells that the estimate is no
    further than SKETCH_ERROR from the exact count beside it."""
    rows = logs(spark, sf_dir).withColumn("day", F.substring("dateTime", 1, 11))
    days = W.client_sketches(rows, "day")
    both = days.agg(F.count(F.lit(1)).alias("n_days"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    exact = W.distinct_clients(logs(spark, sf_dir)).scalar()
    return both.select("n_days", exact.alias("n_clients"),
                       (F.abs(F.col("estimate") - exact) <= exact * SKETCH_ERROR).alias("within"))
