"""Access-log (Common Log Format) source, S6 / U3 / X7-X11 / X16.

The reference parses each line in a Python function; here the same pattern is
applied with native regex expressions, so lines never leave the JVM and the
parse fuses into the scan's whole-stage-codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# Access-log pattern: anchored at the start only; protocol may be empty.
ACCESS_LOG_PATTERN = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)\s*" (\d{3}) (\S+)'
# dd/MMM/yyyy:HH:mm:ss +zzzz, the log's timestamp layout.
DATETIME_PATTERN = "dd/MMM/yyyy:HH:mm:ss Z"
WALLCLOCK_PATTERN = "dd/MMM/yyyy:HH:mm:ss"

_FIELDS = ("ipAddress", "clientIdentd", "userId", "dateTime", "method", "endpoint", "protocol")


def _group(line: Column, i: int) -> Column:
    return F.regexp_extract(line, ACCESS_LOG_PATTERN, i)


# One regex pass per line: the match is rewritten to its nine groups joined
# by NUL and split once, instead of nine separate matches. A line that itself
# contains NUL (never in a real log) takes the group-by-group path.
_SEP = "\u0000"
_ALL_GROUPS = "(?s)" + ACCESS_LOG_PATTERN + ".*$"
_JOINED = _SEP.join(f"${i}" for i in range(1, 10))


def _groups(line: Column) -> Column:
    fast = F.split(F.regexp_replace(line, _ALL_GROUPS, _JOINED), _SEP, 9)
    slow = F.array(*[_group(line, i) for i in range(1, 10)])
    return F.when(line.contains(_SEP), slow).otherwise(fast)


def local_date(date_time: Column) -> Column:
    """The date in the log's own offset (its wall-clock part)."""
    wall = F.try_to_timestamp(F.substring(date_time, 1, 20), F.lit(WALLCLOCK_PATTERN))
    return F.to_date(wall)


def parse_access_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Keep lines matching the pattern, one typed column per field.

    ``timestamp`` is epoch seconds (double) of the zoned time, ``date`` the
    log-local date text, ``contentSize`` 0 for ``-``. A bad month or a
    non-numeric size gives NULL in that field (the reference raises)."""
    line = F.col(col)
    matched = lines.where(line.rlike(ACCESS_LOG_PATTERN)).select(_groups(line).alias("_g"))
    g = [F.get(F.col("_g"), i) for i in range(9)]
    size_txt = g[8]
    parsed = matched.select(
        *[g[i].alias(name) for i, name in enumerate(_FIELDS)],
        g[7].cast("int").alias("responseCode"),
        F.when(size_txt == "-", F.lit(0).cast("bigint"))
         .otherwise(size_txt.try_cast("bigint")).alias("contentSize"),
    )
    zoned = F.try_to_timestamp(F.col("dateTime"), F.lit(DATETIME_PATTERN))
    ld = local_date(F.col("dateTime"))
    return parsed.select(
        "ipAddress", "clientIdentd", "userId", "dateTime",
        F.unix_seconds(zoned).cast("double").alias("timestamp"),
        F.date_format(ld, "yyyy-MM-dd").alias("date"),
        "method", "endpoint", "protocol", "responseCode", "contentSize",
    )


def with_weekday(logs: DataFrame, out: str = "dayOfWeek") -> DataFrame:
    """Monday = 0 weekday of the log-local date, as a native expression."""
    return logs.withColumn(out, F.weekday(local_date(F.col("dateTime"))))


def read_access_log(spark: SparkSession, path: str) -> DataFrame:
    """S1 + S6: text file of access-log lines -> parsed rows."""
    return parse_access_log(spark.read.text(path))
