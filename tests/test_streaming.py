"""Event-time stream behaviour: late rows (W12), and stream = batch (W11) on
tables of many unordered files and in any session time zone."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tallgrass.functions.geo import Box, Grid, ntz_from_instant, utc_instant
from tallgrass.operators import rides as R
from tallgrass.plans.registry import load_all
from tallgrass.session import delete_path, release, scratch_path
from tallgrass.sources.derived import ride_events
from tallgrass.streaming.bounded import file_stream, run_bounded_stream

SF = "/root/testdata/sf0.01"
BOX = Box.degrees(-74.0, -73.7, 40.5, 41.0)
GRID = Grid.degrees(-74.0, 41.0, 0.1, 0.1, 3)
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def rides(spark, rows):
    return spark.createDataFrame(rows, "rideId bigint, isStart boolean, t string").select(
        "rideId", "isStart", F.lit(-73_950_000).cast("bigint").alias("startLon_u"),
        F.lit(40_950_000).cast("bigint").alias("startLat_u"), F.lit(-73_950_000).cast("bigint").alias("endLon_u"),
        F.lit(40_950_000).cast("bigint").alias("endLat_u"), F.col("t").cast("timestamp").alias("eventTime"))


def test_late_row_dropped_only_when_its_window_closed(spark):
    phases = [rides(spark, x) for x in (
        [(3, True, "2024-01-01 11:00:00")],  # watermark -> 10:59
        [(4, True, "2024-01-01 10:03:00"),   # every window closed: dropped
         (5, True, "2024-01-01 10:58:30")],  # older than the watermark, window open
        [(6, True, "2030-01-01 00:00:00")])]  # sentinel flush
    first = scratch_path(spark, "late")
    rides(spark, [(1, True, "2024-01-01 10:01:00"), (2, True, "2024-01-01 10:02:00")]).write.parquet(first)
    source = file_stream(spark, first, phases[0].schema)
    out = run_bounded_stream(spark, source, lambda s: R.popular_places(
        s.withWatermark("eventTime", "60 seconds"), BOX, GRID, threshold=0), phases, name="late")
    by_end = {}
    for r in out.collect():
        by_end[r.windowEnd] = by_end.get(r.windowEnd, 0) + r["count"]

    def ms(ts):
        return spark.range(1).select(F.unix_millis(F.lit(ts).cast("timestamp"))).first()[0]

    # The window 10:00-10:15 holds rides 1 and 2 only: ride 4 arrived after it closed.
    assert by_end[ms("2024-01-01 10:15:00")] == 2
    # Ride 5 was behind the watermark but its windows were still open: counted.
    assert by_end[ms("2024-01-01 11:00:00")] == 1  # ride 5 alone in 10:45-11:00
    release(out)
    delete_path(spark, first)


@pytest.fixture(scope="module")
def many_files(spark):
    """The two stream tables as folders of unordered part files that overlap in time."""
    folder = scratch_path(spark, "parts")
    for name, n in (("events", 5), ("documents", 4)):
        t = spark.read.parquet(f"{SF}/{name}.parquet")
        t.repartition(n, F.rand(seed=3)).write.parquet(f"{folder}/{name}.parquet")
    yield folder
    delete_path(spark, folder)


@needs_tables
@pytest.mark.parametrize("stream, batch", [("stream_ride_cleaning", "ride_cleaning"), ("stream_popular_places", "popular_places"),
                                           ("stream_terminal_trends", "terminal_trends"),
                                           ("stream_running_wordcount", "wordcount_nonword")])
def test_stream_equals_batch_on_folders_in_any_zone(spark, many_files, stream, batch):
    zone = spark.conf.get("spark.sql.session.timeZone")
    want = sorted(map(repr, map(tuple, load_all()[batch].fn(spark, many_files).collect())))
    assert want
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        out = load_all()[stream].fn(spark, many_files)
        assert sorted(map(repr, map(tuple, out.collect()))) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_instants_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([("2024-11-03 01:30:00.123456",), ("1969-12-31 23:59:59.5",), ("2024-03-10 02:30:00",)],
                                   "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
        assert df.where(ntz_from_instant(utc_instant(F.col("t"))) != F.col("t")).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@needs_tables
def test_replay_advances_and_evicts_state(spark):
    """The table comes in slices of event time: the watermark follows, and what
    is held after a batch is the windows still open then, not all of them."""
    from tallgrass.plans import ride_queries as RQ
    from tallgrass.plans.stream_queries import _replay, _timed_rides
    progress = []
    out = _replay(spark, SF, lambda s: R.popular_places(_timed_rides(s), RQ.BOX, RQ.PLACES_GRID, RQ.THRESHOLD), "state",
                  progress=progress)
    assert out.count() == load_all()["popular_places"].fn(spark, SF).count()
    release(out)
    fed = [p for p in progress if p["rows"]]
    assert len(fed) >= 5 and len({p["batch"] for p in progress}) == len(progress)  # four slices and the sentinel
    rides = ride_events(spark.read.parquet(f"{SF}/events.parquet"))
    every = R.popular_places(rides, RQ.BOX, RQ.PLACES_GRID, 0).count()
    # after the no-data batch that follows each slice only the windows of the last minutes are left
    quiet = [p["state_rows"][0] for p in progress if not p["rows"]]
    assert every > 1000 and len(quiet) >= 4 and max(quiet) < every / 20
    assert sum(n for p in progress for n in p["dropped"]) == 0


def test_slices_are_ranges_of_event_time(spark):
    from tallgrass.streaming.bounded import event_time_slices
    df = spark.range(1000).select(F.col("id"), F.timestamp_seconds(F.col("id") * 7919 % 500).alias("t")).repartition(5)
    folders = event_time_slices(df, "t", slice_rows=130)
    assert len(folders) == 8
    ends, n = [], 0
    for f in folders:
        got = spark.read.parquet(f)
        n += got.count()
        ends.append(got.agg(F.min("t"), F.max("t")).first())
    assert n == 1000 and all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    delete_path(spark, folders[0].rpartition("/")[0])


def test_latest_table(spark):
    """A re-run batch changes nothing; files stay bounded; null is a key."""
    from tallgrass.streaming.upsert import LatestTable
    path = scratch_path(spark, "latest")
    schema = "k string, n long"
    empty = spark.createDataFrame([], schema)
    table = LatestTable(spark, path, empty.schema, ["k"], every=3)
    assert table.read().collect() == []
    want = {}
    for batch in range(8):
        rows = [(k, 10 * batch + i) for i, k in enumerate(["a", None, f"b{batch}"])]
        want |= dict(rows)
        table.upsert(spark.createDataFrame(rows, schema), batch)
        assert {r.k: r.n for r in table.read().collect()} == want
        table.upsert(spark.createDataFrame(rows, schema), batch)
        if batch:
            table.upsert(spark.createDataFrame(rows[:1], schema).where("false"), table.base())  # merged long ago
        assert {r.k: r.n for r in table.read().collect()} == want
        again = LatestTable(spark, path, empty.schema, ["k"], every=3)  # a new run over the same folder
        assert {r.k: r.n for r in again.read().collect()} == want
        assert len(table._numbers("base")) <= 1 and len(table._numbers("delta")) <= 3
    with pytest.raises(ValueError):
        LatestTable(spark, path, empty.schema, [])
    delete_path(spark, path)
