"""Deltas out of order, inside and outside the revision window."""

import datetime as dt

from longtide import schema
from longtide.streaming import fold, late

T = dt.datetime
WHERE = ("in", "out", "ck")


def landed(spark, folder, *rows):
    spark.createDataFrame(list(rows), schema.struct(schema.DELTA)).coalesce(1).write.mode("append").parquet(folder)


def test_rows_inside_and_outside_the_window(spark, tmp_path):
    where = [str(tmp_path / x) for x in WHERE]
    t, stamp = T(2020, 1, 1), lambda day: T(2026, 1, 1) + dt.timedelta(days=day)
    batches = [
        [(1, 1, t, 1.0, stamp(40)), (1, 1, t, 0.5, stamp(0)), (2, 1, t, 1.0, stamp(0))],  # nothing is late where nothing was known
        [(1, 1, t, 2.0, stamp(5)), (2, 1, t, 2.0, stamp(5)), (3, 1, t, 2.0, stamp(1))],  # too late for station 1, in time for others
        [(1, 1, t, 3.0, stamp(10)), (1, 2, t, 3.0, stamp(9)), (2, 1, t, 3.0, stamp(2)), (2, 1, t, 3.5, stamp(90))],  # on the border: in time
        [(2, 1, t, 4.0, stamp(59)), (2, 1, t, 4.5, stamp(60)), (1, 1, t, 4.0, stamp(41)), (1, 1, t, 9.0, None)],
    ]
    for rows in batches:
        landed(spark, where[0], *rows)
        merged, beside = late.revision_stream(spark, *where)
    assert sorted((r.station_id, r.variable_id, r.value) for r in merged.collect()) == [(1, 1, 4.0), (2, 1, 3.5), (3, 1, 2.0)]
    assert sorted((r.station_id, r.variable_id, r.value) for r in beside.collect()) == [(1, 1, 2.0), (1, 1, 9.0), (1, 2, 3.0), (2, 1, 4.0)]
    assert {r.station_id: r.newest for r in late.stations_known(spark, where[2]).collect()} == {1: stamp(41), 2: stamp(90), 3: stamp(1)}
    # a run without new files changes nothing
    again = late.revision_stream(spark, *where)
    assert again[0].count() == 3 and again[1].count() == 4


def test_silent_stations_are_forgotten(spark, tmp_path):
    where, ttl = [str(tmp_path / x) for x in WHERE], dt.timedelta(milliseconds=1)
    t = T(2020, 1, 1)
    landed(spark, where[0], (1, 1, t, 1.0, T(2026, 6, 1)))
    late.revision_stream(spark, *where, time_to_live=ttl, clock_slack=dt.timedelta(0))
    landed(spark, where[0], (2, 1, t, 1.0, T(2026, 6, 1)))
    late.revision_stream(spark, *where, time_to_live=ttl, clock_slack=dt.timedelta(0))
    assert [r.station_id for r in late.stations_known(spark, where[2]).collect()] == [2]
    landed(spark, where[0], (1, 1, t, 7.0, T(2026, 1, 1)))
    merged, beside = late.revision_stream(spark, *where, time_to_live=ttl, clock_slack=dt.timedelta(0))
    assert beside.isEmpty() and merged.where("station_id = 1").first().value == 1.0  # in time, but older than what is merged


def test_superseded_generations_go(spark, tmp_path):
    where = [str(tmp_path / x) for x in WHERE]
    for k in range(6):
        year = 2020 + (k == 1)
        landed(spark, where[0], (1, 1, T(year, 1, 1), float(k), T(2026, 1, 1 + k)))
        merged = fold.merge_stream(spark, *where)
    assert sorted(r.value for r in merged.collect()) == [1.0, 5.0]
    folders = sorted(f.split("/out/")[1] for f in fold._matching(spark, f"{where[1]}/generation=*/period=*"))
    assert folders == [f"generation=00000000{g}/period={p}" for g, p in ((1, 2021), (3, 2020), (4, 2020), (5, 2020))]
