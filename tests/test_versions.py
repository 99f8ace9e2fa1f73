"""Operations on an archive's files that are stopped at every step, versions, and what is rewritten and read."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from longtide import schema
from longtide.operators import compaction as cp
from longtide.operators import layout as lo
from longtide.operators import manifest as mf
from longtide.sources import files, sinks, tables, versions

OBS = "station_id int, variable_id smallint, obs_time timestamp_ntz, value double"
SMALL = {"target": 1 << 10, "floor": 1 << 9, "ceiling": 1 << 20, "bytes_per_row": 16.0}
NOW = "2026-01-01 00:00:00"
T = dt.datetime


def archive(spark, root, periods=(("2000-2001", 2000, 2001), ("2002", 2002, 2002)), stations=12, n=40):
    """About eight files a period, stations in order."""
    layout = spark.createDataFrame(list(periods), "period string, start_year int, end_year int")
    rows = [(s, 1, T(y, 1, 1) + dt.timedelta(hours=h), float(h)) for s in range(1, stations + 1) for _, a, b in periods for y in range(a, b + 1) for h in range(n)]
    sinks.write_observations(lo.with_period(spark.createDataFrame(rows, OBS), layout), f"{root}/observations", **SMALL)
    sinks.write_layout(layout, f"{root}/layout.json")
    return layout


def delta(spark, root, rows, run="r1"):
    sinks.write_delta(spark.createDataFrame(rows, OBS), f"{root}/deltas", run, "2026-01-01 00:00:00")


def rows(spark, root, version=None):
    found = tables.observations(spark, root) if version is None else versions.observations(spark, root, version)
    return sorted(map(tuple, found.collect()))


class Stopped(Exception):
    pass


def stop_at(monkeypatch, owner, name, after=False):
    own = getattr(owner, name)

    def stop(*args, **options):
        if after:
            own(*args, **options)
        raise Stopped(name)

    monkeypatch.setattr(owner, name, stop)


#: Where an operation can stop, and whether before or after; up to the last of these readers see the old rows.
BEFORE = [(sinks, "write_observations", True), (versions.Change, "place", True), (versions, "publish", False)]
BETWEEN = [(versions.Change, "publish", True), (versions, "vacuum", False)]


def test_compaction_stopped(spark, tmp_path):
    """Stopped at one step after the other on one archive, each time with what the others left behind."""
    root, clear_files = str(tmp_path), sinks.clear_files
    layout = archive(spark, root, stations=3, n=10)
    old = rows(spark, root)
    delta(spark, root, [(2, 1, T(2002, 1, 1), 99.0), (7, 1, T(2002, 3, 1), 1.0)])
    changed = {(s, v, t, p): x for s, v, t, x, p in old} | {(2, 1, T(2002, 1, 1), "2002"): 99.0, (7, 1, T(2002, 3, 1), "2002"): 1.0}
    new = sorted((s, v, t, x, p) for (s, v, t, p), x in changed.items())
    for step in BEFORE:
        with pytest.MonkeyPatch.context() as patch, pytest.raises(Stopped):
            stop_at(patch, *step)
            cp.compact_archive(spark, root, layout, **SMALL)
        assert rows(spark, root) == old, step
    for k, step in enumerate([*BETWEEN, (sinks, "clear_files", False)]):
        if k:
            delta(spark, root, [(8, 1, T(2002, 3, 1), float(k))], f"r{k + 1}")
            changed[8, 1, T(2002, 3, 1), "2002"] = float(k)
            new = sorted((s, v, t, x, p) for (s, v, t, p), x in changed.items())
        with pytest.MonkeyPatch.context() as patch, pytest.raises(Stopped):
            stop_at(patch, *step)
            if step[1] == "clear_files":  # the first call clears what the run before has left
                calls = iter([clear_files, sinks.clear_files])
                patch.setattr(sinks, "clear_files", lambda *a: next(calls)(*a))
            cp.compact_archive(spark, root, layout, **SMALL)
        assert rows(spark, root) == new, step
    assert not tables.deltas(spark, root).isEmpty()
    cp.compact_archive(spark, root, layout, **SMALL)
    assert rows(spark, root) == new and tables.deltas(spark, root).isEmpty()
    versions.vacuum(spark, root)
    assert sorted(map(tuple, spark.read.schema(schema.observations()).parquet(f"{root}/observations").collect())) == new
    assert not [f for f in os.listdir(f"{root}/_staged")] and len(os.listdir(f"{root}/_versions/lists")) == 1


def test_repartition_stopped(spark, tmp_path):
    root = str(tmp_path)
    archive(spark, root, [("2000", 2000, 2000), ("2001", 2001, 2001), ("2002", 2002, 2002)], stations=3, n=10)
    to = spark.createDataFrame([("2000-2001", 2000, 2001), ("2002", 2002, 2002)], "period string, start_year int, end_year int")
    old = rows(spark, root)
    new = sorted((*r[:4], "2002" if r[4] == "2002" else "2000-2001") for r in old)
    for step in [*BEFORE[1:], (sinks, "write_layout", False), BETWEEN[1]]:
        with pytest.MonkeyPatch.context() as patch, pytest.raises(Stopped):
            stop_at(patch, *step)
            cp.apply_repartition(spark, root, to, dry_run=False, **SMALL)
        labels = {r.period for r in tables.layout(spark, f"{root}/layout.json").collect()}
        done = step[1] == "vacuum"
        assert rows(spark, root) == (new if done else old) and labels == ({"2000-2001", "2002"} if done else {"2000", "2001", "2002"})
        # a range that goes by the labels finds the same either way
        assert tables.read_range(spark, root, 2000, 2001).count() == sum(r[2].year < 2002 for r in old)
    cp.apply_repartition(spark, root, to, dry_run=False, **SMALL)
    assert rows(spark, root) == new


@pytest.mark.parametrize("step", ["publish", "drop_others"])
def test_state_write_stopped(spark, tmp_path, step):
    root = str(tmp_path)
    state = lambda n: spark.createDataFrame([(5, n), (2, n)], "station_id int, rows_fetched_total long").select(*[F.col(c) if c in ("station_id", "rows_fetched_total") else F.lit(None).cast(k).alias(c) for c, k in (x.split() for x in schema.STATE.split(", "))])
    total = lambda: {r.station_id: r.rows_fetched_total for r in tables.state(spark, root).collect()}
    sinks.write_state(state(1), f"{root}/_state", "a")
    with pytest.MonkeyPatch.context() as patch, pytest.raises(Stopped):
        stop_at(patch, versions, step)
        sinks.write_state(state(2), f"{root}/_state", "a")
    assert total() == ({2: 1, 5: 1} if step == "publish" else {2: 2, 5: 2})
    sinks.write_state(state(3), f"{root}/_state", "a")
    assert total() == {2: 3, 5: 3}
    written = [f for f in os.listdir(f"{root}/_state/writer=a") if f.startswith("g")]
    assert len(written) == 1
    own = spark.read.parquet(f"{root}/_state/writer=a/{written[0]}")
    assert [r.station_id for r in own.collect()] == [2, 5]


def test_one_station_rewrites_one_file(spark, tmp_path):
    root = str(tmp_path)
    layout = archive(spark, root)
    cp.compact_archive(spark, root, layout, ["2002"], **SMALL)  # the first version
    listed = {r.name: (r.first_key.station_id, r.last_key.station_id) for r in versions.listed(spark, root).where("period = '2002'").collect()}
    assert len(listed) >= 7
    holding = [n for n, (a, b) in listed.items() if a <= 5 <= b]
    delta(spark, root, [(5, 1, T(2002, 1, 1) + dt.timedelta(hours=h), 77.0) for h in (3, 4)])
    before, old = {r.name for r in versions.listed(spark, root).collect()}, rows(spark, root)
    cp.compact_archive(spark, root, layout, keep_versions=2, **SMALL)
    after = {r.name for r in versions.listed(spark, root).collect()}
    gone = before - after
    assert gone <= set(holding) and len(gone) <= 2 and len(after - before) <= 2
    assert len(rows(spark, root)) == len(old) and sum(r[3] == 77.0 for r in rows(spark, root)) == 2
    # the version before is still there as it was, until vacuum
    assert rows(spark, root, versions.latest(spark, root) - 1) == old
    assert sorted(versions.vacuum(spark, root)) == sorted(gone)
    # a station beyond all others goes to the last file
    delta(spark, root, [(999, 1, T(2002, 1, 1), 1.0)], "r2")
    before = after
    cp.compact_archive(spark, root, layout, **SMALL)
    assert len(before - {r.name for r in versions.listed(spark, root).collect()}) == 1
    keys = versions.listed(spark, root).where("period = '2002'").select("first_key", "last_key").orderBy("first_key").collect()
    assert all(a.last_key < b.first_key for a, b in zip(keys, keys[1:], strict=False))


def test_files_of_far_apart_stations(spark, tmp_path):
    root = str(tmp_path)
    layout = archive(spark, root, [("2000", 2000, 2000), ("2001", 2001, 2001)], stations=30)
    cp.adopt(spark, root)
    asked = [2, 15, 29]

    def holding():
        rows_of = tables.observations(spark, root).select("station_id", F.regexp_extract(F.col("_metadata.file_path"), "observations/(.+)$", 1).alias("name"))
        return sorted(r.name for r in rows_of.where(F.col("station_id").isin(asked) & F.col("name").startswith("period=2001")).select("name").distinct().collect())

    found = versions.files_of_stations(spark, root, asked, "2001-01-01", "2002-01-01")
    assert found == holding() and 3 <= len(found) <= 6 < versions.listed(spark, root).count() / 3
    read = versions.read_stations(spark, root, asked, "2001-01-01", "2002-01-01")
    assert read.count() == 3 * 40 and len(read.inputFiles()) == len(found)
    # new files have their stations too, ids of any size
    delta(spark, root, [(15, 1, T(2001, 6, 1), 1.0), (2_000_000_000, 1, T(2001, 6, 1), 1.0)])
    cp.compact_archive(spark, root, layout, **SMALL)
    asked += [2_000_000_000]
    assert versions.files_of_stations(spark, root, asked, "2001-01-01", "2002-01-01") == holding()
    assert versions.read_stations(spark, root, [2_000_000_000], "2001-01-01", "2002-01-01").count() == 1
    assert versions.files_of_stations(spark, root, [77]) == []


def test_two_writers(spark, tmp_path):
    """Of two operations on one version the second finds a conflict and changes nothing."""
    root = str(tmp_path)
    layout = archive(spark, root, stations=2, n=5)
    delta(spark, root, [(1, 1, T(2002, 1, 1), 50.0)])
    place = versions.Change.place

    def meanwhile(change):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(versions.Change, "place", place)
            cp.apply_repartition(spark, root, spark.createDataFrame([("2000-2002", 2000, 2002)], "period string, start_year int, end_year int"), dry_run=False, keep_versions=5, **SMALL)
        return place(change)

    with pytest.MonkeyPatch.context() as patch, pytest.raises(versions.Conflict):
        patch.setattr(versions.Change, "place", meanwhile)
        cp.compact_archive(spark, root, layout, **SMALL)
    assert {r[4] for r in rows(spark, root)} == {"2000-2002"} and not any(r[3] == 50.0 for r in rows(spark, root))
    assert tables.deltas(spark, root).count() == 1


def test_files_of_others_are_taken_in(spark, tmp_path):
    root = str(tmp_path)
    layout = archive(spark, root, stations=2, n=5)
    cp.compact_archive(spark, root, layout, ["2002"], **SMALL)
    n = len(rows(spark, root))
    extra = spark.createDataFrame([(9, 1, T(2002, 1, 1), 3.0), (8, 1, T(2002, 1, 1), 3.0)], OBS).withColumn("period", F.lit("2002"))
    extra.coalesce(1).write.mode("append").partitionBy("period").parquet(f"{root}/observations")
    assert len(rows(spark, root)) == n
    cp.compact_archive(spark, root, layout, ["2002"], **SMALL)
    assert len(rows(spark, root)) == n + 2
    assert versions.listed(spark, root).where("period = '2002' and in_order").count() == 1


def test_unsound_files_are_not_published(spark, tmp_path):
    root = str(tmp_path)
    layout = archive(spark, root, stations=2, n=5)
    old = rows(spark, root)
    delta(spark, root, [(1, 1, T(2002, 1, 1), 50.0)])
    write = sinks.write_observations

    def twice(found, path, **options):
        write(found, path, **options)
        bad = spark.createDataFrame([(1, 1, T(2002, 1, 1), 1.0)] * 2, OBS).withColumn("period", F.lit("2002~7"))
        bad.coalesce(1).write.mode("append").partitionBy("period").parquet(path)

    with pytest.MonkeyPatch.context() as patch, pytest.raises(ValueError, match="not published"):
        patch.setattr(sinks, "write_observations", twice)
        cp.compact_archive(spark, root, layout, **SMALL)
    assert rows(spark, root) == old


def test_manifest_reads_changed_files_only(spark, tmp_path):
    """Unchanged files' contents are spoilt, with size and time as they were: nothing reads them."""
    root = str(tmp_path)
    archive(spark, root, stations=12, n=10)
    cp.rebuild_manifest(spark, root, NOW)
    first = {r.path: tuple(r) for r in tables.manifest(spark, root).collect()}
    paths = sorted(first)
    for p in paths:
        local = p.removeprefix("file:")
        stat = os.stat(local)
        with open(local, "r+b") as f:
            f.write(b"\0" * stat.st_size)
        os.utime(local, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    more = spark.createDataFrame([(1, 1, T(2005, 1, 1), 1.0)], OBS).withColumn("period", F.lit("2005"))
    more.coalesce(1).write.mode("append").partitionBy("period").parquet(f"{root}/observations")
    os.remove(paths[0].removeprefix("file:"))
    cp.rebuild_manifest(spark, root, "2026-02-01 00:00:00")
    second = {r.path: tuple(r) for r in tables.manifest(spark, root).collect()}
    assert {p: second[p] for p in paths[1:]} == {p: first[p] for p in paths[1:]} and paths[0] not in second
    assert [r[2] for p, r in second.items() if p not in first] == [1]
    assert [r.path for r in tables.manifest(spark, root).collect()] == sorted(second)
    summary = spark.read.parquet(f"{root}/_summary").first()
    assert summary.files == len(second) and summary.rows == sum(r[2] for r in second.values())
    assert [r.period for r in spark.read.parquet(f"{root}/_summary_by_period").collect()] == ["2000-2001", "2002", "2005"]
    assert mf.summarize(tables.manifest(spark, root)).first() == summary
    # a changed file is read, and found to be spoilt
    with open(paths[1].removeprefix("file:"), "ab") as f:
        f.write(b"\0")
    with pytest.raises(Exception, match="Parquet|footer|magic"):
        cp.rebuild_manifest(spark, root, NOW)
    assert files.list_files(spark, f"{root}/observations").count() == len(second)
