import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from longtide.operators import analytics as an
from longtide.operators import compaction as cp
from longtide.operators import layout as lo
from longtide.operators import manifest as mf
from longtide.operators import merge as mg
from longtide.operators import metadata as md
from longtide.operators import planning as pl
from longtide.operators import repartition as rp
from longtide.operators import state as st
from longtide.sources import files, payloads, sinks, tables
from longtide.streaming import fold

T = dt.datetime


def _plan(spark, sizes, floor, cuts=None):
    cut = spark.createDataFrame([(y,) for y in cuts], "year int") if cuts is not None else None
    out = lo.plan_periods(spark.createDataFrame(list(sizes.items()), "year int, bytes double"), floor, cut_after=cut)
    return [(r.period, r.start_year, r.end_year, r.bytes) for r in out.orderBy("start_year").collect()]


def _by_hand(sizes, floor, cuts=None):
    out, start, size = [], None, 0.0
    for year in sorted(sizes):
        start = year if start is None else start
        size += sizes[year]
        if size >= floor and (cuts is None or year in cuts):
            out.append([start, year, size])
            start, size = year + 1, 0.0
        last = year
    if start is not None and start <= last:
        if out:
            out[-1][1], out[-1][2] = last, out[-1][2] + size
        else:
            out.append([start, last, size])
    return [(str(a) if a == b else f"{a}-{b}", a, b, s) for a, b, s in out]


def test_plan_periods(spark):
    rng = random.Random(5)
    for _ in range(6):
        sizes = {y: float(rng.randrange(1, 50)) for y in rng.sample(range(1900, 1960), 25)}
        cuts = None if rng.random() < 0.5 else set(rng.sample(range(1900, 1960), 20))
        assert _plan(spark, sizes, 90.0, cuts) == _by_hand(sizes, 90.0, cuts)
    assert _plan(spark, {2000: 1.0, 2001: 1.0}, 100.0) == [("2000-2001", 2000, 2001, 2.0)]
    assert _plan(spark, {}, 1.0) == []


def test_many_plans_at_once(spark):
    rows = [(g, y, float(y % 7 + 1)) for g in ("a", "b") for y in range(1990, 2000)]
    out = lo.plan_periods(spark.createDataFrame(rows, "g string, year int, bytes double"), 9.0, by=["g"])
    assert out.where("g = 'a'").drop("g").collect() == out.where("g = 'b'").drop("g").collect()


def test_unplanned_year_is_its_own_label(spark):
    layout = spark.createDataFrame([("1990-1994", 1990, 1994)], "period string, start_year int, end_year int")
    rows = spark.createDataFrame([(T(1992, 1, 1),), (T(1999, 1, 1),)], "obs_time timestamp_ntz")
    assert [r.period for r in lo.with_period(rows, layout).orderBy("obs_time").collect()] == ["1990-1994", "1999"]
    assert [r.period for r in lo.periods_for_range(layout, 1993, 1996).collect()] == ["1990-1994", "1995", "1996"]
    assert lo.planned_periods(layout, 1995, 1999).isEmpty()


def test_nesting_and_refusal(spark):
    layout = spark.createDataFrame([("1872-1998", 1872, 1998), ("1999-2002", 1999, 2002)], "period string, start_year int, end_year int")
    spans = spark.createDataFrame([("a", 1872, 1997), ("b", 1872, 2000), ("c", 2001, 2009)], "written string, lo int, hi int")
    assert {r.written: r.verdict for r in lo.nesting(spans, layout).collect()} == {"a": "ok", "b": "straddles", "c": "outside_plan"}
    manifest = spark.createDataFrame([("1872-2000", 5, T(1872, 1, 1), T(2000, 1, 1))], "period string, rows long, obs_time_min timestamp_ntz, obs_time_max timestamp_ntz")
    with pytest.raises(ValueError, match="straddles"):
        rp.repartitioned(spark.createDataFrame([], "station_id int, variable_id smallint, obs_time timestamp_ntz, value double"), manifest, layout)


def test_merge_against_a_fold(spark):
    rng = random.Random(7)
    key = lambda: (rng.randrange(3), rng.randrange(2), T(2020, 1, rng.randrange(1, 4)))
    base = [(*key(), float(rng.randrange(9))) for _ in range(20)]
    new = [(*key(), float(rng.randrange(9)), T(2021, 1, 1, 0, 0, rng.randrange(3))) for _ in range(30)]
    want = {}
    for *k, v, at in sorted([(*b, T(1970, 1, 1)) for b in base] + new, key=lambda r: (r[4], r[3])):
        want[tuple(k)] = v
    ddl = "station_id int, variable_id smallint, obs_time timestamp_ntz, value double"
    got = mg.merged(spark.createDataFrame(base, ddl), spark.createDataFrame(new, ddl + ", ingested_at timestamp_ntz"))
    assert {tuple(r)[:3]: r.value for r in got.collect()} == want


def test_duplicates_and_order(spark):
    at = [T(2020, 1, d) for d in (1, 2, 3)]
    rows = [("p", 1, 1, at[0], 0), ("p", 1, 1, at[0], 1), ("p", 1, 1, at[0], 2), ("p", 2, 1, at[0], 3), ("p", 1, 1, at[1], 4), ("q", 1, 1, at[2], 0)]
    df = spark.createDataFrame(rows, "period string, station_id int, variable_id int, obs_time timestamp_ntz, i int")
    assert [tuple(r) for r in mg.duplicate_keys(df, ["period"]).collect()] == [("p", 2)]
    assert [tuple(r) for r in mg.sort_violations(df, ["period"], "i").collect()] == [("p", 1)]


def test_state(spark):
    ddl = "station_id int, watermark timestamp_ntz, last_attempt_at timestamp_ntz, consecutive_failures int"
    rows = [(1, T(2020, 1, 2), T(2020, 2, 1), 0), (1, T(2020, 1, 1), T(2020, 3, 1), 5), (2, None, T(2020, 1, 1), 1), (2, None, T(2020, 1, 2), 2), (3, T(2020, 1, 1), T(2020, 1, 2), 7), (3, T(2020, 1, 1), T(2020, 1, 3), 8)]
    merged = {r.station_id: r for r in st.merge_marks(spark.createDataFrame(rows, ddl)).collect()}
    assert merged[1].consecutive_failures == 0 and merged[2].consecutive_failures == 2 and merged[3].consecutive_failures == 8
    state = spark.createDataFrame([(1, T(2020, 1, 5), None, None, 10, 9, "old")], "station_id int, watermark timestamp_ntz, last_attempt_at timestamp_ntz, last_success_at timestamp_ntz, rows_fetched_total long, consecutive_failures int, last_error string")
    attempts = "station_id int, at timestamp_ntz, status string, max_time timestamp_ntz, rows long, error string"
    failed = st.fold_attempts(state, spark.createDataFrame([(1, T(2020, 2, 1), "error", None, 3, "x" * 900)], attempts)).first()
    assert failed.consecutive_failures == 10 and failed.watermark == T(2020, 1, 5) and len(failed.last_error) == 500 and failed.rows_fetched_total == 10
    older = st.fold_attempts(state, spark.createDataFrame([(1, T(2020, 2, 1), "ok", T(2019, 1, 1), 3, None)], attempts)).first()
    assert older.consecutive_failures == 0 and older.watermark == T(2020, 1, 5) and older.rows_fetched_total == 13 and older.last_error is None
    assert st.quarantined(spark.createDataFrame([(1, 10), (2, 9)], "station_id int, consecutive_failures int")).where("quarantined").count() == 1


def _payloads(spark, contents):
    rows = [(f"n/{i}.csv", "n", str(i), c) for i, c in enumerate(contents)]
    return payloads.triage(spark.createDataFrame(rows, "path string, network_name string, native_id string, content string"))


def test_payloads(spark):
    good = "station_observations\ntemp, time , wind\n1.5, 2020-01-01 00:00:00, None\n None, 2020-01-01 01:00:00,-9999.00\n\n"
    triaged = _payloads(spark, [good, "", None, "station_observations\ntime\n", "Error {x}", "station_observations\na, b\n1, 2\n", "station_observations\ntime, a\n2020-01-01 00:00:00, 1, 2\nnever, 1\n2020-01-01 00:00:00, x\n"])
    assert [r.status for r in triaged.orderBy("path").collect()] == ["ok", "empty", "empty", "empty", "error", "error", "ok"]
    cells, rejects = payloads.long_cells(triaged)
    assert sorted((r.name, r.value) for r in cells.where("value is not null").collect()) == [("temp", 1.5), ("wind", -9999.0)]
    assert sorted(r.reason for r in rejects.collect()) == ["cells do not match the header", "no number in a", "no time"]
    variables = spark.createDataFrame([(7, 1, "temp"), (8, 1, "temp")], "variable_id int, network_id int, name string")
    networks = spark.createDataFrame([(1, "n")], "network_id int, network_name string")
    stations = spark.createDataFrame([(5, "n", "0")], "station_id int, network_name string, native_id string")
    assert [tuple(r) for r in payloads.observations_of(cells, stations, variables, networks).collect()] == [(5, 8, T(2020, 1, 1), 1.5)]
    assert {r.name for r in payloads.unmapped_columns(cells, variables, networks).collect()} == {"wind", "a"}


def test_payload_files(spark, tmp_path):
    (tmp_path / "EC").mkdir()
    (tmp_path / "EC" / "N1.csv").write_text("station_observations\ntime, a\n2020-01-01 00:00:00, 1\n")
    row = payloads.read_payloads(spark, str(tmp_path)).first()
    assert (row.network_name, row.native_id) == ("EC", "N1")


def test_metadata(spark):
    ddl = payloads.DOCUMENTS["stations"]
    h = lambda i, lo, hi, ids: (i, f"name{i}", 1.0 * i, 2.0, None, "BC", "CA", "daily", None, None, None, lo, hi, ids)
    rows = [(1, "A", "http://x/networks/3/", [h(10, "2000-01-01T00:00:00Z", "2001-01-01T00:00:00Z", [2, 1]), h(11, None, "2002-01-01T00:00:00-08:00", [3, 2])]), (2, "B", "http://x/networks/9", [])]
    raw = spark.createDataFrame(rows, ddl)
    nets = md.networks(spark.createDataFrame([(3, "EC", None, None, True, 1)], payloads.DOCUMENTS["networks"]))
    found = {r.station_id: r for r in md.station_rollup(raw, nets).collect()}
    assert found[1].station_name == "name11" and found[1].variable_ids == [1, 2, 3] and found[1].min_obs_time == T(2000, 1, 1) and found[1].max_obs_time == T(2002, 1, 1)
    assert found[2].history_count == 0 and found[2].network_name is None and found[2].station_name is None
    flat = spark.createDataFrame([h(10, None, None, None), h(99, None, None, None)], payloads.DOCUMENTS["histories"])
    assert [(r.history_id, r.station_id, r.network_name) for r in md.attach_histories(flat, raw, nets).collect()] == [(10, 1, "EC")]


def test_planning(spark):
    ddl = "freq string, variable_ids array<int>, min_obs_time timestamp_ntz, max_obs_time timestamp_ntz"
    now = T(2026, 1, 1)
    rows = [("1-hourly", list(range(10)), T(2020, 1, 1), now - dt.timedelta(days=1)), ("daily", [1] * 5, T(2020, 1, 1), now - dt.timedelta(days=2)), ("1-hourly", [1] * 10, T(2020, 1, 1), now - dt.timedelta(days=400))]
    rate = pl.arrival_rate(spark.createDataFrame(rows, ddl), now, 90).first()
    assert (rate.active_histories, rate.obs_per_day) == (2, 245.0)
    rates = spark.createDataFrame([(0.0, 1.0), (1e9, 7.0)], "obs_per_day double, freshness_hours double")
    tiers = [(r.days_to_floor, r.append_every, r.compact_every) for r in pl.cadence(rates).collect()]
    assert tiers[0] == (float("inf"), "hourly", "quarterly") and tiers[1][1:] == ("daily", "weekly")


def _archive(spark, root, rows, **options):
    sinks.write_observations(spark.createDataFrame(rows, "station_id int, variable_id smallint, obs_time timestamp_ntz, value double, period string"), f"{root}/observations", **options)


def test_archive_and_gate(spark, tmp_path):
    root = str(tmp_path)
    rows = [(s, 1, T(y, 1, 1) + dt.timedelta(hours=h), float(h), "2000-2001" if y < 2002 else "2002") for s in range(20) for y in (2000, 2001, 2002) for h in range(40)]
    random.Random(1).shuffle(rows)
    _archive(spark, root, rows, bytes_per_row=4.0, target=2000, floor=1000, ceiling=9000)
    listed = files.list_files(spark, f"{root}/observations")
    assert {r.period: r.n for r in listed.groupBy("period").agg(F.count("*").alias("n")).collect()} == {"2000-2001": 3, "2002": 1}
    footers = files.footers(spark, f"{root}/observations")
    manifest = mf.build_manifest(footers, T(2026, 1, 1))
    assert manifest.agg(F.sum("rows")).first()[0] == len(rows)
    obs = tables.observations(spark, root)
    assert obs.schema["period"].dataType.simpleString() == "string" and mf.verify(footers, manifest, obs, floor=1).isEmpty()
    assert {r.check for r in mf.verify(footers, manifest, obs.unionByName(obs.limit(1)), floor=1 << 40, most_rows=5).collect()} == {"under_floor", "row_group", "duplicate_keys"}
    layout = spark.createDataFrame([("2000-2001", 2000, 2001), ("2002", 2002, 2002)], "period string, start_year int, end_year int")
    sinks.write_layout(layout, f"{root}/layout.json")
    assert tables.layout(spark, f"{root}/layout.json").orderBy("period").collect() == layout.orderBy("period").collect()
    ranged = tables.read_range(spark, root, 2002, 2002)
    assert ranged.count() == 800
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2002" in plan
    # a delta replaces its period alone
    delta = spark.createDataFrame([(0, 1, T(2002, 1, 1), 99.0, T(2026, 1, 1))], "station_id int, variable_id smallint, obs_time timestamp_ntz, value double, ingested_at timestamp_ntz")
    new = mg.compact(obs, delta, layout)
    before = {r.path for r in listed.where("period = '2000-2001'").collect()}
    new.write.parquet(f"{root}/staging")
    sinks.write_observations(spark.read.parquet(f"{root}/staging"), f"{root}/observations", mode="replace_periods")
    after = files.list_files(spark, f"{root}/observations")
    assert {r.path for r in after.where("period = '2000-2001'").collect()} == before
    assert tables.observations(spark, root).where("value = 99").count() == 1 and tables.observations(spark, root).count() == len(rows)


def test_planted_defects(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(2000).select((F.lit(2000) - F.col("id")).cast("int").alias("station_id"), F.lit(1).alias("v")).coalesce(1).write.option("parquet.block.row.count.limit", "500").parquet(a)
    spark.range(10).select(F.col("id").alias("renamed")).coalesce(1).write.parquet(b)
    footers = files.footers(spark, a).unionByName(files.footers(spark, b))
    assert mf.unsorted_files(footers).count() == 1 and mf.schema_signatures(footers).count() == 2 and mf.large_row_groups(footers, 499).count() == 4


def test_sinks(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.files_per_period(spark.createDataFrame([("p", 1)], "period string, rows long"), 1.0, target=10, floor=5, ceiling=12)
    rows = spark.createDataFrame([(1, 1, T(2020, 1, 1), 1.0)], "station_id int, variable_id smallint, obs_time timestamp_ntz, value double")
    path = str(tmp_path / "deltas")
    sinks.write_delta(rows, path, "r1", "2026-01-01 00:00:00.5")
    captured = sinks.delta_files(spark.read.parquet(path))
    sinks.write_delta(rows, path, "r2", "2026-01-02 00:00:00")
    sinks.clear_files(spark, captured)
    left = spark.read.parquet(path).collect()
    assert [r.run_id for r in left] == ["r2"] and left[0].ingested_at == T(2026, 1, 2)
    points = spark.createDataFrame([(1, None, None), (2, -117.3, 49.5)], "station_id int, lon double, lat double")
    sinks.write_spatial(points, str(tmp_path / "stations"))
    assert tables.dimension(spark, str(tmp_path), "stations").columns == ["station_id", "lon", "lat"]
    assert [r.station_id for r in sinks.spatial(points).collect()] == [2, 1]


def test_full_plan(spark):
    ddl = "freq string, variable_ids array<int>, min_obs_time timestamp_ntz, max_obs_time timestamp_ntz"
    history = spark.createDataFrame([("1-hourly", list(range(10_000)), T(1900, 1, 1), T(1930, 1, 1))], ddl)
    measured = spark.createDataFrame([(y, 200_000) for y in range(1900, 1910)], "year int, rows long")
    plan = pl.full_plan(history, measured, 1900, 1930, 100 << 20, 1.06).orderBy("start_year").collect()
    assert plan[0].start_year == 1900 and plan[-1].end_year == 1930 and all(a.end_year + 1 == b.start_year for a, b in zip(plan, plan[1:], strict=False))
    assert plan[0].end_year >= 1910  # ten small years are one bucket with the first large one
    ends = spark.createDataFrame([(1915,)], "year int")
    held = pl.full_plan(history, measured, 1900, 1930, 100 << 20, 1.06, written_ends=ends)
    assert held.agg(F.min("end_year")).first()[0] == 1915
    assert pl.full_plan(history.limit(0), measured.limit(0), 1900, 1902, 1.0).count() == 3


DELTA = "station_id int, variable_id smallint, obs_time timestamp_ntz, value double, ingested_at timestamp_ntz"


def test_merge_stream_folds_late_deltas_and_idles(spark, tmp_path):
    one = spark.createDataFrame([(1, 1, T(2020, 1, 1), 1.0, T(2026, 1, 2)), (5, 1, T(2021, 1, 1), 5.0, T(2026, 1, 2))], DELTA)
    late = spark.createDataFrame([(1, 1, T(2020, 1, 1), 2.0, T(2026, 1, 1)), (2, 1, T(2020, 1, 1), 3.0, T(2026, 1, 1))], DELTA)
    where = [str(tmp_path / x) for x in ("in", "out", "ck")]
    rows = lambda df: sorted((r.station_id, r.value) for r in df.collect())
    one.write.mode("append").parquet(where[0])
    assert rows(fold.merge_stream(spark, *where)) == [(1, 1.0), (5, 5.0)]
    late.write.mode("append").parquet(where[0])
    merged = fold.merge_stream(spark, *where)
    assert rows(merged) == [(1, 1.0), (2, 3.0), (5, 5.0)]
    # the second batch has written the one period it touched
    assert {f.rsplit("/", 1)[0].split("/out/")[1] for f in merged.inputFiles()} == {"generation=000000000/period=2021", "generation=000000001/period=2020"}
    assert rows(fold.merge_stream(spark, *where)) == [(1, 1.0), (2, 3.0), (5, 5.0)]
    # a batch that was not finished is not read
    spark.createDataFrame([(9, 9.0)], "station_id int, value double").write.parquet(f"{where[1]}/generation=000000007/period=2020")
    assert rows(fold.merged_rows(spark, where[1])) == [(1, 1.0), (2, 3.0), (5, 5.0)]


def test_state_stream_takes_attempts_in_any_order(spark, tmp_path):
    where = [str(tmp_path / x) for x in ("in", "out", "ck")]
    files_ = [[(1, T(2020, 3, 1), "ok", T(2020, 3, 1), 5, None)], [(1, T(2020, 2, 1), "error", None, 0, "late"), (2, T(2020, 1, 1), "error", None, 0, "x")], [(1, T(2020, 4, 1), "error", None, 0, "new")]]
    for rows in files_:
        spark.createDataFrame(rows, fold.ATTEMPTS).coalesce(1).write.mode("append").parquet(where[0])
        state = fold.run_state_stream(spark, *where)
    got = {r.station_id: r for r in state.collect()}
    assert (got[1].consecutive_failures, got[1].last_error, got[1].rows_fetched_total) == (1, "new", 5) and got[2].consecutive_failures == 1
    assert {r.station_id for r in fold.run_state_stream(spark, *where).collect()} == {1, 2}


def test_late_attempts(spark):
    attempts = "station_id long, at timestamp_ntz, status string, max_time timestamp_ntz, rows long, error string"
    fold_ = lambda state, *rows: st.fold_attempts(state, spark.createDataFrame([(1, *r) for r in rows], attempts))
    state = fold_(spark.createDataFrame([], fold.STATE), (T(2020, 3, 1), "ok", T(2020, 3, 1), 5, None))
    late = fold_(state, (T(2020, 2, 1), "error", None, 0, "late")).first()
    assert late.consecutive_failures == 0 and late.last_error is None and late.last_attempt_at == T(2020, 3, 1)
    failed = fold_(state, (T(2020, 4, 1), "error", None, 0, "a"), (T(2020, 5, 1), "error", None, 0, "b"))
    # a success that comes in late does not clear the failures after it, but moves mark and rows
    late = fold_(failed, (T(2020, 3, 15), "ok", T(2020, 3, 10), 7, None)).first()
    assert (late.consecutive_failures, late.last_error, late.rows_fetched_total, late.watermark, late.last_success_at) == (2, "b", 12, T(2020, 3, 10), T(2020, 3, 15))
    cleared = fold_(failed, (T(2020, 6, 1), "ok", None, 1, None)).first()
    assert cleared.consecutive_failures == 0 and cleared.last_error is None and cleared.watermark == T(2020, 3, 1)


OBS = "station_id int, variable_id smallint, obs_time timestamp_ntz, value double, period string"


def _random_rows(spark, n, hot=0.0, seed=0):
    """n rows of 400 stations and 90 variables in one period; a share of them of one series."""
    u = lambda k: F.rand(seed + k)
    is_hot = u(0) < hot
    time = (F.lit("2000-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (u(3) * 1e8).cast("int"))).alias("obs_time")
    return spark.range(n).select(F.when(is_hot, 7).otherwise((u(1) * 400).cast("int")).alias("station_id"), F.when(is_hot, 3).otherwise((u(2) * 90).cast("int")).cast("smallint").alias("variable_id"), time, F.round(F.randn(seed + 4) * 50, 1).alias("value"), F.lit("p").alias("period"))


@pytest.mark.parametrize(("n", "hot"), [(20_000, 0.0), (60_000, 0.0), (70_000, 0.4), (130_000, 0.0), (400_000, 0.7)])
def test_every_file_is_in_the_size_band(spark, tmp_path, n, hot):
    """400 KiB wanted, at least 200 KiB and at most 4 MiB, a hot series included."""
    root = str(tmp_path / "observations")
    _random_rows(spark, n, hot).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    sinks.write_observations(rows.limit(20_000), str(tmp_path / "sample"))
    rate = files.list_files(spark, str(tmp_path / "sample")).agg(F.sum("file_bytes")).first()[0] / 20_000
    sinks.write_observations(rows, root, bytes_per_row=rate, target=400 << 10, floor=200 << 10, ceiling=4 << 20)
    sizes = [r.file_bytes for r in files.list_files(spark, root).collect()]
    assert sum(sizes) < 200 << 10 or all(200 << 10 <= x <= 4 << 20 for x in sizes), sizes
    assert len(sizes) >= n * rate // (400 << 10) and spark.read.parquet(root).count() == n
    found = mf.build_manifest(files.footers(spark, root), T(2026, 1, 1)).orderBy("station_id_min", "station_id_max").collect()
    assert all(a.station_id_max <= b.station_id_min for a, b in zip(found, found[1:], strict=False))  # files are in key order
    assert mg.sort_violations(spark.read.parquet(root).select("*", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")), ["f"], "i").isEmpty()


def test_stations_have_a_bloom_filter(spark, tmp_path):
    import duckdb

    sinks.write_observations(_random_rows(spark, 5000), str(tmp_path / "o"))
    found = duckdb.execute(f"SELECT path_in_schema, bloom_filter_length FROM parquet_metadata('{tmp_path}/o/*/*.parquet')").fetchall()
    assert {c for c, n in found if n} == {"station_id"}


class _Counted:
    """A file that counts what is read of it."""

    def __init__(self, path):
        self._file, self.read_bytes, self.closed = open(path, "rb"), 0, False

    def read(self, n=-1):
        data = self._file.read(n)
        self.read_bytes += len(data)
        return data

    def __getattr__(self, name):
        return getattr(self._file, name)


def test_footers_read_the_tail_only(spark, tmp_path):
    spark.range(2_000_000).select("id", F.rand(1).alias("x")).coalesce(1).write.parquet(str(tmp_path / "f"))
    (path,) = (tmp_path / "f").glob("*.parquet")
    file = _Counted(path)
    assert len(files.footer_rows("p", 0, file)) == 2 * files.footers(spark, str(tmp_path / "f")).select("row_group").distinct().count()
    assert path.stat().st_size > 10 << 20 and file.read_bytes <= 128 << 10


def test_checksums(spark, tmp_path):
    import hashlib

    (tmp_path / "c").mkdir()
    data = b"x" * (9 << 20) + b"y"
    (tmp_path / "c" / "a.bin").write_bytes(data)
    assert files.checksums(spark, str(tmp_path / "c")).first().multihash == "1220" + hashlib.sha256(data).hexdigest()


def _files_read(df):
    """numFiles of the scans of the executed plan, after the query has run."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numFiles").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return found


def test_files_read_by_pruning(spark, tmp_path):
    """Four periods of one file each: one is read for years inside a period, two for years over two, four for times alone."""
    root = str(tmp_path)
    spans = [(1872, 1903), (1904, 1935), (2024, 2024), (2025, 2025)]
    layout = spark.createDataFrame([(f"{a}-{b}" if a != b else str(a), a, b) for a, b in spans], "period string, start_year int, end_year int")
    rows = [(s, 1, T(y, 1, 1) + dt.timedelta(minutes=43 * k), 1.0) for a, b in spans for y in range(a, b + 1) for s in (1, 2) for k in range(20)]
    obs = lo.with_period(spark.createDataFrame(rows, OBS.rsplit(",", 1)[0]), layout)
    sinks.write_observations(obs, f"{root}/observations")
    sinks.write_layout(layout, f"{root}/layout.json")
    read = tables.layout(spark, f"{root}/layout.json")

    def asked(a, b, periods):
        found = an.between(tables.observations(spark, root), f"{a}-01-01", f"{b + 1}-01-01")
        if periods:
            found = an.in_periods(found, lo.planned_periods(read, a, b))
        own = found.groupBy("station_id").count()
        files_read = _files_read(own)
        assert sum(r["count"] for r in own.collect()) == sum(a <= r[2].year <= b for r in rows)
        return max(files_read)

    assert asked(1880, 1890, True) == 1 and asked(2024, 2025, True) == 2 and asked(1903, 1904, True) == 2
    assert asked(1880, 1890, False) == 4
    ranged = tables.read_range(spark, root, 1880, 1890).groupBy("station_id").count()
    assert max(_files_read(ranged)) == 1
    # labels are no years: a comparison of texts finds other rows
    assert tables.observations(spark, root).where("period = '1890'").isEmpty()
    assert tables.observations(spark, root).where("period >= '1900'").agg(F.min(F.year("obs_time"))).first()[0] == 1904


def _small_archive(spark, root, periods):
    layout = spark.createDataFrame(periods, "period string, start_year int, end_year int")
    rows = [(s, 1, T(y, 1, 1) + dt.timedelta(hours=h), float(h)) for s in (1, 2) for _, a, b in periods for y in range(a, b + 1) for h in range(5)]
    sinks.write_observations(lo.with_period(spark.createDataFrame(rows, OBS.rsplit(",", 1)[0]), layout), f"{root}/observations")
    sinks.write_layout(layout, f"{root}/layout.json")
    cp.rebuild_manifest(spark, root, "2026-01-01 00:00:00")
    return layout, len(rows)


def test_compaction_touches_what_it_has_to(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    layout, n = _small_archive(spark, root, [("2000-2001", 2000, 2001), ("2002", 2002, 2002)])
    ddl = OBS.rsplit(",", 1)[0]
    first = spark.createDataFrame([(1, 1, T(2002, 1, 1), 99.0), (9, 1, T(2002, 5, 1), 1.0), (9, 1, T(2005, 5, 1), 1.0)], ddl)
    later = spark.createDataFrame([(2, 1, T(2000, 1, 1), 77.0)], ddl)
    sinks.write_delta(first, f"{root}/deltas", "r1", "2026-01-01 00:00:00")
    before = {r.path for r in files.list_files(spark, f"{root}/observations").where("period = '2000-2001'").collect()}
    write = sinks.write_observations

    def arrives_meanwhile(*args, **options):
        sinks.write_delta(later, f"{root}/deltas", "r2", "2026-01-02 00:00:00")
        write(*args, **options)

    monkeypatch.setattr(sinks, "write_observations", arrives_meanwhile)
    stats = {r.period: tuple(r)[1:] for r in cp.compact_archive(spark, root, layout, now="2026-01-03 00:00:00").collect()}
    monkeypatch.setattr(sinks, "write_observations", write)
    assert stats == {"2002": (10, 2, 11), "2005": (0, 1, 1)}  # a year without a plan is its own label
    assert {r.path for r in files.list_files(spark, f"{root}/observations").where("period = '2000-2001'").collect()} == before
    obs = tables.observations(spark, root)
    assert obs.where("value = 99").count() == 1 and obs.count() == n + 2
    assert tables.manifest(spark, root).agg(F.sum("rows")).first()[0] == n + 2
    paths = [r.path for r in tables.manifest(spark, root).collect()]
    assert paths == sorted(paths)
    # what came in while the fold ran is still there, and is folded next
    assert tables.base_and_deltas(spark, root)[1].count() == 1
    assert [r.period for r in cp.compact_archive(spark, root, layout).collect()] == ["2000-2001"]
    assert tables.observations(spark, root).where("value = 77").count() == 1
    assert cp.compact_archive(spark, root, layout).isEmpty()
    # given periods: an unknown label without rows is skipped, a known one is rewritten without deltas
    got = cp.compact_archive(spark, root, layout, ["1950-1960", "2002"]).collect()
    assert [tuple(r) for r in got] == [("2002", 11, 0, 11)] and tables.observations(spark, root).count() == n + 2


def test_label_spans(spark):
    layout = spark.createDataFrame([("2000-2001", 2000, 2001)], "period string, start_year int, end_year int")
    labels_ = spark.createDataFrame([("2000-2001",), ("1990-1995",), ("2024",)], "period string")
    assert {tuple(r) for r in cp.label_spans(labels_, layout).collect()} == {("2000-2001", 2000, 2001), ("1990-1995", 1990, 1995), ("2024", 2024, 2024)}


def test_repartition_is_dry_unless_told(spark, tmp_path):
    root = str(tmp_path)
    _, n = _small_archive(spark, root, [("2000", 2000, 2000), ("2001", 2001, 2001), ("2002", 2002, 2002)])
    to = spark.createDataFrame([("2000-2001", 2000, 2001), ("2002", 2002, 2002)], "period string, start_year int, end_year int")
    periods = lambda: sorted(r.period for r in tables.observations(spark, root).select("period").distinct().collect())
    kept = {r.path for r in files.list_files(spark, f"{root}/observations").where("period = '2002'").collect()}
    assert {r.written: r.action for r in cp.apply_repartition(spark, root, to).collect()} == {"2000": "move", "2001": "move", "2002": "keep"}
    assert periods() == ["2000", "2001", "2002"]
    cp.apply_repartition(spark, root, to, dry_run=False, now="2026-01-01 00:00:00")
    assert periods() == ["2000-2001", "2002"] and tables.observations(spark, root).count() == n
    assert {r.path for r in files.list_files(spark, f"{root}/observations").where("period = '2002'").collect()} == kept
    assert {r.period for r in tables.layout(spark, f"{root}/layout.json").collect()} == {"2000-2001", "2002"}
    # several files of a period are folded in place
    obs = tables.observations(spark, root)
    again = obs.where("period = '2002'").withColumn("value", F.lit(5.0)).limit(3)
    again.write.mode("append").partitionBy("period").parquet(f"{root}/observations")
    assert {r.written: r.action for r in cp.apply_repartition(spark, root, to, dry_run=False).collect()} == {"2000-2001": "keep", "2002": "fold"}
    assert tables.observations(spark, root).count() == n
    with pytest.raises(ValueError, match="straddles"):
        cp.apply_repartition(spark, root, spark.createDataFrame([("2000", 2000, 2000), ("2001-2002", 2001, 2002)], "period string, start_year int, end_year int"), dry_run=False)


def test_documents_are_arrays(spark, tmp_path):
    (tmp_path / "networks.json").write_text('[{"id": 3, "name": "EC"},\n {"id": 4, "name": "X", "publish": true}]')
    assert [(r.id, r.name, r.publish) for r in payloads.read_document(spark, str(tmp_path / "networks.json"), "networks").collect()] == [(3, "EC", None), (4, "X", True)]


def test_point_grid(spark):
    points = spark.createDataFrame([(-120.0, 50.0), (-120.0, 50.0), (-110.0, 60.0), (None, 1.0), (-115.0, 55.0)], "lon double, lat double")
    got = {(r.col, r.row): r.n for r in an.point_grid(points, cells=10).collect()}
    assert sum(got.values()) == 4 and got[(0, 9)] == 2 and max(c for c, _ in got) < 10
    same = spark.createDataFrame([(1.0, 1.0)] * 3, "lon double, lat double")
    assert [tuple(r) for r in an.point_grid(same).collect()] == [(0, 0, 3)]
    assert an.point_grid(points.limit(0)).isEmpty()


def test_one_series_of_very_many_files(spark):
    """A series' rows are cut into any number of files of equal size."""
    second = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id"))
    rows = spark.range(30_000).select(F.lit(7).alias("station_id"), F.lit(1).cast("smallint").alias("variable_id"), (F.lit("2000-01-01").cast("timestamp_ntz") + second).alias("obs_time"), F.lit(1.0).alias("value"), F.lit("2000").alias("period"))
    plan = sinks.file_plan(rows, 10.0, 107, 50, 1000).first()
    assert plan.files > 2800 and len(plan.cuts) == plan.files - 1
    at = [(c.obs_time - T(2000, 1, 1)).total_seconds() for c in plan.cuts]
    sizes = [b - a for a, b in zip([0, *at], [*at, 30_000], strict=True)]
    assert min(sizes) >= 9 and max(sizes) <= 12
    # larger files are cut between hours
    hourly = sinks.file_plan(rows, 1.0, 1 << 20, 1 << 19, 1 << 30).first()
    assert hourly.files == 1 and not hourly.cuts


def test_layout_run(spark):
    """A plan that keeps the written cuts, its bytes by the files' own rate, and labels that it does not have."""
    histories = spark.createDataFrame([(T(2000, 1, 1), T(2004, 1, 1), "daily", [1, 2])], "min_obs_time timestamp_ntz, max_obs_time timestamp_ntz, freq string, variable_ids array<int>")
    manifest = spark.createDataFrame([("a", "2000-2001", 100, 1000, T(2001, 5, 1)), ("b", "1990", 50, 500, T(1990, 2, 1))], "path string, period string, rows long, file_bytes long, obs_time_max timestamp_ntz")
    measured = spark.createDataFrame([(2000, 60), (2001, 40)], "year int, rows long")
    plan, report = pl.layout_run(histories, manifest, measured, 2000, 2003, 900.0)
    assert [(r.period, r.bytes) for r in plan.orderBy("start_year").collect()][0] == ("2000-2001", 1000.0)
    found = {r.period: (r.planned_bytes, r.written, r.orphan) for r in report.collect()}
    assert found["1990"] == (None, True, True) and found["2000-2001"] == (1000, True, False)
    assert sum(x[0] or 0 for x in found.values()) == sum(r.bytes for r in plan.collect())
