"""Registered queries that write an archive from the driver's tables and work on its files, each with its SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import analytics as an
from ..operators import compaction as cp
from ..operators import layout as lo
from ..operators import manifest as mf
from ..operators import merge as mg
from ..operators import neighbours as nb
from ..operators import planning as pl
from ..operators import state as st
from ..operators import work as wk
from ..functions import labels
from ..functions.labels import path_period
from ..schema import KEYS
from ..sources import files, payloads, sinks, tables, versions
from ..streaming import fold, late
from . import views as v
from .catalogue import _EST, _FOLD, _STATES, ORACLE_SQL, _states, payload_contents, query
from .views import sql

NOW = "2026-01-01 00:00:00"
#: Small files, so that the driver's tables make several of them.
SIZES = {"target": 1 << 16, "floor": 1 << 15, "ceiling": 1 << 20}
_archives: dict[tuple[str, str], str] = {}


def _write(spark, d, layout) -> str:
    """The observations as a new archive, one key once, with layout and manifest."""
    root = v.scratch(spark, "archive")
    lo.with_period(mg.merged(v.observations(spark, d), None), layout).write.parquet(f"{root}/rows")
    sinks.write_observations(spark.read.parquet(f"{root}/rows"), f"{root}/observations", **SIZES)
    sinks.write_layout(layout, f"{root}/layout.json")
    cp.rebuild_manifest(spark, root, NOW)
    return root


def archive(spark, d) -> str:
    """One archive of these tables in a session, for the queries that only read it."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _archives or not tables.exists(spark, _archives[key]):
        _archives[key] = _write(spark, d, v.layout(spark, d))
    return _archives[key]


_KEYED = "keyed AS (SELECT period, station_id, variable_id, obs_time, max(value) AS value FROM placed GROUP BY 1, 2, 3, 4)"


def _keyed(body: str, *views: str, more: str = "") -> str:
    return sql("@", "placed", *views).replace(" @", f", {_KEYED}{more} {body}")


# reading with pruning


@query(_keyed("""SELECT s.station_name, date_trunc('month', o.obs_time)::TIMESTAMP AS month, round(avg(o.value), 2) AS mean, count(*) AS n FROM keyed o
    JOIN stations s USING (station_id) JOIN variables v USING (variable_id)
    WHERE s.lon BETWEEN -138.5 AND -120 AND s.lat BETWEEN 49 AND 57 AND v.standard_name = 'air_temperature' AND v.cell_method = 'time: point' AND year(o.obs_time) BETWEEN 1996 AND 1998 GROUP BY 1, 2""", "stations", "variables"))
def monthly_mean_box(spark, d):
    """Dimensions filtered first, periods pruned by a semi-join with the layout's file, times pushed to the scan."""
    root = archive(spark, d)
    rows = an.in_periods(tables.observations(spark, root), lo.planned_periods(tables.layout(spark, f"{root}/layout.json"), 1996, 1998))
    near = an.in_box(v.stations(spark, d), -138.5, 49, -120, 57)
    return an.monthly_means(an.between(rows, "1996-01-01", "1999-01-01"), near, an.of_kind(v.variables(spark, d), "air_temperature", "time: point"))


@query(_keyed("SELECT max(obs_time) AS newest, count(DISTINCT station_id) AS n_stations FROM keyed WHERE period IN (SELECT period FROM layout WHERE end_year >= 2001 AND start_year <= 2001)"))
def freshness(spark, d):
    root = archive(spark, d)
    return an.freshness(an.in_periods(tables.observations(spark, root), lo.planned_periods(tables.layout(spark, f"{root}/layout.json"), 2001, 2001)))


@query(_keyed("SELECT period, count(*) AS n, sum(value) AS total FROM keyed WHERE period IN (SELECT period FROM layout WHERE end_year >= 1996 AND start_year <= 1998) GROUP BY period"))
def period_semi_join(spark, d):
    root = archive(spark, d)
    rows = an.in_periods(tables.observations(spark, root), lo.planned_periods(tables.layout(spark, f"{root}/layout.json"), 1996, 1998))
    return rows.groupBy("period").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query(_keyed("SELECT station_id, variable_id, obs_time, value, period FROM keyed WHERE year(obs_time) BETWEEN 1997 AND 1998"))
def read_range(spark, d):
    return tables.read_range(spark, archive(spark, d), 1997, 1998)


@query(_keyed("SELECT station_id, variable_id, obs_time, value, period FROM keyed WHERE station_id BETWEEN 2 AND 5 AND obs_time >= TIMESTAMP '1998-01-01' AND obs_time < TIMESTAMP '1999-01-01'"))
def read_by_manifest(spark, d):
    """Only the files that the manifest names as meeting the request are opened."""
    root = archive(spark, d)
    return tables.read_files_meeting(spark, root, 2, 5, "1998-01-01", "1999-01-01")


# files, manifest, gate


@query(_keyed("SELECT period, CAST(greatest(1, floor(count(*) * 1.4::DOUBLE / 65536)) AS BIGINT) AS files, count(*) AS rows, min(station_id) AS station_id_min, max(station_id) AS station_id_max, min(obs_time) AS obs_time_min, max(obs_time) AS obs_time_max, true AS even FROM keyed GROUP BY period"))
def manifest_build(spark, d):
    """The written manifest: files of equal numbers of rows, as many as the plan says."""
    files_of = tables.manifest(spark, archive(spark, d)).withColumn("mean", F.avg("rows").over(v.by("period")))
    return files_of.groupBy("period").agg(
        F.count("*").alias("files"), F.sum("rows").alias("rows"), F.min("station_id_min").alias("station_id_min"), F.max("station_id_max").alias("station_id_max"),
        F.min("obs_time_min").alias("obs_time_min"), F.max("obs_time_max").alias("obs_time_max"), F.bool_and(F.abs(F.col("rows") - F.col("mean")) <= 0.2 * F.col("mean")).alias("even"),
    )


@query(_keyed("SELECT period, CAST(max(year(obs_time)) AS INTEGER) AS year FROM keyed GROUP BY period"))
def last_data_years(spark, d):
    return mf.last_data_year(tables.manifest(spark, archive(spark, d)))


@query(_keyed("SELECT period, count(*) AS rows FROM keyed GROUP BY period"))
def written_summary(spark, d):
    return spark.read.parquet(archive(spark, d) + "/_summary_by_period").select("period", "rows")


@query(_keyed("SELECT period, CAST(greatest(1, floor(count(*) * 1.4::DOUBLE / 65536)) AS BIGINT) AS n_files, count(*) AS n_rows, true AS agrees FROM keyed GROUP BY period"))
def written_inventory(spark, d):
    """The inventory by the written manifest; its sizes against those of the files."""
    root = archive(spark, d)
    sizes = files.list_files(spark, f"{root}/observations").groupBy("period").agg(F.sum("file_bytes").alias("bytes"))
    found = an.inventory(tables.manifest(spark, root)).join(sizes, "period")
    agrees = (F.col("size_mib") == F.round(F.col("bytes") / float(1 << 20), 1)) & (F.col("row_bytes") == F.round(F.col("bytes") / F.col("n_rows"), 2))
    return found.select("period", "n_files", "n_rows", agrees.alias("agrees"))


@query(_keyed("SELECT count(*) AS rows, min(obs_time) AS first_time, max(obs_time) AS last_time, true AS agrees FROM keyed"))
def written_totals(spark, d):
    """The archive's summary by the written manifest; its bytes against those of the files."""
    root = archive(spark, d)
    size = files.list_files(spark, f"{root}/observations").agg(F.sum("file_bytes")).first()[0]  # one number
    return mf.summarize(tables.manifest(spark, root)).select("rows", "first_time", "last_time", (F.col("bytes") == size).alias("agrees"))


@query(_keyed("SELECT period, CAST(greatest(1, floor(count(*) * 1.4::DOUBLE / 65536)) AS BIGINT) AS files FROM keyed GROUP BY period"))
def listed_files(spark, d):
    return files.list_files(spark, archive(spark, d) + "/observations").where("file_bytes > 0").groupBy("period").agg(F.count("*").alias("files"))


@query(_keyed("""SELECT 'station_id' AS column, count(*) AS rows, min(station_id)::VARCHAR AS least, max(station_id)::VARCHAR AS most FROM keyed
    UNION ALL SELECT 'variable_id', count(*), min(variable_id)::VARCHAR, max(variable_id)::VARCHAR FROM keyed
    UNION ALL SELECT 'obs_time', count(*), strftime(min(obs_time), '%Y-%m-%d %H:%M:%S'), strftime(max(obs_time), '%Y-%m-%d %H:%M:%S') FROM keyed
    UNION ALL SELECT 'value', count(*), '', '' FROM keyed"""))
def footer_statistics(spark, d):
    found = files.footers(spark, archive(spark, d) + "/observations")
    said = lambda whole, time: F.coalesce(whole.cast("string"), F.date_format(time, "yyyy-MM-dd HH:mm:ss"), F.lit(""))
    return found.groupBy("column").agg(F.sum("rows").alias("rows"), said(F.min("min_int"), F.min("min_time")).alias("least"), said(F.max("max_int"), F.max("max_time")).alias("most"))


@query(_keyed("SELECT period, CAST(greatest(1, floor(count(*) * 1.4::DOUBLE / 65536)) AS BIGINT) AS files, CAST(greatest(1, floor(count(*) * 1.4::DOUBLE / 65536)) AS BIGINT) AS same FROM keyed GROUP BY period"))
def file_checksums(spark, d):
    """Checksums read in chunks against those of the whole contents."""
    root = archive(spark, d) + "/observations"
    whole = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root).select("path", labels.multihash(F.col("content")).alias("whole"))
    both = files.checksums(spark, root, "*.parquet").join(whole, "path").withColumn("period", labels.path_period(F.col("path")))
    return both.groupBy("period").agg(F.count("*").alias("files"), F.count_if(F.col("multihash") == F.col("whole")).alias("same"))


def _defects(spark, d):
    """rows, and the root of their files with every defect planted: raw rows with repeated keys, falling order, large row groups, and a period of one file with a renamed column."""
    root = v.scratch(spark, "defects")
    rows = v.observations(spark, d).withColumn("period", F.year("obs_time").cast("string"))
    years = rows.select("period").distinct().count()
    ordered = rows.repartitionByRange(years, "period").sortWithinPartitions("period", F.desc("station_id"), "variable_id", "obs_time")
    ordered.write.option("parquet.block.row.count.limit", "1000").partitionBy("period").parquet(f"{root}/observations")
    odd = v.variables(spark, d).limit(1).select(F.col("variable_id").cast("int").alias("renamed"))
    odd.coalesce(1).write.parquet(f"{root}/observations/period=9999")
    return rows, root


@query(sql("""@ SELECT 'duplicate_keys' AS check, count(*) AS problems FROM (SELECT DISTINCT year FROM repeated) HAVING count(*) > 0
    UNION ALL SELECT 'row_group', CAST(sum(n // 1000 + CASE WHEN n % 1000 > 100 THEN 1 ELSE 0 END) AS BIGINT) FROM years
    UNION ALL SELECT 'schema', 2 UNION ALL SELECT 'under_floor', count(*) + 1 FROM years
    UNION ALL SELECT 'unsorted', count(*) FROM years WHERE n > 1000 HAVING count(*) > 0""", "obs").replace(" @ ", ", years AS (SELECT year(obs_time) AS year, count(*) AS n FROM obs GROUP BY 1), repeated AS (SELECT year(obs_time) AS year FROM obs GROUP BY year(obs_time), station_id, variable_id, obs_time HAVING count(*) > 1) "))
def verify_archive(spark, d):
    rows, root = _defects(spark, d)
    found = files.footers(spark, f"{root}/observations")
    problems = mf.verify(found, mf.build_manifest(found, NOW), rows, floor=1 << 40, most_rows=100)
    return problems.groupBy("check").agg(F.count("*").alias("problems"))


@query(sql("""@ SELECT 'duplicate_keys' AS check, count(*) AS problems FROM (SELECT DISTINCT year FROM repeated) HAVING count(*) > 0
    UNION ALL SELECT 'row_group', CAST(sum(n // 1000 + CASE WHEN n % 1000 > 100 THEN 1 ELSE 0 END) AS BIGINT) FROM years
    UNION ALL SELECT 'schema', 2 UNION ALL SELECT 'under_floor', count(*) + 1 FROM years
    UNION ALL SELECT 'unsorted', count(*) FROM years WHERE n > 1000 HAVING count(*) > 0""", "obs").replace(" @ ", ", years AS (SELECT year(obs_time) AS year, count(*) AS n FROM obs GROUP BY 1), repeated AS (SELECT year(obs_time) AS year FROM obs GROUP BY year(obs_time), station_id, variable_id, obs_time HAVING count(*) > 1) "))
def verify_files(spark, d):
    """The same by one pass along the files; nulls and falling keys, which it also finds, are another query's."""
    _, root = _defects(spark, d)
    problems = nb.verify_files(spark, root, floor=1 << 40, most_rows=100).where(~F.col("check").isin("null_keys", "falling_keys"))
    return problems.groupBy("check").agg(F.count("*").alias("problems"))


@query(_keyed("SELECT count(*) AS rows, 0::BIGINT AS problems FROM keyed"))
def verify_sound_archive(spark, d):
    root = archive(spark, d)
    rows = tables.observations(spark, root)
    problems = mf.verify(files.footers(spark, f"{root}/observations"), tables.manifest(spark, root), rows, floor=1)
    return rows.agg(F.count("*").alias("rows")).crossJoin(problems.agg(F.count("*").alias("problems")))  # two single rows


@query(_keyed("SELECT period, CAST(0 AS BIGINT) AS violations, count(*) AS rows FROM keyed GROUP BY period"))
def order_in_files(spark, d):
    """Rows in each file against the row before them, along the files: no row is sorted or exchanged."""
    root = archive(spark, d)
    segments = nb.key_segments(spark, root)
    down = nb.key_bounds(segments).groupBy(path_period(F.col("path")).alias("period")).agg(F.sum("down").alias("violations"))
    counts = tables.observations(spark, root).groupBy("period").agg(F.count("*").alias("rows"))
    return counts.join(down, "period", "left").select("period", F.coalesce("violations", F.lit(0)).alias("violations"), "rows")


# folding deltas


def _with_deltas(spark, d) -> str:
    """An archive of its own with two runs of deltas."""
    root = _write(spark, d, v.layout(spark, d))
    rows = v.deltas(spark, d).withColumn("run", F.second("ingested_at") % 2)
    for run in (0, 1):
        sinks.write_delta(rows.where(F.col("run") == run).select(*KEYS, "value"), f"{root}/deltas", f"r{run}", f"2020-01-0{run + 1} 00:00:00")
    return root


_RUNS = ", runs AS (SELECT station_id, variable_id, obs_time, value, TIMESTAMP '2020-01-01' + to_days(CAST(second(ingested_at) % 2 AS INTEGER)) AS ingested_at FROM deltas)"


@query(_keyed("""SELECT station_id, variable_id, obs_time, value, period FROM (SELECT *, row_number() OVER (PARTITION BY station_id, variable_id, obs_time ORDER BY ingested_at DESC, value DESC) AS r
    FROM (SELECT station_id, variable_id, obs_time, value, period, TIMESTAMP '1970-01-01' AS ingested_at FROM keyed
          UNION ALL SELECT station_id, variable_id, obs_time, value, l.period, ingested_at FROM runs JOIN layout l ON year(obs_time) BETWEEN l.start_year AND l.end_year)) WHERE r = 1""", "deltas", more=_RUNS))
def compact_archive(spark, d):
    """Touched periods folded and replaced, delta files cleared, manifest rebuilt, everything read back."""
    root = _with_deltas(spark, d)
    cp.compact_archive(spark, root, tables.layout(spark, f"{root}/layout.json"), now=NOW, **SIZES)
    left = files.list_files(spark, f"{root}/deltas").count()
    described = tables.manifest(spark, root).agg(F.sum("rows")).first()[0]
    rows = tables.observations(spark, root)
    return rows if not left and described == rows.count() else rows.limit(0)


@query(_keyed("SELECT '2000-2001' AS period, coalesce((SELECT count(*) FROM keyed WHERE period = '2000-2001'), 0) AS rows_before, (SELECT count(*) FROM runs) AS rows_delta, (SELECT count(*) FROM (SELECT station_id, variable_id, obs_time FROM runs UNION SELECT station_id, variable_id, obs_time FROM keyed WHERE period = '2000-2001')) AS rows_after", "deltas", more=_RUNS))
def compact_given(spark, d):
    """A label that the layout need not have: its years are in it."""
    root = _with_deltas(spark, d)
    return cp.compact_archive(spark, root, tables.layout(spark, f"{root}/layout.json"), ["2000-2001"], **SIZES)


@query(sql("SELECT station_id, variable_id, obs_time, value FROM (SELECT *, row_number() OVER (PARTITION BY station_id, variable_id, obs_time ORDER BY ingested_at DESC, value DESC) AS r FROM (SELECT *, TIMESTAMP '1970-01-01' AS ingested_at FROM obs UNION ALL SELECT * FROM deltas WHERE year(obs_time) = 2000)) WHERE r = 1", "obs", "deltas"))
def merge_of_years(spark, d):
    """Deltas of one year; base rows of all."""
    return mg.merged(v.observations(spark, d), v.deltas(spark, d), (2000, 2000))


@query(_keyed("SELECT period, count(*) AS rows FROM keyed GROUP BY period"))
def repartition_apply(spark, d):
    """A yearly archive moved to the planned layout."""
    years = v.year_bytes(spark, d).agg(F.min("year"), F.max("year")).first()  # two numbers
    root = _write(spark, d, lo.yearly_layout(spark, *years))
    cp.apply_repartition(spark, root, v.layout(spark, d), dry_run=False, now=NOW, **SIZES)
    return tables.manifest(spark, root).groupBy("period").agg(F.sum("rows").alias("rows"))


# versions of files


@query(_keyed("SELECT station_id, variable_id, obs_time, value, period FROM keyed WHERE station_id IN (1, 4, 9) AND obs_time >= TIMESTAMP '1996-01-01' AND obs_time < TIMESTAMP '1998-01-01'"))
def stations_far_apart(spark, d):
    """By a bitmap of the stations in each file, so that stations between them open no file."""
    root = _write(spark, d, v.layout(spark, d))
    cp.adopt(spark, root)
    return versions.read_stations(spark, root, [1, 4, 9], "1996-01-01", "1998-01-01")


@query(_keyed("""SELECT station_id, variable_id, obs_time, value, period FROM (SELECT *, row_number() OVER (PARTITION BY station_id, variable_id, obs_time ORDER BY newer DESC, value DESC) AS r
    FROM (SELECT station_id, variable_id, obs_time, value, period, 0 AS newer FROM keyed UNION ALL SELECT station_id, variable_id, obs_time, value, l.period, 1 FROM deltas JOIN layout l ON year(obs_time) BETWEEN l.start_year AND l.end_year WHERE station_id = 3)) WHERE r = 1""", "deltas"))
def compact_files(spark, d):
    """Deltas of one station: no file is rewritten that does not have its place."""
    root = _write(spark, d, v.layout(spark, d))
    cp.adopt(spark, root)
    holding = set(versions.files_of_stations(spark, root, [2, 3, 4]))
    before = {r.name for r in versions.listed(spark, root).select("name").collect()}
    sinks.write_delta(v.deltas(spark, d).where("station_id = 3").select(*KEYS, "value"), f"{root}/deltas", "r1", "2020-01-02 00:00:00")
    cp.compact_archive(spark, root, tables.layout(spark, f"{root}/layout.json"), **SIZES)
    replaced = before - {r.name for r in versions.listed(spark, root).select("name").collect()}
    rows = tables.observations(spark, root)
    return rows if replaced and replaced <= holding else rows.limit(0)


@query(_keyed("""SELECT 1 AS version, period, count(*) AS rows, round(sum(value), 3) AS total FROM keyed GROUP BY period
    UNION ALL SELECT 2, period, count(*), round(sum(value), 3) FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id, variable_id, obs_time ORDER BY ingested_at DESC, value DESC) AS r
        FROM (SELECT station_id, variable_id, obs_time, value, period, TIMESTAMP '1970-01-01' AS ingested_at FROM keyed
              UNION ALL SELECT station_id, variable_id, obs_time, value, l.period, ingested_at FROM runs JOIN layout l ON year(obs_time) BETWEEN l.start_year AND l.end_year)) WHERE r = 1) GROUP BY period""", "deltas", more=_RUNS))
def read_versions(spark, d):
    """The rows before a compaction and after it, both read after it."""
    root = _with_deltas(spark, d)
    cp.compact_archive(spark, root, tables.layout(spark, f"{root}/layout.json"), keep_versions=2, **SIZES)
    of = lambda n: versions.observations(spark, root, n).groupBy("period").agg(F.count("*").alias("rows"), F.round(F.sum("value"), 3).alias("total")).select(F.lit(n).alias("version"), "period", "rows", "total")
    return tables.union_all([of(1), of(2)])


@query(sql("SELECT CAST(year(obs_time) AS VARCHAR) AS period, CAST(sum(n - 1) AS BIGINT) AS extra_rows FROM (SELECT station_id, variable_id, obs_time, count(*) AS n FROM obs GROUP BY 1, 2, 3 HAVING count(*) > 1) GROUP BY 1", "obs"))
def duplicate_keys_in_files(spark, d):
    """Sorted files whose repeated keys also lie on both sides of their borders."""
    root = v.scratch(spark, "repeated")
    rows = v.observations(spark, d).withColumn("period", F.year("obs_time").cast("string"))
    tasks = max(3, 4 * spark.sparkContext.defaultParallelism)
    rows = rows.repartitionByRange(tasks, "period", *KEYS).sortWithinPartitions("period", *KEYS)
    written = sinks.write_in_order(rows, f"{root}/observations", 97, f"{root}/written")
    return nb.duplicate_keys_in_files(spark, root, files=written)


# small tables


@query(f"WITH {_STATES} SELECT station_id, watermark, last_attempt_at, rows_fetched_total, CAST(consecutive_failures AS SMALLINT) AS consecutive_failures FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY watermark DESC NULLS LAST, last_attempt_at DESC NULLS LAST) AS r FROM states) WHERE r = 1")
def state_files(spark, d):
    """Two writers' files read as one state."""
    root = v.scratch(spark, "state")
    text, time = F.lit(None).cast("string"), F.lit(None).cast("timestamp_ntz")
    rows = _states(spark, d).select("station_id", text.alias("network_name"), text.alias("native_id"), "watermark", "last_attempt_at", time.alias("last_success_at"), "rows_fetched_total", F.col("consecutive_failures").cast("smallint").alias("consecutive_failures"), text.alias("last_error"))
    for w in (0, 1):
        sinks.write_state(rows.where(F.pmod("consecutive_failures", F.lit(2)) == w), f"{root}/_state", f"w{w}")
    return tables.state(spark, root).select("station_id", "watermark", "last_attempt_at", "rows_fetched_total", "consecutive_failures")


@query(sql("SELECT station_id, network_name, native_id, variable_id, v.name, v.standard_name FROM stations, variables v", "stations", "variables"))
def dimension_files(spark, d):
    """Dimensions written, one with geometry, and read without it: every station with every variable."""
    root = v.scratch(spark, "dimensions")
    sinks.write_spatial(v.stations(spark, d), f"{root}/stations")
    sinks.write_dimension(v.variables(spark, d), f"{root}/variables")
    stations, variables = tables.dimension(spark, root, "stations"), tables.dimension(spark, root, "variables")
    return stations.select("station_id", "network_name", "native_id").crossJoin(F.broadcast(variables.select("variable_id", "name", "standard_name")))  # seven variables


@query(sql("SELECT station_id, 21 AS bytes, '0101000000' AS head, lon AS xmin, lat AS ymin, lon AS xmax, lat AS ymax FROM stations", "stations"))
def spatial_points(spark, d):
    path = v.scratch(spark, "points")
    sinks.write_spatial(v.stations(spark, d), path)
    return spark.read.parquet(path).select("station_id", F.octet_length("geometry").alias("bytes"), F.hex(F.substring("geometry", 1, 5)).alias("head"), "bbox.*")


@query("SELECT CAST(user_id AS INTEGER) AS station_id, CAST(length(event_type) AS SMALLINT) AS variable_id, date_trunc('second', ts)::TIMESTAMP AS obs_time, value FROM events WHERE user_id % 5 < 3 AND event_type IN ('click', 'view')")
def payload_observations(spark, d):
    """Cells to long rows by natural keys; columns that a network does not have are left out."""
    e = v.table(spark, d, "events")
    cells = e.select(F.concat(F.lit("N"), (F.col("user_id") % 5).cast("string")).alias("network_name"), F.col("user_id").cast("string").alias("native_id"), F.col("event_type").alias("name"), F.date_trunc("second", "ts").cast("timestamp_ntz").alias("obs_time"), "value")
    stations = e.select(F.concat(F.lit("N"), (F.col("user_id") % 5).cast("string")).alias("network_name"), F.col("user_id").cast("string").alias("native_id"), F.col("user_id").cast("int").alias("station_id")).distinct()
    networks = stations.select("network_name").distinct().withColumn("network_id", F.substring("network_name", 2, 1).cast("smallint"))
    known = e.where(F.col("event_type").isin("click", "view")).select("event_type").distinct().select(F.col("event_type").alias("name"), F.length("event_type").cast("smallint").alias("variable_id"))
    variables = known.withColumn("network_id", F.explode(F.array(*[F.lit(k).cast("smallint") for k in range(3)])))
    # of the ids of one name the larger is taken
    variables = variables.unionByName(variables.withColumn("variable_id", F.lit(1).cast("smallint")))
    return payloads.observations_of(cells, stations, variables, networks)


@query(sql("SELECT station_id, lo - INTERVAL 1 SECOND AS after, hi FROM (SELECT station_id, greatest(TIMESTAMP '1995-06-01', min_obs_time) AS lo, least(TIMESTAMP '2001-01-01', max_obs_time + INTERVAL 1 SECOND) AS hi FROM spans) WHERE lo < hi", "spans"))
def request_bounds(spark, d):
    """What to ask a service that only knows "later than", for the first window of each station."""
    work = wk.backfill_work(v.spans(spark, d), "1995-06-01", "2001-01-01", 0)
    return work.where("inclusive").select("station_id", wk.exclusive_bound(F.col("lo")).alias("after"), "hi")


@query(sql("SELECT period, CAST(start_year AS INTEGER) AS start_year, CAST(end_year AS INTEGER) AS end_year FROM layout UNION ALL SELECT DISTINCT CAST(year(obs_time) AS VARCHAR), CAST(year(obs_time) AS INTEGER), CAST(year(obs_time) AS INTEGER) FROM obs WHERE CAST(year(obs_time) AS VARCHAR) NOT IN (SELECT period FROM layout)", "obs", "plan"))
def label_years(spark, d):
    """Labels parsed back, of the layout and of single years."""
    layout = v.layout(spark, d).select("period")
    years = v.observations(spark, d).select(F.year("obs_time").cast("string").alias("period")).distinct()
    return layout.union(years).distinct().select("period", labels.period_years(F.col("period")).alias("y")).select("period", "y.*")


_BYTES = f"""(SELECT year, CAST(trunc(CASE WHEN m.rows IS NOT NULL THEN m.rows * 1.06::DOUBLE ELSE e.rows * 1.4::DOUBLE END) AS DOUBLE) AS bytes FROM ({_EST}) e
    FULL OUTER JOIN (SELECT CAST(year(obs_time) AS INTEGER) AS year, count(*) AS rows FROM obs WHERE year(obs_time) < 1999 GROUP BY 1) m USING (year))"""
_PLAN = v.SQL["plan"].replace("(SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) * 40.0::DOUBLE AS bytes FROM lineitem GROUP BY 1)", _BYTES).replace("(SELECT sum(bytes) * 0.3::DOUBLE FROM yb)", "1000000.0::DOUBLE").replace("{cut}", "year >= 1996")


@query(sql("@ SELECT period, CAST(start_year AS INTEGER) AS start_year, CAST(end_year AS INTEGER) AS end_year, bytes FROM layout", "histories").replace(" @ ", f", {_PLAN} "))
def full_plan(spark, d):
    """From estimates and what is measured; an archive whose first period ends 1996 keeps that cut."""
    measured = pl.measured_year_rows(v.observations(spark, d)).where("year < 1999")
    ends = spark.createDataFrame([(1996,)], "year int")
    return pl.full_plan(v.histories(spark, d), measured, 1994, 2003, 1e6, 1.06, written_ends=ends)


@query(sql("@ SELECT coalesce(l.period, w.period) AS period, CAST(coalesce(l.bytes, 0) AS BIGINT) AS planned_bytes, w.period IS NOT NULL AS written, l.period IS NULL AS orphan FROM layout l FULL OUTER JOIN (SELECT DISTINCT CAST(year(obs_time) AS VARCHAR) AS period FROM obs) w ON l.period = w.period", "histories").replace(" @ ", f", {_PLAN} "))
def layout_report(spark, d):
    """What a plan says of an archive whose periods are years: bytes of each period, and labels that it does not have."""
    measured = pl.measured_year_rows(v.observations(spark, d)).where("year < 1999")
    ends = spark.createDataFrame([(1996,)], "year int")
    plan = pl.full_plan(v.histories(spark, d), measured, 1994, 2003, 1e6, 1.06, written_ends=ends)
    planned = lo.planned_bytes(plan, pl.planned_sizes(v.histories(spark, d), measured, 1994, 2003, 1.06))
    written = v.observations(spark, d).select(F.year("obs_time").cast("string").alias("period"))
    return pl.layout_report(plan, planned, written).na.fill(0, ["planned_bytes"])


# state that comes in late, and streams

_LATE = f"""late AS (SELECT * FROM attempts WHERE event_id % 4 <> 0), {_FOLD.replace("FROM attempts", "FROM late")},
    more AS (SELECT a.*, f.last_success_at AS known, f.last_attempt_at AS prior, f.consecutive_failures AS had, f.last_error AS said FROM attempts a LEFT JOIN
        (SELECT *, CASE WHEN consecutive_failures > 0 THEN error END AS last_error FROM folded) f USING (station_id) WHERE a.event_id % 4 = 0),
    news AS (SELECT *, greatest(known, max(CASE WHEN status = 'ok' THEN tried END) OVER (PARTITION BY station_id)) AS last_ok FROM more),
    added AS (SELECT station_id, count(*) FILTER (status <> 'ok' AND (last_ok IS NULL OR tried > last_ok)) AS fresh, arg_max(error, (tried, error)) FILTER (status <> 'ok' AND (last_ok IS NULL OR tried > last_ok)) AS error,
        max(tried) FILTER (status <> 'ok' AND (last_ok IS NULL OR tried > last_ok)) AS failed_at, max(CASE WHEN status = 'ok' THEN tried END) AS success_at, max(tried) AS attempt_at FROM news GROUP BY 1),
    final AS (SELECT coalesce(f.station_id, a.station_id) AS station_id, greatest(f.last_attempt_at, a.attempt_at) AS last_attempt_at, greatest(f.last_success_at, a.success_at) AS last_success_at,
        coalesce(a.fresh, 0) AS fresh, CASE WHEN a.success_at > f.last_attempt_at OR (f.last_attempt_at IS NULL AND a.success_at IS NOT NULL) THEN 0 ELSE coalesce(f.consecutive_failures, 0) END AS kept,
        a.error, a.failed_at, f.last_attempt_at AS prior, CASE WHEN f.consecutive_failures > 0 THEN f.error END AS said FROM folded f FULL OUTER JOIN added a USING (station_id))"""


@query(sql("@ SELECT station_id, last_attempt_at, last_success_at, CAST(kept + fresh AS INTEGER) AS consecutive_failures, CASE WHEN failed_at IS NOT NULL AND (kept = 0 OR prior IS NULL OR failed_at > prior) THEN error WHEN kept > 0 THEN said END AS last_error FROM final", "attempts").replace(" @ ", f", {_LATE} "))
def late_attempts(spark, d):
    """A quarter of the attempts, from all times, comes in after the rest."""
    every = v.attempts(spark, d)
    empty = spark.createDataFrame([], fold.STATE)
    first = st.fold_attempts(empty, every.where("event_id % 4 <> 0"))
    out = st.fold_attempts(first, every.where("event_id % 4 = 0"))
    return out.select("station_id", "last_attempt_at", "last_success_at", "consecutive_failures", "last_error")


@query(sql("SELECT station_id, variable_id, obs_time, value, ingested_at, CAST(year(obs_time) AS VARCHAR) AS period FROM (SELECT *, row_number() OVER (PARTITION BY station_id, variable_id, obs_time ORDER BY ingested_at DESC, value DESC) AS r FROM deltas) WHERE r = 1", "deltas"))
def stream_lww(spark, d):
    root = v.scratch(spark, "stream-lww")
    v.deltas(spark, d).repartition(8).write.parquet(f"{root}/deltas")
    return fold.merge_stream(spark, f"{root}/deltas", f"{root}/out", f"{root}/checkpoint")


@query(sql("""@ SELECT station_id, variable_id, obs_time, value, ingested_at, 'late' AS kind FROM judged WHERE late
    UNION ALL SELECT station_id, variable_id, obs_time, value, ingested_at, 'merged' FROM (SELECT *, row_number() OVER (PARTITION BY station_id, variable_id, obs_time ORDER BY ingested_at DESC, value DESC) AS r FROM judged WHERE NOT late) WHERE r = 1""", "deltas").replace(" @ ", """, read AS (SELECT *, CAST(epoch(ingested_at) AS BIGINT) % 4 AS k FROM deltas),
    known AS (SELECT station_id, k, max(max(ingested_at)) OVER (PARTITION BY station_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM read GROUP BY station_id, k),
    judged AS (SELECT r.*, coalesce(r.ingested_at < n.newest - INTERVAL 600 SECOND, false) AS late FROM read r JOIN known n ON r.station_id IS NOT DISTINCT FROM n.station_id AND r.k IS NOT DISTINCT FROM n.k) """))
def stream_late(spark, d):
    """Four batches of deltas; what is older than the window of its station goes to the table of late rows."""
    root = v.scratch(spark, "stream-late")
    rows = v.deltas(spark, d).withColumn("k", F.unix_seconds(F.col("ingested_at").cast("timestamp")) % 4)
    for k in range(4):
        rows.where(F.col("k") == k).drop("k").coalesce(1).write.mode("append").parquet(f"{root}/deltas")
    merged, late_ = late.revision_stream(spark, f"{root}/deltas", f"{root}/out", f"{root}/checkpoint", window=dt.timedelta(seconds=600), files_a_batch=1)
    return tables.union_all([merged.drop("period").withColumn("kind", F.lit("merged")), late_.withColumn("kind", F.lit("late"))])


@query(ORACLE_SQL["csv_payload_job"])
def payload_files(spark, d):
    """events as files of wide payloads, one a user, read in short ranges of bytes; users of % 10 = 3 have a broken payload."""
    root = v.scratch(spark, "landed")
    payloads.land(payload_contents(spark, d), root)
    cells, _ = payloads.cells_of_lines(payloads.read_payload_lines(spark, root, "*.txt", range_bytes=1000))
    return cells.where(F.col("value").isNotNull()).select(F.col("native_id").cast("int").alias("station_id"), "name", "obs_time", "value")


@query(sql("SELECT station_id, watermark, last_attempt_at, last_success_at, rows_fetched_total, consecutive_failures, CASE WHEN consecutive_failures > 0 THEN error END AS last_error FROM folded", "attempts").replace(" SELECT station_id, watermark, last", f", {_FOLD} SELECT station_id, watermark, last", 1))
def stream_state(spark, d):
    """Files that land one after the other, in the order in which attempts are made: a file a week and a file a batch."""
    root = v.scratch(spark, "stream-state")
    rows = v.attempts(spark, d).select("station_id", "at", "status", "max_time", "rows", "error", F.floor(F.dayofmonth("at") / 8).alias("week"))
    for week in range(4):
        rows.where(F.col("week") == week).drop("week").coalesce(1).write.mode("append").parquet(f"{root}/attempts")
    return fold.run_state_stream(spark, f"{root}/attempts", f"{root}/out", f"{root}/checkpoint", files_a_batch=1)
