"""The registered queries over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo, labels, times
from ..operators import analytics as an
from ..operators import layout as lo
from ..operators import manifest as mf
from ..operators import merge as mg
from ..operators import metadata as md
from ..operators import planning as pl
from ..operators import repartition as rp
from ..operators import state as st
from ..operators import work as wk
from ..sources import payloads, sinks, tables
from . import views as v
from .views import sql

QUERIES: dict = {}
ORACLE_SQL: dict = {}
NOW = "2001-06-01 00:00:00"


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return register


def _placed(spark, d):
    return lo.with_period(v.observations(spark, d), v.layout(spark, d))


def _strings(df: DataFrame, *arrays: str) -> DataFrame:
    """Arrays as text, for comparing."""
    return df.withColumns({a: F.concat_ws(",", F.col(a).cast("array<string>")) for a in arrays})


# analytics


@query(sql("SELECT period, n_files, n_rows, round(size / 1048576.0::DOUBLE, 1) AS size_mib, round(size / n_rows::DOUBLE, 2) AS row_bytes FROM (SELECT period, count(*) AS n_files, CAST(sum(rows) AS BIGINT) AS n_rows, sum(file_bytes)::DOUBLE AS size FROM manifest GROUP BY period)", "manifest"))
def inventory_by_period(spark, d):
    return an.inventory(v.manifest(spark, d))


@query(sql("SELECT s.network_name, s.native_id, v.name, o.obs_time, o.value FROM obs o JOIN stations s USING (station_id) JOIN variables v USING (variable_id) WHERE s.native_id = 'N7' AND v.name IN ('v2', 'v5') AND o.obs_time >= TIMESTAMP '1996-01-01' AND o.obs_time < TIMESTAMP '2000-01-01'", "obs", "stations", "variables"))
def station_series(spark, d):
    rows = an.between(v.observations(spark, d), "1996-01-01", "2000-01-01")
    wanted = v.stations(spark, d).where("native_id = 'N7'").withColumn("name", F.explode(F.array(F.lit("v2"), F.lit("v5"))))
    return an.series(rows, v.stations(spark, d), v.variables(spark, d), wanted)


@query(sql("SELECT station_id, variable_id, obs_time, value FROM obs ORDER BY obs_time, station_id, variable_id, value LIMIT 20", "obs"))
def first_readings(spark, d):
    return v.observations(spark, d).orderBy("obs_time", "station_id", "variable_id", "value").limit(20)


@query(sql("SELECT station_id, mean, n, station_name, lon, lat FROM (SELECT station_id, avg(value) AS mean, count(*) AS n FROM obs WHERE obs_time >= TIMESTAMP '1997-01-01' AND obs_time < TIMESTAMP '1998-01-01' GROUP BY 1) JOIN stations USING (station_id)", "obs", "stations"))
def station_means(spark, d):
    return an.station_means(an.between(v.observations(spark, d), "1997-01-01", "1998-01-01"), v.stations(spark, d))


@query(sql("SELECT variable_id, CAST(month(obs_time) AS INTEGER) AS month, avg(value) AS mean, count(*) AS n FROM obs GROUP BY 1, 2", "obs"))
def monthly_climatology(spark, d):
    return an.monthly_climatology(v.observations(spark, d), ["variable_id"])


@query(sql("SELECT standard_name, cell_method, string_agg(variable_id::VARCHAR, ',' ORDER BY variable_id) AS variable_ids FROM variables GROUP BY 1, 2", "variables"))
def variable_groups(spark, d):
    return _strings(an.variable_groups(v.variables(spark, d)), "variable_ids")


@query(sql("SELECT station_id FROM stations WHERE lon > -138.5 AND lat > 49 AND lon < -116 AND lat < 55.5", "stations"))
def bbox_struct_filter(spark, d):
    """On the written covering column, so that the scan can skip row groups."""
    path = v.scratch(spark, "spatial")
    sinks.write_spatial(v.stations(spark, d), path)
    return spark.read.parquet(path).where(geo.bbox_inside("bbox", -138.5, 49, -116, 55.5)).select("station_id")


@query(sql("SELECT min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north, min(min_obs_time) AS first_time, max(max_obs_time) AS last_time, count(*) AS rows FROM spans", "spans"))
def extent(spark, d):
    return an.extent(v.spans(spark, d))


@query(sql("""SELECT CAST(least(99, floor((lon - west) * squeeze / cell)) AS INTEGER) AS col, CAST(least(99, floor((north - lat) / cell)) AS INTEGER) AS row, count(*) AS n
    FROM stations, (SELECT *, greatest((east - west) * squeeze, north - south) / 100.0::DOUBLE AS cell FROM (SELECT *, greatest(0.1::DOUBLE, cos(radians(south + (north - south) / 2))) AS squeeze
      FROM (SELECT min(lon) AS west, max(lon) AS east, min(lat) AS south, max(lat) AS north FROM stations))) GROUP BY 1, 2""", "stations"))
def point_grid(spark, d):
    return an.point_grid(v.stations(spark, d))


# reshaping


@query("SELECT * FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, CASE WHEN l_tax > 0 THEN l_tax END AS l_tax FROM lineitem) ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME name VALUE value)")
def unpivot_lineitem(spark, d):
    wide = v.table(spark, d, "lineitem").withColumn("l_tax", F.when(F.col("l_tax") > 0, F.col("l_tax")))
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    return payloads.unpivot(wide.select(*keys, "l_quantity", "l_extendedprice", "l_discount", "l_tax"), keys, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


def _event_cells(spark, d):
    e = v.table(spark, d, "events")
    return e.select(F.concat(F.lit("NATION_"), (F.col("user_id") % 5).cast("string")).alias("network_name"), F.col("event_type").alias("name"), F.col("value"))


@query("SELECT DISTINCT 'NATION_' || (user_id % 5) AS network_name, event_type AS name FROM events WHERE NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_name = 'NATION_' || (user_id % 5) AND n.n_regionkey IN (0, 1, 3) AND event_type IN ('click', 'view'))")
def unmapped_columns(spark, d):
    nations = v.table(spark, d, "nation")
    nets = nations.select(F.col("n_nationkey").cast("smallint").alias("network_id"), F.col("n_name").alias("network_name"))
    known = nations.where(F.col("n_regionkey").isin(0, 1, 3)).select(F.col("n_nationkey").cast("smallint").alias("network_id"), F.explode(F.array(F.lit("click"), F.lit("view"))).alias("name"))
    return payloads.unmapped_columns(_event_cells(spark, d), known, nets)


@query("SELECT event_type, count(*) AS cells, count(v) AS numbers, sum(v)::DOUBLE AS total FROM (SELECT event_type, CASE WHEN event_id % 11 < 4 THEN NULL ELSE user_id::DOUBLE END AS v FROM events) GROUP BY 1")
def null_tokens(spark, d):
    k = F.col("event_id") % 11
    raw = F.when(k == 0, "None").when(k == 1, "NaN").when(k == 2, "-9999").when(k == 3, "").otherwise(F.col("user_id").cast("string"))
    cells = v.table(spark, d, "events").select("event_type", labels.number_or_null(raw).alias("v"))
    return cells.groupBy("event_type").agg(F.count("*").alias("cells"), F.count("v").alias("numbers"), F.sum("v").alias("total"))


def payload_contents(spark, d):
    """events as wide payloads, one a user; users of % 10 = 3 have a broken one."""
    e = v.table(spark, d, "events").select("user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"), "value")
    kinds = [r.event_type for r in e.select("event_type").distinct().orderBy("event_type").collect()]  # the event types, five
    wide = e.groupBy("user_id", "t").pivot("event_type", kinds).agg(F.max("value"))
    line = F.concat_ws(", ", "t", *[F.coalesce(F.col(k).cast("string"), F.lit("None")) for k in kinds])
    head = F.when(F.col("user_id") % 10 == 3, "Error {}").otherwise(payloads.SEQUENCE)
    return wide.groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("body")).select(
        F.concat(F.lit("u/"), F.col("user_id").cast("string")).alias("path"), F.lit("u").alias("network_name"), F.col("user_id").cast("string").alias("native_id"),
        F.concat(head, F.lit("\n" + ", ".join(["time", *kinds]) + "\n"), "body").alias("content"),
    )


@query("SELECT CAST(user_id AS INTEGER) AS station_id, event_type AS name, date_trunc('second', ts)::TIMESTAMP AS obs_time, max(value) AS value FROM events WHERE user_id % 10 <> 3 GROUP BY 1, 2, 3")
def csv_payload_job(spark, d):
    """Payloads in columns, read back into long rows."""
    cells, _ = payloads.long_cells(payloads.triage(payload_contents(spark, d)))
    return cells.where(F.col("value").isNotNull()).select(F.col("native_id").cast("int").alias("station_id"), "name", "obs_time", "value")


# merging


@query(sql("""SELECT CAST(station_id AS INTEGER) AS station_id, CAST(variable_id AS SMALLINT) AS variable_id, obs_time, value FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id, variable_id, obs_time ORDER BY ingested_at DESC, value DESC) AS r
    FROM (SELECT *, TIMESTAMP '1970-01-01' AS ingested_at FROM obs UNION ALL SELECT * FROM deltas)) WHERE r = 1""", "obs", "deltas"))
def lww_merge(spark, d):
    return mg.merged(v.observations(spark, d), v.deltas(spark, d))


@query(sql("""SELECT CAST(station_id AS INTEGER) AS station_id, CAST(variable_id AS SMALLINT) AS variable_id, obs_time, value, period FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id, variable_id, obs_time ORDER BY ingested_at DESC, value DESC) AS r
    FROM (SELECT station_id, variable_id, obs_time, value, period, TIMESTAMP '1970-01-01' AS ingested_at FROM placed
          UNION ALL SELECT station_id, variable_id, obs_time, d.value, l.period, d.ingested_at FROM deltas d JOIN layout l ON year(d.obs_time) BETWEEN l.start_year AND l.end_year)) WHERE r = 1
    AND period IN (SELECT l.period FROM deltas d JOIN layout l ON year(d.obs_time) BETWEEN l.start_year AND l.end_year)""", "placed", "deltas"))
def compact_touched(spark, d):
    return mg.compact(_placed(spark, d), v.deltas(spark, d), v.layout(spark, d))


@query(sql("SELECT DISTINCT l.period FROM deltas d JOIN layout l ON year(d.obs_time) BETWEEN l.start_year AND l.end_year", "plan", "deltas"))
def touched_periods(spark, d):
    return mg.touched_periods(v.deltas(spark, d), v.layout(spark, d))


@query(sql("SELECT period, CAST(sum(n - 1) AS BIGINT) AS extra_rows FROM (SELECT period, count(*) AS n FROM placed GROUP BY period, station_id, variable_id, obs_time HAVING count(*) > 1) GROUP BY period", "placed"))
def duplicate_keys(spark, d):
    return mg.duplicate_keys(_placed(spark, d), ["period"])


@query("""SELECT CAST(l_suppkey AS INTEGER) AS station_id, count(*) AS violations FROM (SELECT *,
    (l_suppkey, l_linenumber, l_shipdate) < lag((l_suppkey, l_linenumber, l_shipdate)) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_partkey, l_quantity, l_extendedprice) AS down FROM lineitem) WHERE down GROUP BY 1""")
def sort_violations(spark, d):
    rows = v.table(spark, d, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("station_id"), F.col("l_linenumber").alias("variable_id"), F.col("l_shipdate").alias("obs_time"),
        F.struct("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice").alias("at"),
    )
    return mg.sort_violations(rows, ["station_id"], "at", ["station_id", "variable_id", "obs_time"])


# metadata


def _documents(spark, d):
    """events as nested metadata: a station a user, a history a user and type."""
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    e = v.table(spark, d, "events").withColumn("kind", F.length("event_type"))
    h = e.groupBy("user_id", "event_type", "kind").agg(iso(F.min("ts")).alias("min_obs_time"), iso(F.max("ts")).alias("max_obs_time"), F.array(F.col("kind"), F.col("kind") + 1).alias("variable_ids"))
    h = h.select(
        (F.col("user_id") * 100 + F.conv(F.substring(F.md5(F.col("event_type").cast("binary")), 1, 2), 16, 10).cast("int") % 100).cast("int").alias("id"), F.concat("event_type", F.lit("-"), F.col("user_id").cast("string")).alias("station_name"),
        F.col("user_id").cast("double").alias("lon"), F.lit(50.0).alias("lat"), F.lit(None).cast("double").alias("elevation"), F.lit("BC").alias("province"), F.lit("CA").alias("country"), F.lit("daily").alias("freq"),
        F.lit("-8").alias("tz_offset"), F.lit(None).cast("string").alias("sdate"), F.lit(None).cast("string").alias("edate"), "min_obs_time", "max_obs_time", "variable_ids", "user_id",
    )
    nested = F.struct(*[c for c in h.columns if c != "user_id"])
    raw = h.groupBy("user_id").agg(F.sort_array(F.collect_list(nested)).alias("histories")).select(
        F.col("user_id").cast("int").alias("id"), F.concat(F.lit("n"), F.col("user_id").cast("string")).alias("native_id"), F.concat(F.lit("http://x/networks/"), (F.col("user_id") % 25).cast("string")).alias("network_uri"), "histories"
    )
    path = v.scratch(spark, "documents")
    raw.write.json(f"{path}/stations")
    h.drop("user_id").write.json(f"{path}/histories")
    return payloads.read_document(spark, f"{path}/stations", "stations", lines=True), payloads.read_document(spark, f"{path}/histories", "histories", lines=True)


_HIST_SQL = """WITH h AS (SELECT user_id, event_type, length(event_type) AS kind, date_trunc('second', min(ts))::TIMESTAMP AS lo, date_trunc('second', max(ts))::TIMESTAMP AS hi,
    CAST(user_id * 100 + ('0x' || substr(md5(event_type), 1, 2))::INTEGER % 100 AS INTEGER) AS id FROM events GROUP BY 1, 2, 3) """


@query(_HIST_SQL + """, ids AS (SELECT user_id, string_agg(x::VARCHAR, ',' ORDER BY x) AS variable_ids FROM (SELECT DISTINCT user_id, unnest([kind, kind + 1]) AS x FROM h) GROUP BY 1),
    recent AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY hi DESC, id) AS r FROM h)
    SELECT CAST(user_id AS INTEGER) AS station_id, CAST(user_id % 25 AS SMALLINT) AS network_id, n_name AS network_name, 'n' || user_id AS native_id,
      (SELECT event_type || '-' || r.user_id FROM recent r WHERE r.user_id = g.user_id AND r.r = 1) AS station_name, lo AS min_obs_time, hi AS max_obs_time, CAST(n AS SMALLINT) AS history_count, variable_ids
    FROM (SELECT user_id, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM h GROUP BY 1) g JOIN ids USING (user_id) LEFT JOIN nation ON n_nationkey = user_id % 25""")
def station_rollup(spark, d):
    raw, _ = _documents(spark, d)
    out = md.station_rollup(raw, v.networks(spark, d))
    return _strings(out, "variable_ids").drop("lon", "lat", "elevation", "province", "freq")


@query(_HIST_SQL + "SELECT id AS history_id, CAST(max(user_id) AS INTEGER) AS station_id, lo AS min_obs_time, hi AS max_obs_time, event_type || '-' || user_id AS station_name, '-8' AS tz_offset, n_name AS network_name FROM h LEFT JOIN nation ON n_nationkey = user_id % 25 GROUP BY id, lo, hi, event_type, user_id, n_name")
def history_attach(spark, d):
    raw, flat = _documents(spark, d)
    return md.attach_histories(flat, raw, v.networks(spark, d)).select("history_id", "station_id", "min_obs_time", "max_obs_time", "station_name", "tz_offset", "network_name")


# layout and planning

_EST = """SELECT CAST(y AS INTEGER) AS year, CAST(trunc(sum(trunc(per_day * variable_id * days)) * (1 / 1.84::DOUBLE)) AS BIGINT) AS rows FROM (
    SELECT per_day, variable_id, y, greatest(0, floor(date_diff('second', greatest(min_obs_time, make_timestamp(y, 1, 1, 0, 0, 0)), least(max_obs_time, make_timestamp(y + 1, 1, 1, 0, 0, 0))) / 86400.0)) AS days
    FROM (SELECT *, unnest(range(greatest(year(min_obs_time), 1994), least(year(max_obs_time), 2003) + 1)) AS y FROM histories)) GROUP BY y"""


@query(sql("SELECT CAST(year(obs_time) AS INTEGER) AS year, count(*) AS rows FROM obs GROUP BY 1", "obs"))
def year_rows_measured(spark, d):
    return pl.measured_year_rows(v.observations(spark, d))


@query(sql(_EST, "histories"))
def year_rows_estimated(spark, d):
    return pl.estimated_year_rows(v.histories(spark, d), 1994, 2003)


@query(sql(f"""SELECT year, CAST(trunc(CASE WHEN m.rows IS NOT NULL THEN m.rows * 1.06::DOUBLE ELSE e.rows * 1.4::DOUBLE END) AS BIGINT) AS bytes FROM ({_EST}) e
    FULL OUTER JOIN (SELECT CAST(year(obs_time) AS INTEGER) AS year, count(*) AS rows FROM obs WHERE year(obs_time) < 1999 GROUP BY 1) m USING (year)""", "histories"))
def year_bytes(spark, d):
    measured = pl.measured_year_rows(v.observations(spark, d)).where("year < 1999")
    return pl.year_bytes(pl.estimated_year_rows(v.histories(spark, d), 1994, 2003), measured, 1.06)


@query(sql("SELECT period, CAST(start_year AS INTEGER) AS start_year, CAST(end_year AS INTEGER) AS end_year, bytes FROM layout", "plan"))
def plan_periods(spark, d):
    return v.layout(spark, d)


@query(sql("SELECT period, CAST(start_year AS INTEGER) AS start_year, CAST(end_year AS INTEGER) AS end_year, bytes FROM layout", "plan", cut="year IN (1996, 1999, 2000, 2001)"))
def plan_periods_cut_after(spark, d):
    sizes = v.with_floor(v.year_bytes(spark, d))
    ends = sizes.where(F.col("year").isin(1996, 1999)).select("year")
    return lo.plan_periods(sizes, F.col("floor"), cut_after=lo.allowed_cuts(ends, 2001))


@query(sql("SELECT period, count(*) AS n FROM placed GROUP BY period", "placed"))
def period_for_rows(spark, d):
    return _placed(spark, d).groupBy("period").agg(F.count("*").alias("n"))


@query(sql("SELECT DISTINCT coalesce(l.period, CAST(y AS VARCHAR)) AS period FROM (SELECT unnest(range(1993, 2006)) AS y) LEFT JOIN layout l ON y BETWEEN l.start_year AND l.end_year", "plan"))
def periods_for_range(spark, d):
    return lo.periods_for_range(v.layout(spark, d), 1993, 2005).select("period")


@query(sql("SELECT period FROM layout WHERE end_year >= 1998 AND start_year <= 2000", "plan"))
def periods_for_function(spark, d):
    v.layout_file(spark, d).createOrReplaceTempView("longtide_layout")
    lo.register_periods_for(spark, "longtide_layout")
    return spark.sql("SELECT period FROM periods_for(1998, 2000)")


@query(sql("SELECT DISTINCT CAST(year(obs_time) AS VARCHAR) AS period FROM obs WHERE CAST(year(obs_time) AS VARCHAR) NOT IN (SELECT period FROM layout)", "obs", "plan"))
def orphaned_periods(spark, d):
    written = v.observations(spark, d).select(F.year("obs_time").cast("string").alias("period"))
    return lo.orphaned_periods(written, v.layout(spark, d))


@query(sql("""SELECT written, lo, hi, max(CASE WHEN lo BETWEEN start_year AND end_year AND hi BETWEEN start_year AND end_year THEN period END) AS period,
    CASE WHEN bool_or(lo BETWEEN start_year AND end_year AND hi BETWEEN start_year AND end_year) THEN 'ok' WHEN count(period) > 1 THEN 'straddles' ELSE 'outside_plan' END AS verdict
    FROM (SELECT variable_id::VARCHAR AS written, CAST(min(year(obs_time)) AS INTEGER) AS lo, CAST(min(year(obs_time)) + (variable_id - 1) AS INTEGER) AS hi FROM obs GROUP BY variable_id)
    LEFT JOIN layout ON lo BETWEEN start_year AND end_year OR hi BETWEEN start_year AND end_year GROUP BY 1, 2, 3""", "obs", "plan"))
def nesting(spark, d):
    first = F.min(F.year("obs_time"))
    spans = v.observations(spark, d).groupBy("variable_id").agg(first.alias("lo")).select(F.col("variable_id").cast("string").alias("written"), "lo", (F.col("lo") + F.col("variable_id") - 1).cast("int").alias("hi"))
    return lo.nesting(spans, v.layout(spark, d))


@query(sql("SELECT l.period, sum(y.bytes) AS bytes FROM yb y JOIN layout l ON y.year BETWEEN l.start_year AND l.end_year GROUP BY 1", "plan"))
def planned_bytes(spark, d):
    return lo.planned_bytes(v.layout(spark, d), v.year_bytes(spark, d))


@query(sql("SELECT station_id % 5 AS shard, count(*) AS active_histories, CAST(sum(variable_id) AS BIGINT) AS variable_slots, sum(per_day * variable_id) AS obs_per_day FROM histories WHERE floor(date_diff('second', max_obs_time, TIMESTAMP '2001-06-01') / 86400.0) <= 60 GROUP BY 1", "histories"))
def arrival_rate(spark, d):
    return pl.arrival_rate(v.histories(spark, d).withColumn("shard", F.col("station_id") % 5), NOW, 60, ["shard"])


@query(sql("SELECT coalesce(freq, 'None') AS freq, count(*) AS histories FROM histories WHERE floor(date_diff('second', max_obs_time, TIMESTAMP '2001-06-01') / 86400.0) <= 60 GROUP BY 1", "histories"))
def active_by_frequency(spark, d):
    return pl.active_by_frequency(v.histories(spark, d), NOW, 60)


@query(sql("""SELECT station_id, obs_per_day, obs_per_day * 1.4::DOUBLE AS bytes_per_day, 400000.0::DOUBLE / (obs_per_day * 1.4::DOUBLE) AS days_to_floor,
    CASE WHEN hours <= 1 THEN 'hourly' WHEN hours <= 6 THEN '6-hourly' ELSE 'daily' END AS append_every,
    CASE WHEN 400000.0::DOUBLE / (obs_per_day * 1.4::DOUBLE) <= 7 THEN 'weekly' WHEN 400000.0::DOUBLE / (obs_per_day * 1.4::DOUBLE) <= 31 THEN 'monthly' ELSE 'quarterly' END AS compact_every
    FROM (SELECT station_id, sum(per_day * variable_id) AS obs_per_day, station_id % 10 AS hours FROM histories GROUP BY 1)""", "histories"))
def cadence(spark, d):
    rates = pl.arrival_rate(v.histories(spark, d), NOW, 100_000, ["station_id"]).withColumn("freshness_hours", F.col("station_id") % 10)
    return pl.cadence(rates, floor_bytes=400_000, target_bytes=800_000).select("station_id", "obs_per_day", "bytes_per_day", "days_to_floor", "append_every", "compact_every")


# work plans and state


@query(sql("SELECT station_id FROM spans WHERE max_obs_time >= TIMESTAMP '1996-01-01' AND min_obs_time < TIMESTAMP '1999-01-01' AND station_id % 3 = 1 AND network_name IN ('NATION_1', 'NATION_4', 'NATION_15', 'NATION_20')", "spans"))
def target_select(spark, d):
    return wk.backfill_targets(v.spans(spark, d), 1996, 1998, ["NATION_1", "NATION_4", "NATION_15", "NATION_20"], 1, 3).select("station_id")


@query(sql("SELECT station_id, greatest(TIMESTAMP '1995-01-20', min_obs_time) AS lo, least(TIMESTAMP '2001-10-10', max_obs_time + INTERVAL 1 SECOND) AS hi FROM spans WHERE greatest(TIMESTAMP '1995-01-20', min_obs_time) < least(TIMESTAMP '2001-10-10', max_obs_time + INTERVAL 1 SECOND)", "spans"))
def clip_windows(spark, d):
    w = times.clip_window(F.lit("1995-01-20").cast("timestamp_ntz"), F.lit("2001-10-10").cast("timestamp_ntz"), F.col("min_obs_time"), F.col("max_obs_time"))
    return v.spans(spark, d).select("station_id", w.alias("w")).where("w is not null").select("station_id", "w.lo", "w.hi")


@query(sql("""SELECT station_id, CAST(row_number() OVER (PARTITION BY station_id ORDER BY y) - 1 AS INTEGER) AS chunk, greatest(lo, make_timestamp(y, 1, 1, 0, 0, 0)) AS lo, least(hi, make_timestamp(y + 2, 1, 1, 0, 0, 0)) AS hi,
    row_number() OVER (PARTITION BY station_id ORDER BY y) = 1 AS inclusive FROM (SELECT station_id, lo, hi, unnest(range((year(lo) // 2) * 2, year(hi) + 1, 2)) AS y FROM
    (SELECT station_id, greatest(TIMESTAMP '1995-06-01', min_obs_time) AS lo, least(TIMESTAMP '2001-01-01', max_obs_time + INTERVAL 1 SECOND) AS hi FROM spans) WHERE lo < hi) WHERE greatest(lo, make_timestamp(y, 1, 1, 0, 0, 0)) < least(hi, make_timestamp(y + 2, 1, 1, 0, 0, 0))""", "spans"))
def chunk_windows(spark, d):
    return wk.backfill_work(v.spans(spark, d), "1995-06-01", "2001-01-01", 2)


def _states(spark, d):
    """Two writers' states of each user, from events."""
    e = v.table(spark, d, "events")
    return e.groupBy(F.col("user_id").cast("int").alias("station_id"), (F.col("event_id") % 2).alias("w")).agg(
        F.max("ts").alias("watermark"), F.max(F.when(F.col("event_id") % 3 == 0, F.col("ts"))).alias("last_attempt_at"), F.count("*").alias("rows_fetched_total"), (F.count("*") % 25).cast("int").alias("consecutive_failures")
    ).drop("w")


_STATES = "states AS (SELECT CAST(user_id AS INTEGER) AS station_id, max(ts) AS watermark, max(CASE WHEN event_id % 3 = 0 THEN ts END) AS last_attempt_at, count(*) AS rows_fetched_total, CAST(count(*) % 25 AS INTEGER) AS consecutive_failures FROM events GROUP BY 1, event_id % 2)"


@query(f"WITH {_STATES} SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY watermark DESC NULLS LAST, last_attempt_at DESC NULLS LAST) AS r FROM states) WHERE r = 1")
def watermark_merge(spark, d):
    return st.merge_marks(_states(spark, d))


@query(sql("SELECT s.station_id, w.after FROM spans s LEFT JOIN (SELECT CAST(user_id AS INTEGER) AS station_id, max(ts) - INTERVAL 30 DAY AS after FROM events GROUP BY 1) w USING (station_id)", "spans"))
def append_windows(spark, d):
    return wk.append_work(v.spans(spark, d), st.merge_marks(_states(spark, d)), 30)


@query(sql(f"SELECT station_id FROM spans WHERE floor(date_diff('second', max_obs_time, TIMESTAMP '2001-12-01') / 86400.0) <= 60 AND station_id NOT IN (SELECT station_id FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY watermark DESC NULLS LAST, last_attempt_at DESC NULLS LAST) AS r FROM states) WHERE r = 1 AND consecutive_failures >= 10)", "spans").replace("WITH RECURSIVE ", f"WITH RECURSIVE {_STATES}, "))
def append_targets(spark, d):
    return wk.append_targets(v.spans(spark, d), st.merge_marks(_states(spark, d)), "2001-12-01", 60).select("station_id")


_FOLD = """folded AS (SELECT station_id, max(CASE WHEN status = 'ok' THEN max_time END) AS watermark, max(tried) AS last_attempt_at, max(CASE WHEN status = 'ok' THEN tried END) AS last_success_at,
    CAST(coalesce(sum(CASE WHEN status = 'ok' THEN rows END), 0) AS BIGINT) AS rows_fetched_total,
    CAST(count(*) FILTER (status <> 'ok' AND (last_ok IS NULL OR tried > last_ok)) AS INTEGER) AS consecutive_failures, arg_max(error, (tried, error)) AS error
    FROM (SELECT *, max(CASE WHEN status = 'ok' THEN tried END) OVER (PARTITION BY station_id) AS last_ok FROM attempts) GROUP BY station_id)"""


def _folded(spark, d):
    empty = spark.createDataFrame([], "station_id long, watermark timestamp_ntz, last_attempt_at timestamp_ntz, last_success_at timestamp_ntz, rows_fetched_total bigint, consecutive_failures int, last_error string")
    return st.fold_attempts(empty, v.attempts(spark, d))


@query(sql("SELECT station_id, watermark, last_attempt_at, last_success_at, rows_fetched_total, consecutive_failures, CASE WHEN consecutive_failures > 0 THEN error END AS last_error FROM folded", "attempts").replace(" SELECT station_id, watermark", f", {_FOLD} SELECT station_id, watermark", 1))
def attempts_fold(spark, d):
    return _folded(spark, d)


@query(sql("SELECT station_id, consecutive_failures, consecutive_failures >= 3 AS quarantined FROM folded WHERE consecutive_failures > 0 ORDER BY consecutive_failures DESC, station_id LIMIT 25", "attempts").replace(" SELECT station_id, consecutive", f", {_FOLD} SELECT station_id, consecutive", 1))
def quarantine_topk(spark, d):
    return st.worst_stations(_folded(spark, d), 25, 3).select("station_id", "consecutive_failures", "quarantined")


@query(sql("SELECT CAST(sum(rows) AS BIGINT) AS rows, count(*) AS attempts, count(*) FILTER (status <> 'ok') AS failures, count(*) FILTER (status <> 'ok')::DOUBLE / count(*) AS failure_share, count(*) FILTER (status <> 'ok')::DOUBLE / count(*) > 0.1 AS flagged FROM attempts", "attempts"))
def run_summary(spark, d):
    return st.run_summary(v.attempts(spark, d))


# geo


@query(sql("""cells AS (SELECT station_id, CAST(trunc((lon + 180) / 360 * 65535) AS BIGINT) AS x, CAST(trunc((lat + 90) / 180 * 65535) AS BIGINT) AS y FROM stations),
    steps AS (SELECT station_id, x, y, CAST(0 AS BIGINT) AS h, 15 AS k FROM cells
      UNION ALL SELECT station_id, CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN s - 1 - y & (s - 1) ELSE y & (s - 1) END ELSE x & (s - 1) END, CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN s - 1 - x & (s - 1) ELSE x & (s - 1) END ELSE y & (s - 1) END, h + s * s * xor(3 * rx, ry), k - 1
      FROM (SELECT *, (x >> k) & 1 AS rx, (y >> k) & 1 AS ry, (CAST(1 AS BIGINT) << k) AS s FROM steps WHERE k >= 0))
    SELECT station_id, h AS hilbert FROM steps WHERE k = -1""", "stations").replace(") cells AS", "), cells AS", 1).replace("s - 1 - y & (s - 1)", "s - 1 - (y & (s - 1))").replace("s - 1 - x & (s - 1)", "s - 1 - (x & (s - 1))"))
def hilbert_order(spark, d):
    return v.stations(spark, d).select("station_id", geo.hilbert_key(F.col("lon"), F.col("lat")).alias("hilbert")).orderBy(F.col("hilbert").isNull(), "hilbert", "station_id")


# manifest and gate


@query(sql("SELECT count(*) AS files, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(file_bytes) AS BIGINT) AS bytes, round(sum(file_bytes)::DOUBLE / sum(rows), 3) AS bytes_per_row, min(obs_time_min) AS first_time, max(obs_time_max) AS last_time FROM manifest", "manifest"))
def manifest_summary(spark, d):
    return mf.summarize(v.manifest(spark, d))


@query(sql("SELECT period, CAST(sum(file_bytes) AS BIGINT) AS bytes FROM manifest GROUP BY period HAVING sum(file_bytes) < (SELECT avg(b) FROM (SELECT sum(file_bytes) AS b FROM manifest GROUP BY period))", "manifest"))
def under_floor(spark, d):
    manifest = v.manifest(spark, d)
    mean = mf.by_period(manifest).agg(F.avg("bytes")).first()[0] or 0
    return mf.under_floor(manifest, mean)


@query(sql("SELECT path, period FROM (SELECT 'period=' || period || '/' || file || '.parquet' AS path, period, obs_time_min, obs_time_max, s0, s1 FROM manifest JOIN (SELECT period, station_id % 4 AS file, min(station_id) AS s0, max(station_id) AS s1 FROM placed GROUP BY 1, 2) USING (period, file)) WHERE s0 <= 5 AND s1 >= 2 AND obs_time_min < TIMESTAMP '1999-01-01' AND obs_time_max >= TIMESTAMP '1998-01-01'", "manifest"))
def files_meeting(spark, d):
    return tables.files_meeting(v.manifest(spark, d), 2, 5, "1998-01-01", "1999-01-01").select("path", "period")


@query(sql("SELECT station_id, count(*) AS rows FROM obs WHERE station_id NOT IN (SELECT station_id FROM stations WHERE network_id < 20) GROUP BY 1", "obs", "stations"))
def unknown_stations(spark, d):
    return mf.unknown_references(v.observations(spark, d), v.stations(spark, d).where("network_id < 20"), "station_id")


@query("SELECT 'station_id' AS column, count(*) AS nulls FROM lineitem WHERE l_linenumber = 7 HAVING count(*) > 0 UNION ALL SELECT 'variable_id', count(*) FROM lineitem WHERE l_quantity < 3 HAVING count(*) > 0")
def null_keys(spark, d):
    rows = v.observations(spark, d)
    return mf.null_keys(rows.withColumns({"station_id": F.when(F.col("variable_id") != 7, F.col("station_id")), "variable_id": F.when(F.col("value") >= 3, F.col("variable_id"))}))


@query(sql("SELECT DISTINCT freq FROM histories WHERE freq IS NOT NULL", "histories"))
def frequency_vocabulary(spark, d):
    return sinks.frequencies(v.histories(spark, d))


@query(sql("SELECT station_id, count(*) AS rows FROM obs WHERE station_id IN (SELECT station_id FROM attempts WHERE status = 'ok') GROUP BY 1", "obs", "attempts"))
def accepted_rows(spark, d):
    kept = st.accepted_rows(v.observations(spark, d), v.attempts(spark, d), keep_partial=False)
    return kept.groupBy("station_id").agg(F.count("*").alias("rows"))


@query(sql("SELECT period, rows AS rows_before, coalesce(b.n, 0) AS rows_delta, c.n AS rows_after FROM (SELECT period, count(*) AS rows FROM placed GROUP BY 1) a LEFT JOIN (SELECT l.period, count(*) AS n FROM deltas d JOIN layout l ON year(d.obs_time) BETWEEN l.start_year AND l.end_year GROUP BY 1) b USING (period) JOIN (SELECT period, count(*) AS n FROM (SELECT DISTINCT period, station_id, variable_id, obs_time FROM placed) GROUP BY 1) c USING (period)", "placed", "deltas"))
def compact_stats(spark, d):
    layout = v.layout(spark, d)
    deltas = lo.with_period(v.deltas(spark, d), layout)
    after = lo.with_period(mg.merged(v.observations(spark, d), v.deltas(spark, d)), layout)
    return mg.compact_stats(_placed(spark, d), after, deltas)


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 4 = 3 AND l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'")
def shard_and_range(spark, d):
    rows = an.between(v.table(spark, d, "lineitem"), "1996-01-01", "1997-01-01", "l_shipdate")
    return rows.where(wk.in_shard(3, 4, "l_orderkey")).select("l_orderkey", "l_linenumber")


@query(sql("SELECT variable_id, obs_time, station_id, value, CAST(year(obs_time) AS VARCHAR) AS period FROM (SELECT *, row_number() OVER (PARTITION BY station_id, variable_id, obs_time ORDER BY value DESC) AS r FROM obs) WHERE r = 1", "obs"))
def repartition_yearly(spark, d):
    own = v.observations(spark, d).withColumn("period", F.year("obs_time").cast("string"))
    manifest = own.groupBy("period").agg(F.count("*").alias("rows"), F.min("obs_time").alias("obs_time_min"), F.max("obs_time").alias("obs_time_max"))
    return rp.repartitioned(own.drop("period"), manifest, lo.yearly_layout(spark, 1990, 2005))


@query(sql("SELECT period AS written, CAST(min(year(obs_time)) AS INTEGER) AS lo, CAST(max(year(obs_time)) AS INTEGER) AS hi, CASE WHEN min(year(obs_time)) = max(year(obs_time)) THEN 'keep' ELSE 'refuse' END AS action FROM placed GROUP BY period", "placed"))
def repartition_plan(spark, d):
    manifest = v.manifest(spark, d).groupBy("period").agg(F.min("obs_time_min").alias("obs_time_min"), F.max("obs_time_max").alias("obs_time_max"))
    return rp.plan_moves(manifest, lo.yearly_layout(spark, 1990, 2005)).select("written", "lo", "hi", "action")
