"""The driver's tables in the shapes of the archive's tables, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layout import plan_periods
from ..operators.analytics import small
from ..operators.planning import measured_year_rows
from ..sources.scratch import scratch

ROW_BYTES = 40.0
FLOOR_SHARE = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by(*keys):
    from pyspark.sql import Window as W

    return W.partitionBy(*keys)


def observations(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("station_id"), F.col("l_linenumber").cast("smallint").alias("variable_id"), F.col("l_shipdate").alias("obs_time"), F.col("l_quantity").alias("value")
    )


def networks(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("smallint").alias("network_id"), F.col("n_name").alias("network_name"))


def stations(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("station_id"), F.col("s_nationkey").cast("smallint").alias("network_id"), F.col("s_name").alias("station_name"),
        F.concat(F.lit("N"), F.col("s_suppkey").cast("string")).alias("native_id"), (F.lit(-140) + (F.col("s_suppkey") * 37 % 2600) / F.lit(100.0)).alias("lon"), (F.lit(48) + (F.col("s_suppkey") * 53 % 1200) / F.lit(100.0)).alias("lat"),
    )
    return s.join(small(networks(spark, sf_dir)), "network_id")


def variables(spark, sf_dir):
    n = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select("l_linenumber").distinct().select(
        n.cast("smallint").alias("variable_id"), F.concat(F.lit("v"), n.cast("string")).alias("name"),
        F.when(n % 3 == 0, "air_temperature").when(n % 3 == 1, "wind_speed").otherwise("precipitation").alias("standard_name"),
        F.when(n % 2 == 0, "time: point").otherwise("time: mean").alias("cell_method"),
    )


def year_bytes(spark, sf_dir):
    return measured_year_rows(observations(spark, sf_dir)).select("year", (F.col("rows") * ROW_BYTES).alias("bytes"))


def with_floor(sizes: DataFrame) -> DataFrame:
    from pyspark.sql import Window as W

    return sizes.withColumn("floor", F.sum("bytes").over(W.partitionBy(F.lit(1))) * FLOOR_SHARE)  # a row a year


def layout(spark, sf_dir):
    return plan_periods(with_floor(year_bytes(spark, sf_dir)), F.col("floor"))


def layout_file(spark, sf_dir):
    """The layout written and read as a file."""
    from ..sources.sinks import write_layout
    from ..sources.tables import layout as read

    path = scratch(spark, "layout")
    write_layout(layout(spark, sf_dir), path)
    return read(spark, path)


def histories(spark, sf_dir):
    """A history for each station and variable."""
    v = F.col("variable_id").cast("int")
    return observations(spark, sf_dir).groupBy("station_id", "variable_id").agg(F.min("obs_time").alias("min_obs_time"), F.max("obs_time").alias("max_obs_time")).select(
        "station_id", v.alias("variable_id"), "min_obs_time", "max_obs_time", F.when(v % 3 == 0, "daily").when(v % 3 == 1, "1-hourly").alias("freq"), F.sequence(F.lit(1), v).cast("array<smallint>").alias("variable_ids")
    )


def spans(spark, sf_dir):
    """stations with the span of what they reported."""
    span = observations(spark, sf_dir).groupBy("station_id").agg(F.min("obs_time").alias("min_obs_time"), F.max("obs_time").alias("max_obs_time"))
    return stations(spark, sf_dir).join(span, "station_id")


def deltas(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    return rows.select(
        F.col("l_suppkey").cast("int").alias("station_id"), F.col("l_linenumber").cast("smallint").alias("variable_id"), F.col("l_shipdate").alias("obs_time"), (F.col("l_quantity") * 1.1).alias("value"),
        (F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("l_orderkey") % 1000))).alias("ingested_at"),
    )


def manifest(spark, sf_dir):
    """A manifest of files as the archive would have: four to a period, by station."""
    from ..operators.layout import with_period

    rows = with_period(observations(spark, sf_dir), layout(spark, sf_dir)).withColumn("file", F.pmod("station_id", F.lit(4)))
    return rows.groupBy("period", "file").agg(
        F.count("*").alias("rows"), (F.count("*") * 7).alias("file_bytes"), F.lit(1).alias("row_groups"), F.min("station_id").alias("station_id_min"), F.max("station_id").alias("station_id_max"),
        F.min("obs_time").alias("obs_time_min"), F.max("obs_time").alias("obs_time_max"),
    ).withColumn("path", F.concat(F.lit("period="), "period", F.lit("/"), F.col("file").cast("string"), F.lit(".parquet")))


def attempts(spark, sf_dir):
    """events as attempts to fetch a station."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("station_id"), F.col("ts").alias("at"), "event_id", F.when(F.col("event_id") % 3 == 0, "ok").otherwise("error").alias("status"),
        F.col("ts").alias("max_time"), (F.col("event_id") % 100).alias("rows"), F.concat(F.lit("failed "), F.col("event_id").cast("string")).alias("error"),
    )


SQL = {
    "obs": "obs AS (SELECT CAST(l_suppkey AS INTEGER) AS station_id, CAST(l_linenumber AS SMALLINT) AS variable_id, l_shipdate AS obs_time, l_quantity AS value FROM lineitem)",
    "stations": """stations AS (SELECT CAST(s_suppkey AS INTEGER) AS station_id, CAST(s_nationkey AS SMALLINT) AS network_id, s_name AS station_name, 'N' || s_suppkey AS native_id,
        -140 + (s_suppkey * 37 % 2600) / 100.0::DOUBLE AS lon, 48 + (s_suppkey * 53 % 1200) / 100.0::DOUBLE AS lat, n_name AS network_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)""",
    "variables": """variables AS (SELECT DISTINCT CAST(l_linenumber AS SMALLINT) AS variable_id, 'v' || l_linenumber AS name,
        CASE l_linenumber % 3 WHEN 0 THEN 'air_temperature' WHEN 1 THEN 'wind_speed' ELSE 'precipitation' END AS standard_name,
        CASE l_linenumber % 2 WHEN 0 THEN 'time: point' ELSE 'time: mean' END AS cell_method FROM lineitem)""",
    "plan": """yb AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) * 40.0::DOUBLE AS bytes FROM lineitem GROUP BY 1),
        seq AS (SELECT year, bytes, {cut} AS may, row_number() OVER (ORDER BY year) AS i, (SELECT sum(bytes) * 0.3::DOUBLE FROM yb) AS floor FROM yb),
        walk AS (SELECT i, year AS start_year, year, bytes AS acc, bytes >= floor AND may AS filled FROM seq WHERE i = 1
            UNION ALL SELECT s.i, CASE WHEN w.filled THEN w.year + 1 ELSE w.start_year END, s.year, CASE WHEN w.filled THEN s.bytes ELSE w.acc + s.bytes END,
                CASE WHEN w.filled THEN s.bytes ELSE w.acc + s.bytes END >= s.floor AND s.may FROM walk w JOIN seq s ON s.i = w.i + 1),
        cuts AS (SELECT start_year, year AS end_year, acc AS bytes FROM walk WHERE filled),
        tail AS (SELECT start_year, year AS end_year, acc AS bytes FROM walk WHERE i = (SELECT max(i) FROM seq) AND NOT filled),
        planned AS (SELECT c.start_year, CASE WHEN c.end_year = (SELECT max(end_year) FROM cuts) THEN coalesce(t.end_year, c.end_year) ELSE c.end_year END AS end_year,
                c.bytes + CASE WHEN c.end_year = (SELECT max(end_year) FROM cuts) THEN coalesce(t.bytes, 0) ELSE 0 END AS bytes FROM cuts c LEFT JOIN tail t ON true
            UNION ALL SELECT * FROM tail WHERE NOT EXISTS (SELECT 1 FROM cuts)),
        layout AS (SELECT CASE WHEN start_year = end_year THEN CAST(start_year AS VARCHAR) ELSE start_year || '-' || end_year END AS period, start_year, end_year, bytes FROM planned)""",
    "placed": "placed AS (SELECT o.*, coalesce(l.period, CAST(year(o.obs_time) AS VARCHAR)) AS period FROM obs o LEFT JOIN layout l ON year(o.obs_time) BETWEEN l.start_year AND l.end_year)",
    "manifest": "manifest AS (SELECT period, station_id % 4 AS file, count(*) AS rows, count(*) * 7 AS file_bytes, min(obs_time) AS obs_time_min, max(obs_time) AS obs_time_max FROM placed GROUP BY 1, 2)",
    "histories": """histories AS (SELECT station_id, CAST(variable_id AS INTEGER) AS variable_id, min(obs_time) AS min_obs_time, max(obs_time) AS max_obs_time,
        CASE variable_id % 3 WHEN 0 THEN 'daily' WHEN 1 THEN '1-hourly' END AS freq, CASE variable_id % 3 WHEN 0 THEN 1.0::DOUBLE ELSE 24.0::DOUBLE END AS per_day FROM obs GROUP BY station_id, variable_id)""",
    "spans": "spans AS (SELECT s.*, o.min_obs_time, o.max_obs_time FROM stations s JOIN (SELECT station_id, min(obs_time) AS min_obs_time, max(obs_time) AS max_obs_time FROM obs GROUP BY 1) o USING (station_id))",
    "deltas": """deltas AS (SELECT CAST(l_suppkey AS INTEGER) AS station_id, CAST(l_linenumber AS SMALLINT) AS variable_id, l_shipdate AS obs_time, l_quantity * 1.1::DOUBLE AS value,
        TIMESTAMP '2020-01-01' + to_seconds(l_orderkey % 1000) AS ingested_at FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01')""",
    "attempts": """attempts AS (SELECT user_id AS station_id, ts AS tried, event_id, CASE event_id % 3 WHEN 0 THEN 'ok' ELSE 'error' END AS status, ts AS max_time, event_id % 100 AS rows, 'failed ' || event_id AS error FROM events)""",
}
_NEEDS = {"placed": ["obs", "plan"], "manifest": ["placed"], "histories": ["obs"], "spans": ["stations", "obs"]}


def sql(body: str, *views: str, cut: str = "true") -> str:
    """body after the views it names and those that they need."""
    wanted: list[str] = []

    def add(v):
        for n in _NEEDS.get(v, []):
            add(n)
        if v not in wanted:
            wanted.append(v)

    for v in views:
        add(v)
    return "WITH RECURSIVE " + ", ".join(SQL[v].replace("{cut}", cut) for v in wanted) + " " + body
