"""Dimensions from landed metadata documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import size_or_zero, uri_id
from ..functions.times import iso_naive
from .analytics import small


def networks(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("id").cast("smallint").alias("network_id"), F.col("name").alias("network_name"), "long_name", "color", "publish", "station_count")


def variables(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").cast("smallint").alias("variable_id"), uri_id(F.col("network_uri")).cast("smallint").alias("network_id"), "name", "display_name",
        "short_name", "standard_name", "cell_method", "unit", "precision", F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
    )


def station_rollup(raw: DataFrame, nets: DataFrame) -> DataFrame:
    """Stations from their nested histories.

    Span and variables of all histories, the rest of the most recent one (by
    max_obs_time as text; of equals the first). Stations without histories stay.
    """
    rows = raw.select("id", "native_id", uri_id(F.col("network_uri")).cast("smallint").alias("network_id"), F.posexplode_outer("histories").alias("pos", "h"))
    rank = F.struct(F.coalesce("h.max_obs_time", F.lit("")), -F.col("pos"))
    attributes = ("station_name", "lon", "lat", "elevation", "province", "freq")
    rolled = rows.groupBy("id").agg(
        F.first("native_id").alias("native_id"),
        F.first("network_id").alias("network_id"),
        F.max_by(F.struct(*[F.col(f"h.{a}").alias(a) for a in attributes]), rank).alias("recent"),
        F.min(iso_naive(F.col("h.min_obs_time"))).alias("min_obs_time"),
        F.max(iso_naive(F.col("h.max_obs_time"))).alias("max_obs_time"),
        F.count("h").cast("smallint").alias("history_count"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("h.variable_ids", F.array().cast("array<int>")))))).cast("array<smallint>").alias("variable_ids"),
    )
    named = rolled.join(small(nets.select("network_id", "network_name")), "network_id", "left")
    return named.select(F.col("id").alias("station_id"), "network_id", "network_name", "native_id", "recent.*", "min_obs_time", "max_obs_time", "history_count", "variable_ids")


def attach_histories(raw_histories: DataFrame, raw_stations: DataFrame, nets: DataFrame) -> DataFrame:
    """Flat histories with the station that nests them; those that no station has are left out, of several stations the last is taken."""
    owners = raw_stations.select(F.col("id").alias("station_id"), "native_id", uri_id(F.col("network_uri")).cast("smallint").alias("network_id"), F.explode("histories").alias("h"))
    owners = owners.groupBy(F.col("h.id").alias("id")).agg(F.max(F.struct("station_id", "native_id", "network_id")).alias("s")).select("id", "s.*")
    own = raw_histories.join(owners, "id").join(small(nets.select("network_id", "network_name")), "network_id", "left")
    return own.select(
        F.col("id").alias("history_id"), "station_id", "network_name", "native_id", "station_name", "lon", "lat", "elevation", "province", "country", "freq",
        F.col("tz_offset").cast("string").alias("tz_offset"), "sdate", "edate", iso_naive(F.col("min_obs_time")).alias("min_obs_time"), iso_naive(F.col("max_obs_time")).alias("max_obs_time"),
        F.when(size_or_zero(F.col("variable_ids")) > 0, F.col("variable_ids")).otherwise(F.array().cast("array<int>")).cast("array<smallint>").alias("variable_ids"),
    )
