"""Which stations to fetch, and which windows of time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import chunk_windows, clip_window, plus_seconds, start_of_year, whole_days
from .state import QUARANTINE_AFTER


def in_shard(shard: int, shards: int, id: str = "station_id"):
    return F.pmod(F.col(id), F.lit(shards)) == shard


def backfill_targets(stations: DataFrame, start_year: int, end_year: int, networks: list[str] | None = None, shard: int = 0, shards: int = 1) -> DataFrame:
    """Stations of the networks (none: all) and the shard whose span meets the years, by id."""
    lo, hi = start_of_year(F.lit(start_year)), start_of_year(F.lit(end_year + 1))
    own = stations.where((F.col("max_obs_time") >= lo) & (F.col("min_obs_time") < hi) & in_shard(shard, shards))
    return (own.where(F.col("network_name").isin(networks)) if networks else own).orderBy("station_id")


def append_targets(stations: DataFrame, state: DataFrame, now, active_days: int, quarantine_after: int = QUARANTINE_AFTER) -> DataFrame:
    """Stations that reported within active_days and are not in quarantine."""
    bad = state.where(F.col("consecutive_failures") >= quarantine_after).select("station_id")
    return stations.where(whole_days(F.lit(now).cast("timestamp_ntz"), F.col("max_obs_time")) <= active_days).join(bad, "station_id", "left_anti")


def backfill_work(targets: DataFrame, lo, hi, chunk_years: int) -> DataFrame:
    """station_id, chunk, lo, hi, inclusive: a row a request. Windows lie in the station's span, cut at calendar years."""
    window = clip_window(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz"), F.col("min_obs_time"), F.col("max_obs_time"))
    clipped = targets.select("station_id", window.alias("w")).where(F.col("w").isNotNull()).select("station_id", "w.lo", "w.hi")
    cut = clipped.select("station_id", F.posexplode(chunk_windows(F.col("lo"), F.col("hi"), chunk_years)).alias("chunk", "w"))
    return cut.select("station_id", "chunk", "w.lo", "w.hi", (F.col("chunk") == 0).alias("inclusive"))


def append_work(targets: DataFrame, state: DataFrame, revision_days: int) -> DataFrame:
    """station_id, after: times after this one are asked for, revision_days before the mark; null asks for all."""
    marks = state.select("station_id", "watermark")
    return targets.join(marks, "station_id", "left").select("station_id", (F.col("watermark") - F.make_dt_interval(F.lit(revision_days))).alias("after"))


def exclusive_bound(time):
    """What to ask a service for that knows only "later than", to have this time too."""
    return plus_seconds(time, -1)
