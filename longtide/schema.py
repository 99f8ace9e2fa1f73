"""Schemas of the archive's tables. Times are naive local standard time: TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import types as T

KEYS = ["station_id", "variable_id", "obs_time"]

OBSERVATIONS = "station_id int, variable_id smallint, obs_time timestamp_ntz, value double"
DELTA = OBSERVATIONS + ", ingested_at timestamp_ntz"
NETWORKS = "network_id smallint, network_name string, long_name string, color string, publish boolean, station_count int"
VARIABLES = (
    "variable_id smallint, network_id smallint, name string, display_name string, short_name string, "
    "standard_name string, cell_method string, unit string, precision double, tags array<string>"
)
STATIONS = (
    "station_id int, network_id smallint, network_name string, native_id string, station_name string, "
    "lon double, lat double, elevation double, province string, freq string, min_obs_time timestamp_ntz, "
    "max_obs_time timestamp_ntz, history_count smallint, variable_ids array<smallint>"
)
HISTORIES = (
    "history_id int, station_id int, network_name string, native_id string, station_name string, lon double, "
    "lat double, elevation double, province string, country string, freq string, tz_offset string, sdate string, "
    "edate string, min_obs_time timestamp_ntz, max_obs_time timestamp_ntz, variable_ids array<smallint>"
)
STATE = (
    "station_id int, network_name string, native_id string, watermark timestamp_ntz, last_attempt_at timestamp_ntz, "
    "last_success_at timestamp_ntz, rows_fetched_total bigint, consecutive_failures smallint, last_error string"
)
MANIFEST = (
    "path string, period string, rows bigint, file_bytes bigint, row_groups int, station_id_min int, station_id_max int, "
    "obs_time_min timestamp_ntz, obs_time_max timestamp_ntz, written_at timestamp_ntz"
)
LAYOUT = "period string, start_year int, end_year int"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def observations(value: str = "double", period: bool = True) -> T.StructType:
    """Observations as stored; the value type is a parameter (double or float), period comes from the path."""
    ddl = OBSERVATIONS.replace("value double", f"value {value}")
    return struct(ddl + (", period string" if period else ""))
