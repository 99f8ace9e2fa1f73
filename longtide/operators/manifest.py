"""The manifest of files and the gate of checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.labels import bytes_per_row, path_period
from ..schema import KEYS
from ..sources.sinks import MIN_BYTES, ROW_GROUP_ROWS
from .merge import duplicate_keys

PROBLEMS = "check string, subject string, detail string"


def build_manifest(footers: DataFrame, written_at) -> DataFrame:
    """A row a file: rows, bytes, row groups, and the least and largest station and time."""
    station, time = F.col("column") == "station_id", F.col("column") == "obs_time"
    groups = footers.groupBy("path", "file_bytes", "row_group").agg(
        F.max("rows").alias("rows"), F.min(F.when(station, F.col("min_int"))).alias("s0"), F.max(F.when(station, F.col("max_int"))).alias("s1"),
        F.min(F.when(time, F.col("min_time"))).alias("t0"), F.max(F.when(time, F.col("max_time"))).alias("t1"),
    )
    return groups.groupBy("path", "file_bytes").agg(
        F.sum("rows").alias("rows"), F.count("*").cast("int").alias("row_groups"), F.min("s0").cast("int").alias("station_id_min"), F.max("s1").cast("int").alias("station_id_max"),
        F.min("t0").alias("obs_time_min"), F.max("t1").alias("obs_time_max"),
    ).select("path", path_period(F.col("path")).alias("period"), "rows", "file_bytes", "row_groups", "station_id_min", "station_id_max", "obs_time_min", "obs_time_max", F.lit(written_at).cast("timestamp_ntz").alias("written_at"))


def summarize(manifest: DataFrame) -> DataFrame:
    """One row: files, rows, bytes, bytes_per_row, first and last time; zeros of an empty manifest."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    return manifest.agg(
        F.count("*").alias("files"), zero(F.sum("rows")).alias("rows"), zero(F.sum("file_bytes")).alias("bytes"),
        F.round(F.try_divide(F.sum("file_bytes").cast("double"), F.sum("rows")), 3).alias("bytes_per_row"), F.min("obs_time_min").alias("first_time"), F.max("obs_time_max").alias("last_time"),
    )


def by_period(manifest: DataFrame) -> DataFrame:
    """period, files, rows, bytes, bytes_per_row of each period."""
    out = manifest.groupBy("period").agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("file_bytes").alias("bytes"))
    return out.withColumn("bytes_per_row", F.round(bytes_per_row(F.col("bytes"), F.col("rows")), 3))


def last_data_year(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("period").agg(F.max(F.year("obs_time_max")).alias("year"))


def under_floor(manifest: DataFrame, floor: int = MIN_BYTES) -> DataFrame:
    """period, bytes of periods that are smaller than the floor, all their files together."""
    return manifest.groupBy("period").agg(F.sum("file_bytes").alias("bytes")).where(F.col("bytes") < floor)


def large_row_groups(footers: DataFrame, most: int = ROW_GROUP_ROWS) -> DataFrame:
    return footers.where(F.col("rows") > most).select("path", "row_group", "rows").distinct()


def schema_signatures(footers: DataFrame) -> DataFrame:
    """signature, files: more than one row is drift."""
    columns = footers.where("row_group = 0").groupBy("path").agg(F.concat_ws(", ", F.sort_array(F.collect_list(F.concat_ws(" ", "column", "type")))).alias("signature"))
    return columns.groupBy("signature").agg(F.count("*").alias("files"))


def unsorted_files(footers: DataFrame, column: str = "station_id") -> DataFrame:
    """path of files with a row group that begins below the end of the one before."""
    w = W.partitionBy("path").orderBy("row_group")
    own = footers.where(F.col("column") == column)
    return own.withColumn("before", F.lag("max_int").over(w)).where("min_int < before").select("path").distinct()


def null_keys(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """column, nulls of the key columns that have any."""
    counts = rows.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
    return counts.unpivot([], keys, "column", "nulls").where("nulls > 0")


def unknown_references(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """key values without a row in the dimension, and their rows."""
    return rows.groupBy(key).agg(F.count("*").alias("rows")).join(dimension.select(key).distinct(), key, "left_anti")


def verify(footers: DataFrame, manifest: DataFrame, rows: DataFrame | None, floor: int = MIN_BYTES, most_rows: int = ROW_GROUP_ROWS, duplicates: DataFrame | None = None) -> DataFrame:
    """check, subject, detail of every problem; no rows: all is well.

    Repeated keys are counted in rows (with period) by key, unless duplicates
    (period, extra_rows) are known already.
    """
    said = lambda d, check, subject, detail: d.select(F.lit(check).alias("check"), F.col(subject).cast("string").alias("subject"), detail.cast("string").alias("detail"))
    drift = schema_signatures(footers)
    parts = [
        said(under_floor(manifest, floor), "under_floor", "period", F.col("bytes")),
        said(large_row_groups(footers, most_rows), "row_group", "path", F.col("rows")),
        said(drift.withColumn("kinds", F.count("*").over(W.partitionBy(F.lit(1)))).where("kinds > 1"), "schema", "signature", F.col("files")),
        said(unsorted_files(footers), "unsorted", "path", F.lit("row groups overlap")),
        said(duplicate_keys(rows, ["period"]) if duplicates is None else duplicates, "duplicate_keys", "period", F.col("extra_rows")),
    ]
    return reduce(DataFrame.unionByName, parts)
