"""Last-write-wins merging, duplicate keys and sort order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.times import start_of_year
from ..schema import KEYS, struct
from .layout import with_period

#: The stamp of rows that are already in the archive, so that any delta is newer.
BASE_STAMP = "1970-01-01 00:00:00"


def latest(rows: DataFrame, keys: list[str] = KEYS, order: list[str] | None = None) -> DataFrame:
    """One row of each key, the last by `order` and then by the other columns, so ties are settled.

    Partial maxima are made before the shuffle.
    """
    order = order or ["ingested_at"]
    rest = [c for c in rows.columns if c not in keys and c not in order]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__row"))
    return best.select(*keys, *[F.col("__row")[c].alias(c) for c in [*order, *rest]]).select(*rows.columns)


def empty(spark, ddl: str) -> DataFrame:
    return spark.createDataFrame([], struct(ddl))


def merged(base: DataFrame, deltas: DataFrame | None, years: tuple[int, int] | None = None) -> DataFrame:
    """base with its deltas: of each key the newest ingested_at, in key order's columns.

    Deltas may be limited to years; base rows are never. Nothing is deleted.
    """
    plain = lambda rows: rows.select(F.col("station_id").cast("int").alias("station_id"), F.col("variable_id").cast("smallint").alias("variable_id"), "obs_time", "value")
    if deltas is None:  # all stamps are one: the largest value, by hash instead of by sorting
        return plain(base.groupBy(*KEYS).agg(F.max("value").alias("value")))
    old = base.select(*KEYS, "value").withColumn("ingested_at", F.lit(BASE_STAMP).cast("timestamp_ntz"))
    new = deltas.select(*KEYS, "value", "ingested_at")
    if years:
        lo, hi = start_of_year(F.lit(years[0])), start_of_year(F.lit(years[1] + 1))
        new = new.where((F.col("obs_time") >= lo) & (F.col("obs_time") < hi))
    return plain(latest(old.unionByName(new)))


def touched_periods(deltas: DataFrame, layout: DataFrame) -> DataFrame:
    """period labels that deltas have rows for."""
    years = deltas.select(F.make_timestamp_ntz(F.year("obs_time"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("obs_time")).distinct()
    return with_period(years, layout).select("period").distinct()


def compact(base: DataFrame, deltas: DataFrame, layout: DataFrame) -> DataFrame:
    """The new rows of every touched period, with their period; other periods are not read.

    base carries its partition column period.
    """
    touched = touched_periods(deltas, layout)
    old = base.join(F.broadcast(touched), "period", "left_semi")
    return with_period(merged(old, deltas), layout)


def compact_stats(before: DataFrame, after: DataFrame, deltas: DataFrame) -> DataFrame:
    """period, rows_before, rows_delta, rows_after of tables that carry period."""
    counted = [d.groupBy("period").agg(F.count("*").alias(n)) for d, n in ((before, "rows_before"), (deltas, "rows_delta"), (after, "rows_after"))]
    out = counted[0].join(counted[1], "period", "full_outer").join(counted[2], "period", "full_outer")
    return out.na.fill(0)


def duplicate_keys(rows: DataFrame, by: list[str], keys: list[str] = KEYS) -> DataFrame:
    """by, extra_rows: rows beyond the first of each key."""
    repeated = rows.groupBy(*by, *keys).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.groupBy(*by).agg(F.sum(F.col("n") - 1).alias("extra_rows"))


def sort_violations(rows: DataFrame, by: list[str], position: str | Column, keys: list[str] = KEYS) -> DataFrame:
    """by, violations: rows whose key is below that of the row before them in the same file or group."""
    w = W.partitionBy(*by).orderBy(position)
    key = F.struct(*keys)
    marked = rows.select(*by, (key < F.lag(key).over(w)).alias("down"))
    return marked.where("down").groupBy(*by).agg(F.count("*").alias("violations"))
