"""Estimates of volume: rows and bytes by year, arrival rate, cadence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import per_day, size_or_zero
from ..functions.times import start_of_year, whole_days
from .layout import plan_periods, yearly_layout

#: Measured bytes a row, and how far estimates from metadata are above what is measured.
BYTES_PER_ROW = 1.4
ESTIMATE_SCALE = 1 / 1.84


def measured_year_rows(rows: DataFrame, time: str = "obs_time") -> DataFrame:
    """year, rows."""
    return rows.groupBy(F.year(time).alias("year")).agg(F.count("*").alias("rows"))


def estimated_year_rows(histories: DataFrame, start: int, end: int, scale: float = ESTIMATE_SCALE) -> DataFrame:
    """year, rows expected from each history's frequency, variables and span, scaled and truncated."""
    spans = histories.where(F.col("min_obs_time").isNotNull() & F.col("max_obs_time").isNotNull()).select(
        "min_obs_time", "max_obs_time", per_day(F.col("freq")).alias("per_day"), size_or_zero(F.col("variable_ids")).alias("n")
    )
    first, last = F.greatest(F.year("min_obs_time"), F.lit(start)), F.least(F.year("max_obs_time"), F.lit(end))
    years = spans.where((first <= last) & (F.col("n") > 0)).select("*", F.explode(F.sequence(first, last)).alias("year"))
    lo, hi = F.greatest("min_obs_time", start_of_year(F.col("year"))), F.least("max_obs_time", start_of_year(F.col("year") + 1))
    days = F.greatest(whole_days(hi, lo), F.lit(0))
    rows = (F.col("per_day") * F.col("n") * days).cast("bigint")
    return years.groupBy("year").agg((F.sum(rows) * scale).cast("bigint").alias("rows"))


def year_bytes(estimated: DataFrame, measured: DataFrame, measured_rate: float | None, default_rate: float = BYTES_PER_ROW) -> DataFrame:
    """year, bytes: measured rows at the measured rate where there are any, else estimated rows at the default rate.

    A rate of None or 0 is the default. Measured years outside the estimate are added.
    """
    e, m = estimated.withColumnRenamed("rows", "estimated"), measured.withColumnRenamed("rows", "measured")
    both = e.join(m, "year", "full_outer")
    return both.select(
        "year",
        F.when(F.col("measured").isNotNull(), F.col("measured") * float(measured_rate or default_rate)).otherwise(F.col("estimated") * default_rate).cast("bigint").alias("bytes"),
    )


def active_histories(histories: DataFrame, as_of, active_days: int) -> DataFrame:
    return histories.where((whole_days(F.lit(as_of).cast("timestamp_ntz"), F.col("max_obs_time")) <= active_days) & (size_or_zero(F.col("variable_ids")) > 0))


def arrival_rate(histories: DataFrame, as_of, active_days: int, by: list[str] | None = None) -> DataFrame:
    """active_histories, variable_slots, obs_per_day, of the whole table or by a key."""
    n = size_or_zero(F.col("variable_ids"))
    return (
        active_histories(histories, as_of, active_days)
        .groupBy(*(by or []))
        .agg(F.count("*").alias("active_histories"), F.coalesce(F.sum(n), F.lit(0)).alias("variable_slots"), F.coalesce(F.sum(per_day(F.col("freq")) * n), F.lit(0.0)).alias("obs_per_day"))
    )


def active_by_frequency(histories: DataFrame, as_of, active_days: int) -> DataFrame:
    return active_histories(histories, as_of, active_days).groupBy(F.coalesce("freq", F.lit("None")).alias("freq")).agg(F.count("*").alias("histories"))


def cadence(rates: DataFrame, rate: float = BYTES_PER_ROW, floor_bytes: float = 128 << 20, target_bytes: float = 256 << 20) -> DataFrame:
    """rates (…, obs_per_day, freshness_hours) with bytes_per_day, days_to_floor, days_to_target, append_every, compact_every.

    Without arrivals the days are infinite and the last tier holds.
    """
    per_day_bytes = F.col("obs_per_day") * rate
    days = lambda size: F.when(per_day_bytes > 0, F.lit(float(size)) / per_day_bytes).otherwise(F.lit(float("inf")))
    return (
        rates.withColumn("bytes_per_day", per_day_bytes)
        .withColumn("days_to_floor", days(floor_bytes))
        .withColumn("days_to_target", days(target_bytes))
        .withColumn("append_every", F.when(F.col("freshness_hours") <= 1, "hourly").when(F.col("freshness_hours") <= 6, "6-hourly").otherwise("daily"))
        .withColumn("compact_every", F.when(F.col("days_to_floor") <= 7, "weekly").when(F.col("days_to_floor") <= 31, "monthly").otherwise("quarterly"))
    )


def planned_sizes(histories: DataFrame, measured: DataFrame, start: int, end: int, measured_rate: float | None = None, ignore_manifest: bool = False) -> DataFrame:
    """year, bytes that a plan goes by: what is measured, and estimates where nothing is."""
    known = measured.limit(0) if ignore_manifest else measured
    return year_bytes(estimated_year_rows(histories, start, end), known, measured_rate)


def layout_run(histories: DataFrame, manifest: DataFrame, measured: DataFrame, start: int, end: int, min_bytes: float, ignore_manifest: bool = False, recut: bool = False) -> tuple[DataFrame, DataFrame]:
    """(plan, report) of an archive with this manifest: a layout that keeps its cuts unless recut, by the bytes a row that its files have.

    report has a row a period that is planned or written: period, planned_bytes,
    written, orphan. Orphans are written, but no plan has them; rows of their years go to
    other periods, so they have to be moved.
    """
    from .layout import planned_bytes
    from .manifest import last_data_year

    rate = manifest.agg(F.try_divide(F.sum("file_bytes").cast("double"), F.sum("rows"))).first()[0]  # one number
    ends = last_data_year(manifest).select("year").where("year is not null")
    plan = full_plan(histories, measured, start, end, min_bytes, rate, None if ignore_manifest else ends, ignore_manifest, recut)
    report = layout_report(plan, planned_bytes(plan, planned_sizes(histories, measured, start, end, rate, ignore_manifest)), manifest)
    return plan, report


def layout_report(plan: DataFrame, planned: DataFrame, written: DataFrame) -> DataFrame:
    """period, planned_bytes, written, orphan of every period that is planned or written (period)."""
    own = plan.select("period").distinct().withColumn("planned", F.lit(True)).join(planned.select("period", F.col("bytes").alias("planned_bytes")), "period", "left")
    here = written.select("period").distinct().withColumn("here", F.lit(True))
    return own.join(here, "period", "full_outer").select("period", "planned_bytes", F.coalesce("here", F.lit(False)).alias("written"), F.col("planned").isNull().alias("orphan"))


def full_plan(
    histories: DataFrame, measured: DataFrame, start: int, end: int, min_bytes: float, measured_rate: float | None = None,
    written_ends: DataFrame | None = None, ignore_manifest: bool = False, recut: bool = False,
) -> DataFrame:
    """A layout from estimates and what is measured; yearly where neither knows a year.

    Existing cuts are kept unless recut; ignore_manifest plans from estimates alone.
    """
    from .layout import allowed_cuts

    spark = histories.sparkSession
    sizes = planned_sizes(histories, measured, start, end, measured_rate, ignore_manifest)
    cuts = None if recut or written_ends is None else allowed_cuts(written_ends, end)
    plan = plan_periods(sizes, min_bytes, cut_after=cuts)
    return yearly_layout(spark, start, end).withColumn("bytes", F.lit(0.0)) if plan.isEmpty() else plan
