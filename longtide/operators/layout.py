"""Period layouts: years bucketed to a least size, rows labelled by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import period_label

_BUCKET = "array<struct<start_year:int,end_year:int,bytes:double>>"


def plan_periods(year_bytes: DataFrame, min_bytes: float | Column, by: list[str] | None = None, cut_after: DataFrame | None = None) -> DataFrame:
    """period, start_year, end_year, bytes of year_bytes (year, bytes), one plan for each value of `by`.

    Years are taken in order until a bucket has min_bytes; it then ends, at a year
    of cut_after (year) if that is given, and the next starts the year after, so
    years without data belong to the next bucket. What is left over at the end
    joins the bucket before it. The years of one plan, some hundreds, are folded
    as one array; plans are dealt out by `by`.
    """
    by = by or []
    rows = year_bytes.withColumn("__floor", F.lit(min_bytes) if not isinstance(min_bytes, Column) else min_bytes)
    if cut_after is None:
        rows = rows.withColumn("__cut", F.lit(True))
    else:
        rows = rows.join(F.broadcast(cut_after.select("year").distinct().withColumn("__cut", F.lit(True))), "year", "left").withColumn("__cut", F.coalesce("__cut", F.lit(False)))
    item = F.struct(F.col("year").cast("int").alias("year"), F.col("bytes").cast("double").alias("bytes"), "__cut")
    years = rows.groupBy(*by).agg(F.sort_array(F.collect_list(item)).alias("years"), F.max("__floor").cast("double").alias("floor"))

    def step(s, x):
        start = F.coalesce(s["start"], x["year"])
        size = s["size"] + x["bytes"]
        full = (size >= F.col("floor")) & x["__cut"]
        bucket = F.struct(start.alias("start_year"), x["year"].alias("end_year"), size.alias("bytes"))
        return F.struct(
            F.when(full, F.concat(s["done"], F.array(bucket))).otherwise(s["done"]).cast(_BUCKET).alias("done"),
            F.when(full, x["year"] + 1).otherwise(start).cast("int").alias("start"),
            F.when(full, F.lit(0.0)).otherwise(size).alias("size"),
            x["year"].alias("last"),
        )

    def finish(s):
        left = F.struct(s["start"].alias("start_year"), s["last"].alias("end_year"), s["size"].alias("bytes"))
        before = F.try_element_at(s["done"], F.lit(-1))
        merged = F.struct(before["start_year"].alias("start_year"), s["last"].alias("end_year"), (before["bytes"] + s["size"]).alias("bytes"))
        rest = F.slice(s["done"], F.lit(1), F.greatest(F.size(s["done"]) - 1, F.lit(0)))
        return (
            F.when(s["start"].isNull() | (s["start"] > s["last"]), s["done"])
            .when(F.size(s["done"]) == 0, F.array(left))
            .otherwise(F.concat(rest, F.array(merged)))
        )

    start = F.struct(
        F.array().cast(_BUCKET).alias("done"), F.lit(None).cast("int").alias("start"), F.lit(0.0).alias("size"), F.lit(None).cast("int").alias("last")
    )
    planned = years.select(*by, F.explode(F.aggregate("years", start, step, finish)).alias("p")).select(*by, "p.*")
    return planned.select(*by, period_label(F.col("start_year"), F.col("end_year")).alias("period"), "start_year", "end_year", "bytes")


def yearly_layout(spark: SparkSession, start: int, end: int) -> DataFrame:
    """A period for each year from start to end, both included."""
    year = F.col("id").cast("int")
    return spark.range(start, end + 1).select(year.cast("string").alias("period"), year.alias("start_year"), year.alias("end_year"))


def year_periods(layout: DataFrame) -> DataFrame:
    """year, period: a layout by year, some hundreds of rows whatever the archive holds."""
    return layout.select(F.explode(F.sequence("start_year", "end_year")).alias("year"), "period")


def with_period(rows: DataFrame, layout: DataFrame, time: str = "obs_time") -> DataFrame:
    """rows with the period that holds the year of their time; a year without one is its own label."""
    years = F.broadcast(year_periods(layout).withColumnRenamed("year", "__year").withColumnRenamed("period", "__period"))
    own = rows.withColumn("__year", F.year(time))
    return own.join(years, "__year", "left").withColumn("period", F.coalesce("__period", F.col("__year").cast("string"))).drop("__year", "__period")


def planned_periods(layout: DataFrame, lo: int, hi: int) -> DataFrame:
    """period of every planned period that meets the years lo..hi."""
    return layout.where((F.col("end_year") >= lo) & (F.col("start_year") <= hi)).select("period")


def periods_for_range(layout: DataFrame, lo: int, hi: int) -> DataFrame:
    """period labels of all years lo..hi in order, years without a plan under their own label."""
    years = layout.sparkSession.range(lo, hi + 1).select(F.col("id").cast("int").alias("year"))
    found = years.join(F.broadcast(year_periods(layout)), "year", "left").select(F.coalesce("period", F.col("year").cast("string")).alias("period"), "year")
    return found.groupBy("period").agg(F.min("year").alias("first_year")).orderBy("first_year")


def register_periods_for(spark: SparkSession, layout_view: str = "layout", name: str = "periods_for") -> None:
    """The SQL table function periods_for(lo, hi) over a view of a layout."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(lo INT, hi INT) RETURNS TABLE (period STRING) "
        f"RETURN SELECT l.period FROM {layout_view} l WHERE l.end_year >= {name}.lo AND l.start_year <= {name}.hi"
    )


def orphaned_periods(written: DataFrame, layout: DataFrame) -> DataFrame:
    """Written labels that no plan has."""
    return written.select("period").distinct().join(layout.select("period"), "period", "left_anti")


def allowed_cuts(written_ends: DataFrame, last_year: int) -> DataFrame:
    """year of every cut that moves no written period: their end years and all years after the last."""
    after = written_ends.agg(F.max("year").alias("last")).where(F.col("last") < last_year).select(F.explode(F.sequence(F.col("last") + 1, F.lit(last_year))).alias("year"))
    return written_ends.select("year").union(after).distinct()


def nesting(spans: DataFrame, layout: DataFrame) -> DataFrame:
    """written, lo, hi, period, verdict of spans (written, lo, hi): 'ok' if one period holds both ends.

    'straddles' if the ends lie in two periods, 'outside_plan' if one of them lies in none.
    """
    inside = layout.select("period", "start_year", "end_year")
    at = F.broadcast(inside)
    meets = F.col("lo").between(F.col("start_year"), F.col("end_year")) | F.col("hi").between(F.col("start_year"), F.col("end_year"))
    both = F.col("lo").between(F.col("start_year"), F.col("end_year")) & F.col("hi").between(F.col("start_year"), F.col("end_year"))
    found = spans.join(at, meets, "left").groupBy("written", "lo", "hi").agg(F.count("period").alias("n"), F.max(F.when(both, F.col("period"))).alias("period"))
    return found.select("written", "lo", "hi", "period", F.when(F.col("period").isNotNull(), "ok").when(F.col("n") > 1, "straddles").otherwise("outside_plan").alias("verdict"))


def planned_bytes(layout: DataFrame, year_bytes: DataFrame) -> DataFrame:
    """period, bytes: what each planned period will hold."""
    return year_bytes.join(F.broadcast(year_periods(layout)), "year").groupBy("period").agg(F.sum("bytes").alias("bytes"))
