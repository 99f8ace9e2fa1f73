"""Naive times: parsing, whole days, clipping and cutting of windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_naive(text: Column) -> Column:
    """An ISO time as it reads: a trailing Z or offset is dropped, not applied; null or empty is null."""
    return F.regexp_replace(F.nullif(F.trim(text), F.lit("")), r"(Z|[+-]\d{2}:?\d{2})$", "").try_cast("timestamp_ntz")


def strict_time(text: Column) -> Column:
    """%Y-%m-%d %H:%M:%S and nothing else, as NTZ; anything else is null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"), text.try_cast("timestamp_ntz"))


def seconds_between(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("SECOND", earlier, later)


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour days from earlier to later, rounded down, also for negative spans."""
    return F.floor(seconds_between(later, earlier) / 86400).cast("long")


def month(time: Column) -> Column:
    return F.date_trunc("month", time).cast("timestamp_ntz")


def start_of_year(year: Column) -> Column:
    return F.make_timestamp_ntz(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def plus_seconds(time: Column, seconds: int) -> Column:
    return time + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))


def clip_window(lo: Column, hi: Column, first: Column, last: Column) -> Column:
    """struct(lo, hi) of [lo, hi) within what the station has, [first, last + 1 s).

    A span that is not known leaves the window as it is; one that lies outside
    gives null. greatest and least skip nulls, hence the guard.
    """
    known = first.isNotNull() & last.isNotNull()
    a, b = F.greatest(lo, first), F.least(hi, plus_seconds(last, 1))
    return F.when(~known, F.struct(lo.alias("lo"), hi.alias("hi"))).when(a < b, F.struct(a.alias("lo"), b.alias("hi")))


def chunk_windows(lo: Column, hi: Column, years: int) -> Column:
    """array of struct(lo, hi) that cuts [lo, hi) at multiples of so many years; 0 years is one chunk."""
    if years <= 0:
        return F.when(lo < hi, F.array(F.struct(lo.alias("lo"), hi.alias("hi"))))
    first = (F.floor(F.year(lo) / years) * years).cast("int")
    cuts = F.transform(F.sequence(first, F.greatest(first, F.year(hi)), F.lit(years)), lambda y: F.struct(F.greatest(lo, start_of_year(y)).alias("lo"), F.least(hi, start_of_year(y + years)).alias("hi")))
    return F.filter(cuts, lambda w: w["lo"] < w["hi"])
