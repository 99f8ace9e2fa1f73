"""Period labels, paths, ids in URIs and small conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Observations a day by frequency. "irregular", others and null count as 24.
OBS_PER_DAY = {"1-hourly": 24.0, "hourly": 24.0, "daily": 1.0, "12-hourly": 2.0, "semidaily": 2.0, "15-minute": 96.0, "5-minute": 288.0, "1-minute": 1440.0, "irregular": 24.0}
DEFAULT_PER_DAY = 24.0
#: Cells that mean "no value".
NULL_TOKENS = ["None", "", "NaN", "nan", "-9999", "-9999.0"]


def period_label(start: Column, end: Column) -> Column:
    return F.when(start == end, start.cast("string")).otherwise(F.concat_ws("-", start.cast("string"), end.cast("string")))


def period_years(label: Column) -> Column:
    """struct(start_year, end_year) of a label."""
    return F.struct(F.split_part(label, F.lit("-"), F.lit(1)).cast("int").alias("start_year"), F.coalesce(F.nullif(F.split_part(label, F.lit("-"), F.lit(2)), F.lit("")), F.split_part(label, F.lit("-"), F.lit(1))).cast("int").alias("end_year"))


def path_period(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"period=([^/]+)", 1), F.lit(""))


def uri_id(uri: Column) -> Column:
    return F.nullif(F.regexp_extract(F.regexp_replace(uri, "/+$", ""), r"([^/]+)$", 1), F.lit("")).try_cast("int")


def per_day(frequency: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in OBS_PER_DAY.items() for x in pair])
    return F.coalesce(F.try_element_at(table, frequency), F.lit(DEFAULT_PER_DAY))


def size_or_zero(values: Column) -> Column:
    return F.coalesce(F.when(values.isNotNull(), F.size(values)), F.lit(0))


def number_or_null(cell: Column, kind: str = "double") -> Column:
    return F.when(~cell.isin(NULL_TOKENS), cell.try_cast(kind))


def short_error(text: Column, most: int = 500) -> Column:
    return F.substring(text, 1, most)


def bytes_per_row(size: Column, rows: Column) -> Column:
    return F.try_divide(size.cast("double"), rows)


#: Fixed value: what a multihash of SHA-256 begins with, in hex: 12 (sha2-256), 20 (32 bytes).
MULTIHASH_SHA256 = "1220"


def multihash(content: Column) -> Column:
    """The SHA-256 of a column of bytes as a multihash in hex."""
    return F.concat(F.lit(MULTIHASH_SHA256), F.sha2(content, 256))
