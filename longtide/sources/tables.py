"""Reading the archive's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.times import start_of_year
from ..operators.layout import periods_for_range
from ..operators.state import merge_marks
from . import versions


def observations(spark: SparkSession, root: str, value: str = "double") -> DataFrame:
    """All observations with period from the path.

    The schema is given: labels that all look like years would be read as numbers.
    Of an archive with versions the newest one's.
    """
    if versions.versioned(spark, root):
        return versions.observations(spark, root, value=value)
    return spark.read.schema(schema.observations(value)).parquet(f"{root}/observations")


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def delete(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def base_and_deltas(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Both by column name; columns that a file lacks are null."""
    return observations(spark, root), deltas(spark, root)


def deltas(spark: SparkSession, root: str) -> DataFrame:
    """All staged deltas."""
    if not exists(spark, f"{root}/deltas"):
        return spark.createDataFrame([], schema.struct(schema.DELTA))
    return spark.read.schema(schema.struct(schema.DELTA)).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{root}/deltas")


def none(spark: SparkSession) -> DataFrame:
    """Observations without rows."""
    return spark.createDataFrame([], schema.observations())


def layout(spark: SparkSession, path: str) -> DataFrame:
    """period, start_year, end_year of a JSON document with an array `periods`.

    Read as a file, so that a semi-join with it prunes partitions at run time. The
    layout.json of an archive whose versions have changed it is the newest one's.
    """
    if path.endswith("/layout.json"):
        path = versions.layout_path(spark, path.removesuffix("/layout.json"))
    doc = schema.struct(f"version int, periods array<struct<{schema.LAYOUT.replace(' string', ':string').replace(' int', ':int')}>>")
    return spark.read.schema(doc).option("multiLine", True).json(path).select(F.explode("periods").alias("p")).select("p.*")


def read_range(spark: SparkSession, root: str, lo_year: int, hi_year: int) -> DataFrame:
    """Observations of the years lo..hi with both predicates: the labels, which prune files, and the times."""
    labels = [r.period for r in periods_for_range(layout(spark, f"{root}/layout.json"), lo_year, hi_year).collect()]  # at most a label a year
    rows = observations(spark, root).where(F.col("period").isin(labels))
    return rows.where((F.col("obs_time") >= start_of_year(F.lit(lo_year))) & (F.col("obs_time") < start_of_year(F.lit(hi_year + 1))))


def dimension(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A dimension without its geometry columns, if it has any."""
    return spark.read.parquet(f"{root}/{name}").drop("geometry", "bbox")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """A row a file, by path; of an archive with versions the newest one's list."""
    if versions.versioned(spark, root):
        return versions.listed(spark, root).select(*[c.split()[0] for c in schema.MANIFEST.split(", ")])
    return spark.read.schema(schema.struct(schema.MANIFEST)).parquet(f"{root}/_manifest")


def state(spark: SparkSession, root: str) -> DataFrame:
    """The merged state of all writers, of each the newest that is published."""
    folders = [str(f.getPath().toString()) for f in versions.children(spark, f"{root}/_state") if f.isDirectory()]
    newest = [(f, versions.latest(spark, f)) for f in folders]
    paths = [f if n is None else f"{f}/{versions.describe(spark, f, n)['list']}" for f, n in newest]
    read = spark.read.schema(schema.struct(schema.STATE)).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return merge_marks(read.parquet(*paths) if paths else spark.createDataFrame([], schema.struct(schema.STATE)))


def union_all(tables: list[DataFrame], spark: SparkSession | None = None, ddl: str | None = None) -> DataFrame:
    """All rows by column name; of no tables an empty one of the schema."""
    if not tables:
        return spark.createDataFrame([], schema.struct(ddl))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def files_meeting(files: DataFrame, station_lo: int, station_hi: int, time_lo, time_hi) -> DataFrame:
    """Rows of a manifest whose file may hold stations lo..hi at times in [lo, hi)."""
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in (time_lo, time_hi))
    return files.where((F.col("station_id_min") <= station_hi) & (F.col("station_id_max") >= station_lo) & (F.col("obs_time_min") < hi) & (F.col("obs_time_max") >= lo))


def read_files_meeting(spark: SparkSession, root: str, station_lo: int, station_hi: int, time_lo, time_hi) -> DataFrame:
    """Observations of stations lo..hi at times in [lo, hi) from the files that the manifest names for them."""
    found = files_meeting(manifest(spark, root), station_lo, station_hi, time_lo, time_hi)
    paths = [r.path for r in found.select("path").collect()]  # the names of the files that are read
    if not paths:
        return spark.createDataFrame([], schema.observations())
    rows = spark.read.schema(schema.observations()).option("basePath", f"{root}/observations").parquet(*paths)
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in (time_lo, time_hi))
    return rows.where(F.col("station_id").between(station_lo, station_hi) & (F.col("obs_time") >= lo) & (F.col("obs_time") < hi))
