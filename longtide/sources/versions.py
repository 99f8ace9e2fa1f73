"""Versions of an archive's files: a list in each, and a pointer that appears whole by one rename.

Below root, `observations` has the data files, `_versions/<number>.json` the
pointers and `_versions/lists` the lists, one table a version. A file that no
list names is not read. So an operation may stop anywhere: before its pointer is
there the old rows are read, from then on the new ones. Files that were replaced
go by vacuum, when no version that is kept names them.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema

#: name is the path below root/observations; then the manifest's columns, of the file as it was when it was listed, the first
#: and last row's key as whole numbers, and whether its keys ascend, each above the one before.
_KEY = "struct<station_id: bigint, variable_id: bigint, obs_time: bigint>"
LISTED = f"name string, modified bigint, {schema.MANIFEST}, first_key {_KEY}, last_key {_KEY}, in_order boolean"
_POINTER = re.compile(r"/(\d{12})\.json$")
COLUMNS = ["name", "modified", *[c.split()[0] for c in schema.MANIFEST.split(", ")], "first_key", "last_key", "in_order"]
#: Files of an operation say in their names which version they are for.
_OWN = r"(^|/)v\d{12}-[^/]*$"


#: Staged labels may have this and a number after them: a stretch of the period's keys that is written for itself.
STRETCH = "~"


class Conflict(RuntimeError):
    """Another writer has made the version first."""


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, folder: str) -> list:
    path, fs = _path(spark, folder)
    return list(fs.listStatus(path)) if fs.exists(path) else []


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    target, fs = _path(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    source, fs = _path(spark, path)
    stream = fs.open(source)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; an error if the target is there."""
    jvm = spark._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri(), spark._jsc.hadoopConfiguration()).rename(a, b, none)


def pointers(spark: SparkSession, root: str) -> list[int]:
    """The versions that are there, in order."""
    found = (_POINTER.search(str(f.getPath().toString())) for f in children(spark, f"{root}/_versions"))
    return sorted(int(m[1]) for m in found if m)


def latest(spark: SparkSession, root: str) -> int | None:
    numbers = pointers(spark, root)
    return numbers[-1] if numbers else None


def describe(spark: SparkSession, root: str, version: int) -> dict:
    """What a version's pointer says: version, list, operation, removed, and what the operation added."""
    return json.loads(_read_text(spark, f"{root}/_versions/{version:012d}.json"))


def listed(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The files of a version, the newest if none is given."""
    version = latest(spark, root) if version is None else version
    doc = describe(spark, root, version)
    return spark.read.schema(schema.struct(LISTED)).parquet(f"{root}/_versions/lists/{doc['list']}")


def publish(spark: SparkSession, root: str, version: int, doc: dict) -> None:
    """Make a version by one rename. Conflict if it is there already."""
    staged = f"{root}/_versions/staged-{uuid.uuid4().hex}"
    _write_text(spark, staged, json.dumps(doc | {"version": version}))
    try:
        move(spark, staged, f"{root}/_versions/{version:012d}.json")
    except Exception as e:
        path, fs = _path(spark, staged)
        fs.delete(path, False)
        if "FileAlreadyExists" in str(e):
            raise Conflict(f"version {version} of {root} is there already") from e
        raise


def data_files(spark: SparkSession, root: str) -> DataFrame:
    """name, path, file_bytes, modified of all data files, whatever lists they are in."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{root}/observations")
    name = F.regexp_extract("path", r"/observations/(.+)$", 1)
    return found.select(name.alias("name"), "path", F.col("length").alias("file_bytes"), F.unix_micros("modificationTime").alias("modified"))


def foreign_files(spark: SparkSession, root: str) -> DataFrame:
    """Data files that no operation has written or replaced: those that were there before there were versions, or were put there since."""
    found = data_files(spark, root).where(~F.col("name").rlike(_OWN))
    numbers = pointers(spark, root)
    if not numbers:
        return found
    removed = [name for n in numbers for name in describe(spark, root, n)["removed"]]
    gone = spark.createDataFrame([(r,) for r in removed], "name string")
    return found.join(listed(spark, root).select("name"), "name", "left_anti").join(gone, "name", "left_anti")


def paths(spark: SparkSession, root: str, names: list[str]) -> list[str]:
    return [f"{root}/observations/{n}" for n in names]


def read_files(spark: SparkSession, root: str, names: list[str], value: str = "double") -> DataFrame:
    """Observations of these files with period from their paths."""
    ddl = schema.observations(value)
    if not names:
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).option("basePath", f"{root}/observations").parquet(*paths(spark, root, names))


def observations(spark: SparkSession, root: str, version: int | None = None, value: str = "double") -> DataFrame:
    """The rows of a version, the newest if none is given."""
    names = [r.name for r in listed(spark, root, version).select("name").collect()]  # a name a file
    return read_files(spark, root, names, value)


_BITS = "name string, bucket bigint, bits binary"


def indexed(spark: SparkSession, root: str) -> DataFrame:
    """name, bucket, bits: which stations each file has that any version has named."""
    found = [str(f.getPath().toString()) for f in children(spark, f"{root}/_versions/stations")]
    return spark.read.schema(schema.struct(_BITS)).parquet(*found) if found else spark.createDataFrame([], schema.struct(_BITS))


def files_of_stations(spark: SparkSession, root: str, stations: list[int], time_lo=None, time_hi=None) -> list[str]:
    """The names of the newest version's files that have a row of one of these stations and may have one at a time in [lo, hi)."""
    wanted = spark.createDataFrame([(s,) for s in stations], "station_id int")
    asked = wanted.groupBy(F.bitmap_bucket_number("station_id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("station_id")).alias("asked"))
    files = listed(spark, root)
    if time_lo is not None:
        files = files.where(F.col("obs_time_max") >= F.lit(time_lo).cast("timestamp_ntz"))
    if time_hi is not None:
        files = files.where(F.col("obs_time_min") < F.lit(time_hi).cast("timestamp_ntz"))
    both = indexed(spark, root).join(F.broadcast(asked), "bucket").join(files.select("name"), "name")  # a row for 32,768 stations asked for
    held = both.select("name", "bucket", F.explode(F.array("bits", "asked")).alias("b")).groupBy("name", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("b")).alias("n"))
    return sorted(r.name for r in held.where("n > 0").select("name").distinct().collect())  # the names of the files that are read


def read_stations(spark: SparkSession, root: str, stations: list[int], time_lo, time_hi) -> DataFrame:
    """Observations of some stations, however far apart their ids, at times in [lo, hi): only files that have them are opened."""
    rows = read_files(spark, root, files_of_stations(spark, root, stations, time_lo, time_hi))
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in (time_lo, time_hi))
    return rows.where(F.col("station_id").isin(stations) & (F.col("obs_time") >= lo) & (F.col("obs_time") < hi))


class Change:
    """One operation on an archive: what it writes is staged, moved into place unread, and published with the next version.

    Where a version is made meanwhile by another, publishing raises Conflict and leaves
    what is there as it is; the operation can be run again.
    """

    def __init__(self, spark: SparkSession, root: str, operation: str):
        self.spark, self.root, self.operation = spark, root, operation
        self.base = latest(spark, root)
        self.version = 1 if self.base is None else self.base + 1
        self.id = uuid.uuid4().hex[:12]
        self.staged = f"{root}/_staged/{self.version:012d}-{self.id}"

    def adopt(self, files: DataFrame) -> None:
        """Publish the files that are there as a version, the first one, for the operation to start from."""
        self._write_list(files, f"{self.id}-base")
        publish(self.spark, self.root, self.version, {"list": f"{self.id}-base", "operation": "adopt", "removed": []})
        self.base, self.version = self.version, self.version + 1

    def _write_list(self, files: DataFrame, name: str) -> None:
        files.select(*COLUMNS).orderBy("path").coalesce(1).write.parquet(f"{self.root}/_versions/lists/{name}")  # a row a file

    def place(self) -> list[str]:
        """Move the staged files to where data files are; their names. No list has them yet."""
        names = []
        for folder in children(self.spark, self.staged):
            period = str(folder.getPath().getName())
            if not period.startswith("period="):
                continue
            part, period = period, period.split(STRETCH)[0]
            target, fs = _path(self.spark, f"{self.root}/observations/{period}")
            fs.mkdirs(target)
            files = sorted((str(f.getPath().toString()) for f in fs.listStatus(folder.getPath()) if str(f.getPath().getName()).endswith(".parquet")))
            for k, f in enumerate(files):
                name = f"{period}/v{self.version:012d}-{self.id}-{part[len(period) + 1 :]}{'-' * (part != period)}{k:06d}.parquet"
                move(self.spark, f, f"{self.root}/observations/{name}")
                names.append(name)
        return names

    def publish(self, files: DataFrame, removed: list[str], **more) -> int:
        """Publish the list of files as the next version."""
        self._write_list(files, self.id)
        before = {} if self.base is None else {"layout": describe(self.spark, self.root, self.base).get("layout")}
        publish(self.spark, self.root, self.version, {"list": self.id, "operation": self.operation, "removed": removed} | before | more)
        return self.version


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete pointers but the newest `keep`, and what no kept version needs: data files, lists and staged files; the data files' names.

    Files of others, which no version has named yet, stay. No operation may be at work.
    """
    numbers = pointers(spark, root)
    if not numbers:
        return []
    kept, old = numbers[-keep:], numbers[:-keep]
    docs = {n: describe(spark, root, n) for n in numbers}
    named = listed(spark, root, kept[0]).select("name")
    for n in kept[1:]:
        named = named.union(listed(spark, root, n).select("name"))
    removed = spark.createDataFrame([(name,) for d in docs.values() for name in d["removed"]], "name string")
    own = data_files(spark, root).where(F.col("name").rlike(_OWN)).select("name")
    here = data_files(spark, root).select("name").join(removed.unionByName(own).distinct(), "name", "left_semi")
    gone = [r.name for r in here.join(named.distinct(), "name", "left_anti").collect()]  # the names that are deleted
    for n in gone:
        path, fs = _path(spark, f"{root}/observations/{n}")
        fs.delete(path, False)
    # a folder is listed once, not for each of its files
    for folder in sorted({n.rpartition("/")[0] for n in gone} - {""}):
        if not [f for f in children(spark, f"{root}/observations/{folder}") if not str(f.getPath().getName()).startswith(".")]:
            path, fs = _path(spark, f"{root}/observations/{folder}")
            fs.delete(path, True)
    lists = {docs[n]["list"] for n in kept}
    for f in [*children(spark, f"{root}/_versions/lists"), *children(spark, f"{root}/_staged"), *[x for x in children(spark, f"{root}/_versions") if str(x.getPath().getName()).startswith("staged-")]]:
        if str(f.getPath().getName()) not in lists:
            path, fs = _path(spark, str(f.getPath().toString()))
            fs.delete(path, True)
    alive = indexed(spark, root).select("name", F.regexp_extract(F.col("_metadata.file_path"), r"/stations/([^/]+)/", 1).alias("id")).join(named.distinct(), "name", "left_semi") if children(spark, f"{root}/_versions/stations") else None
    used = set() if alive is None else {r.id for r in alive.select("id").distinct().collect()}  # an id a version
    for f in children(spark, f"{root}/_versions/stations"):
        if str(f.getPath().getName()) not in used:
            path, fs = _path(spark, str(f.getPath().toString()))
            fs.delete(path, True)
    # pointers last: what they name of others' files as removed is gone by then
    for n in old:
        path, fs = _path(spark, f"{root}/_versions/{n:012d}.json")
        fs.delete(path, False)
    return gone


def drop_others(spark: SparkSession, folder: str, version: int, name: str) -> None:
    """Of a table that each version has whole: delete what is not of this version."""
    for f in [*children(spark, folder), *children(spark, f"{folder}/_versions")]:
        own = str(f.getPath().getName())
        if own not in (name, "_versions", f"{version:012d}.json"):
            path, fs = _path(spark, str(f.getPath().toString()))
            fs.delete(path, True)


def versioned(spark: SparkSession, root: str) -> bool:
    return latest(spark, root) is not None


def layout_path(spark: SparkSession, root: str) -> str:
    """Where the layout of the newest version is: below _versions if an operation has changed it, else root/layout.json."""
    version = latest(spark, root)
    found = None if version is None else describe(spark, root, version).get("layout")
    if found:
        return f"{root}/_versions/layouts/{found}"
    return f"{root}/layout.json"
