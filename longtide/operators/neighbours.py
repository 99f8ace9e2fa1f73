"""Checks of keys along the files as they are written: a task walks its files and passes on their ends, not their rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schema
from ..functions.labels import path_period
from ..schema import KEYS
from ..sources import files as fl
from ..sources.scratch import scratch
from . import manifest as mf

#: Where a row says which file it is in; others say it by a hash.
_NAMED = 4096
#: Rows of small files that are walked in one batch, and those of a large one.
_BATCH_ROWS = 1 << 16
_ROWS = "station_id int, variable_id smallint, obs_time timestamp_ntz, file bigint, at bigint, path string"
_KEY = "struct<station_id: bigint, variable_id: bigint, obs_time: bigint>"
SEGMENTS = f"file bigint, path string, first_at bigint, rows bigint, first {_KEY}, last {_KEY}, extra bigint, down bigint, nulls bigint"


class _Walk:
    """One stretch of a file's rows, row by row in its order; keys are three whole numbers, null below all."""

    def __init__(self, file: int, at: int, key: tuple[int, ...]):
        self.file, self.first_at, self.rows, self.first, self.last = file, at, 0, key, key
        self.path, self.extra, self.down, self.nulls = None, 0, 0, 0

    def take(self, keys: np.ndarray, nulls: int, path: str | None) -> None:
        """Further rows' keys (3 x n)."""
        if self.rows:
            keys = np.concatenate((np.array(self.last, np.int64)[:, None], keys), 1)
        before, after = keys[:, :-1], keys[:, 1:]
        below = equal = None
        for a, b in zip(before[::-1], after[::-1], strict=True):  # from the last key column to the first
            below = (b < a) if below is None else (b < a) | ((b == a) & below)
            equal = (b == a) if equal is None else (b == a) & equal
        self.extra += int(equal.sum())
        self.down += int(below.sum())
        self.rows += keys.shape[1] - (self.rows > 0)
        self.last = tuple(int(x) for x in keys[:, -1])
        self.nulls += nulls
        self.path = self.path or path


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[_Walk] = []
    walk = None

    def out(walks: list[_Walk]) -> pa.RecordBatch:
        key = pa.struct([(k, pa.int64()) for k in KEYS])
        ends = lambda keys: pa.array([dict(zip(KEYS, k, strict=True)) for k in keys], key)
        plain = lambda name: pa.array([getattr(w, name) for w in walks], pa.string() if name == "path" else pa.int64())
        return pa.record_batch([plain("file"), plain("path"), plain("first_at"), plain("rows"), ends([w.first for w in walks]), ends([w.last for w in walks]), plain("extra"), plain("down"), plain("nulls")], ["file", "path", "first_at", "rows", "first", "last", "extra", "down", "nulls"])

    for batch in batches:
        if not batch.num_rows:
            continue
        file, at = batch.column("file").to_numpy(), batch.column("at").to_numpy()
        columns = [batch.column("station_id").cast(pa.int64()), batch.column("variable_id").cast(pa.int64()), batch.column("obs_time").cast(pa.timestamp("us")).cast(pa.int64())]
        keys = np.stack([c.fill_null(np.iinfo(np.int64).min).to_numpy() for c in columns])
        null = np.zeros(len(at), bool)
        for c in columns:
            if c.null_count:
                null |= c.is_null().to_numpy(zero_copy_only=False)
        paths = batch.column("path").to_pylist() if batch.column("path").null_count < batch.num_rows else None
        starts = np.flatnonzero(np.concatenate(([True], (file[1:] != file[:-1]) | (at[1:] != at[:-1] + 1))))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(at)], strict=True):
            if walk is None or walk.file != file[a] or walk.first_at + walk.rows != at[a]:
                if walk is not None:
                    done.append(walk)
                walk = _Walk(int(file[a]), int(at[a]), tuple(int(x) for x in keys[:, a]))
            walk.take(keys[:, a:b], int(null[a:b].sum()), next((p for p in paths[a:b] if p), None) if paths else None)
        if len(done) > 1000:
            yield out(done)
            done = []
    if walk is not None:
        yield out([*done, walk])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of files (path, file), one after the other, many small ones to a batch."""
    held: list[tuple[pa.Table, str, int, int]] = []
    n = 0

    def out() -> list[pa.RecordBatch]:
        rows = pa.concat_tables([t for t, *_ in held]).combine_chunks()
        sizes = np.array([t.num_rows for t, *_ in held])
        first = np.cumsum(sizes) - sizes
        at = np.arange(rows.num_rows) - np.repeat(first - np.array([a for *_, a in held]), sizes)
        named = np.zeros(rows.num_rows, np.int64)
        named[first[sizes > 0]] = np.arange(len(held))[sizes > 0] + 1  # where a piece begins
        path = pa.array([None, *[p for _, p, *_ in held]], pa.string()).take(pa.array(named))
        file = np.repeat(np.array([f for _, _, f, _ in held], np.int64), sizes)
        return pa.Table.from_arrays([*rows.columns, pa.array(file), pa.array(at), path], [*KEYS, "file", "at", "path"]).to_batches()

    kinds = pa.schema([("station_id", pa.int32()), ("variable_id", pa.int16()), ("obs_time", pa.timestamp("us"))])
    for batch in batches:
        for path, file in zip(batch.column("path").to_pylist(), batch.column("file").to_pylist(), strict=True):
            with fl.opened(path) as f:
                parquet, at = pq.ParquetFile(f), 0
                pieces = [parquet.read(KEYS, use_threads=False)] if parquet.metadata.num_rows <= _BATCH_ROWS else map(lambda b: pa.Table.from_batches([b]), parquet.iter_batches(_BATCH_ROWS, columns=KEYS, use_threads=False))
                for piece in pieces:
                    held.append((piece.select(KEYS).cast(kinds), path, file, at))
                    at, n = at + piece.num_rows, n + piece.num_rows
                    if n >= _BATCH_ROWS:
                        yield from out()
                        held, n = [], 0
    if held:
        yield from out()


def _dealt(files: DataFrame) -> DataFrame:
    """path, file of files, to a given number of tasks: by the size of these rows they would be few."""
    return files.select("path", F.xxhash64("path").alias("file")).repartition(4 * files.sparkSession.sparkContext.defaultParallelism, "file")


def _rows(spark: SparkSession, root: str, files: list[str] | DataFrame | None) -> DataFrame:
    if isinstance(files, DataFrame):
        return _dealt(files).mapInArrow(_read, _ROWS)
    read = spark.read.schema(schema.observations())
    found = read.option("basePath", f"{root}/observations").parquet(*files) if files is not None else read.parquet(f"{root}/observations")
    path = F.col("_metadata.file_path")
    return found.select(*KEYS, F.xxhash64(path).alias("file"), F.col("_metadata.row_index").alias("at"), F.when(F.col("_metadata.row_index") % _NAMED == 0, path).alias("path"))


def _few_tasks(rows: DataFrame) -> DataFrame:
    """rows of a scan, several of its splits to a task where there are many: of small files a split has a few only."""
    return rows.coalesce(max(4 * rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions() // 8))


def key_segments(spark: SparkSession, root: str, files: list[str] | DataFrame | None = None) -> DataFrame:
    """A row a stretch of a file that one task reads, of the files given or all below root/observations.

    Of a table of files (path) a task opens its own itself, each whole, so nobody
    lists them and small ones may be many.

    file (a hash of the path), path, first_at, rows, first and last key as whole
    numbers, extra (rows whose key is that of the row before), down (rows whose
    key is below it) and nulls (rows with a null in their key). Only the key columns are
    read, and no row leaves the task that reads it.
    """
    if isinstance(files, DataFrame):
        return _dealt(files).mapInArrow(lambda batches: _walked(_read(batches)), SEGMENTS)
    if files is not None and not files:
        return spark.createDataFrame([], SEGMENTS)
    found = _few_tasks(_rows(spark, root, files)).mapInArrow(_walked, SEGMENTS)
    # only stretches are exchanged, and files are walked once
    return found.withColumn("path", F.max("path").over(W.partitionBy("file")))


def key_bounds(segments: DataFrame) -> DataFrame:
    """path, first_key, last_key, extra, down, nulls of each file; down also counts stretches that begin below the end of the one before."""
    w = W.partitionBy("file").orderBy("first_at")
    own = segments.withColumn("falls", F.coalesce((F.col("first") < F.lag("last").over(w)).cast("long"), F.lit(0))).withColumn("meets", F.coalesce((F.col("first") == F.lag("last").over(w)).cast("long"), F.lit(0)))
    return own.groupBy("path").agg(
        F.min_by("first", "first_at").alias("first_key"), F.max_by("last", "first_at").alias("last_key"), F.sum(F.col("extra") + F.col("meets")).alias("extra"), F.sum(F.col("down") + F.col("falls")).alias("down"), F.sum("nulls").alias("nulls"),
    )


def _written(spark: SparkSession, segments: DataFrame) -> DataFrame:
    """segments as a table: a row a task and file."""
    path = scratch(spark, "segments")
    segments.write.parquet(path)
    return spark.read.schema(SEGMENTS).parquet(path)


def duplicate_keys_in_files(spark: SparkSession, root: str, segments: DataFrame | None = None, files: list[str] | DataFrame | None = None) -> DataFrame:
    """period, extra_rows: rows beyond the first of each key, as merge.duplicate_keys by period gives them, of periods that have any.

    In sorted files equal keys are neighbours, so a task counts those inside its
    stretches, and stretches are held against each other by their ends. Rows are
    dealt out by key only from files that are out of order or whose keys lie
    across each other's.
    """
    segments = _written(spark, key_segments(spark, root, files)) if segments is None else segments
    own = segments.withColumn("period", path_period(F.col("path"))).withColumn("sorted", F.col("down") == 0)
    # an unsorted stretch's ends do not bound its keys, so all of its period is dealt out by key
    order = W.partitionBy("period").orderBy("first", "last", "file", "first_at")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    placed = own.withColumn("reach", F.max("last").over(before)).withColumn("loose", F.min("sorted").over(W.partitionBy("period")) == F.lit(False))
    across = F.coalesce(F.col("first") < F.col("reach"), F.lit(False))
    placed = placed.withColumn("across", across).withColumn("meets", F.coalesce(F.col("first") == F.col("reach"), F.lit(False)).cast("long"))
    placed = placed.withColumn("island", F.sum((~F.col("across")).cast("long")).over(order)).withColumn("tangled", F.col("loose") | (F.max("across").over(W.partitionBy("period", "island"))))
    # of a tangle the border with the island before still counts; inside it keys are counted by value
    counted = placed.select("period", (F.when(F.col("tangled"), F.lit(0)).otherwise(F.col("extra")) + F.when(F.col("loose") | F.col("across"), F.lit(0)).otherwise(F.col("meets"))).alias("extra_rows"))
    tangled = placed.where("tangled").select("file", F.col("period").alias("of_period"), F.when(F.col("loose"), F.lit(0)).otherwise(F.col("island")).alias("island"), F.col("first_at").alias("lo"), (F.col("first_at") + F.col("rows")).alias("hi"))
    found = counted
    if not tangled.isEmpty():
        found = counted.unionByName(_by_value(_rows(spark, root, files).drop("path"), tangled))
    return found.groupBy("period").agg(F.sum("extra_rows").alias("extra_rows")).where("extra_rows > 0")


def _by_value(rows: DataFrame, tangled: DataFrame) -> DataFrame:
    """period, extra_rows of the keys in tangled stretches, dealt out by key."""
    own = rows.join(tangled, "file").where((F.col("at") >= F.col("lo")) & (F.col("at") < F.col("hi")))
    repeated = own.groupBy("of_period", "island", *KEYS).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.select(F.col("of_period").alias("period"), (F.col("n") - 1).alias("extra_rows"))


def verify_files(spark: SparkSession, root: str, floor: int = mf.MIN_BYTES, most_rows: int = mf.ROW_GROUP_ROWS) -> DataFrame:
    """manifest.verify of the files below root/observations, and null_keys and falling_keys by file: one pass over the key columns, and the files' tails."""
    footers = fl.footers(spark, f"{root}/observations")
    segments = _written(spark, key_segments(spark, root))
    found = mf.verify(footers, mf.build_manifest(footers, None), None, floor, most_rows, duplicate_keys_in_files(spark, root, segments))
    bounds = key_bounds(segments)
    for check, count in (("null_keys", "nulls"), ("falling_keys", "down")):
        found = found.unionByName(bounds.where(F.col(count) > 0).select(F.lit(check).alias("check"), F.col("path").alias("subject"), F.col(count).cast("string").alias("detail")))
    return found
