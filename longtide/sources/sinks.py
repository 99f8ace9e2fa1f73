"""Writing the archive's tables."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geo import bbox, hilbert_key, wkb_point
from ..schema import KEYS, MANIFEST, struct
from . import files as fl
from . import versions
from .scratch import scratch

ROW_GROUP_ROWS = 150_000
TARGET_BYTES, MIN_BYTES, MAX_BYTES = 256 << 20, 128 << 20, 1 << 30
#: Small row groups on sorted ids, delta-coded times and stations (sorted, so runs of zero), a Bloom filter of stations,
#: which Parquet only writes for a column without a dictionary.
WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "9",
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary#obs_time": "false",
    "parquet.enable.dictionary#station_id": "false",
    "parquet.bloom.filter.enabled#station_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.block.row.count.limit": str(ROW_GROUP_ROWS),
    "parquet.page.size": str(1 << 20),
}


def files_per_period(period_rows: DataFrame, bytes_per_row: float, target: int = TARGET_BYTES, floor: int = MIN_BYTES, ceiling: int = MAX_BYTES) -> DataFrame:
    """period, files: as many of the target size as its bytes make, at least one."""
    if target + floor > ceiling:
        raise ValueError("target and floor together must not be above the ceiling: a tail joined to its file would be too large")
    return period_rows.select("period", F.greatest(F.lit(1), F.floor(F.col("rows") * float(bytes_per_row) / target)).cast("int").alias("files"))


_FIRST_TIME = "0001-01-01 00:00:00"
#: Files of more rows than this are cut between hours of a series, smaller ones between seconds.
HOURLY_ROWS = 100_000


def file_plan(rows: DataFrame, bytes_per_row: float, target: int = TARGET_BYTES, floor: int = MIN_BYTES, ceiling: int = MAX_BYTES) -> DataFrame:
    """period, files, cuts, first_file: a row a period. cuts are the keys (station, variable, time) at which a new file begins.

    A period's files have equal numbers of rows in key order. Rows are counted by
    series, and those of a series that lies across a bound by hour too, so a bound
    is at the start of a series or of an hour: a station or series of any size
    spans any number of files.
    """
    kept = scratch(rows.sparkSession, "series")  # read several times below, counted once
    rows.groupBy("period", "station_id", "variable_id").agg(F.count("*").alias("n")).write.parquet(kept)
    series = rows.sparkSession.read.parquet(kept)
    counted = files_per_period(series.groupBy("period").agg(F.sum("n").alias("rows")), bytes_per_row, target, floor, ceiling)
    before = W.partitionBy("period").orderBy("station_id", "variable_id").rowsBetween(W.unboundedPreceding, -1)
    placed = series.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("total", F.sum("n").over(W.partitionBy("period"))).join(F.broadcast(counted), "period")
    placed = placed.withColumn("share", F.col("total") / F.col("files"))
    first, last = F.greatest(F.lit(1), F.ceil(F.col("before") / F.col("share")).cast("int")), F.least(F.col("files") - 1, (F.ceil((F.col("before") + F.col("n")) / F.col("share")) - 1).cast("int"))
    cut = placed.withColumn("lo", first).withColumn("hi", last).where("lo <= hi")  # no more than there are files
    series_key = ["period", "station_id", "variable_id"]
    at_start = cut.where("lo * share <= before").select(*series_key, F.lit(_FIRST_TIME).cast("timestamp_ntz").alias("obs_time"))
    inside = cut.where("lo * share > before or lo < hi").select(*series_key, "before", "share", "lo", "hi")
    unit = "hour" if target / bytes_per_row > HOURLY_ROWS else "second"
    times = rows.join(F.broadcast(inside.select(*series_key)), series_key).groupBy(*series_key, F.date_trunc(unit, "obs_time").cast("timestamp_ntz").alias("obs_time")).agg(F.count("*").alias("n"))
    earlier = W.partitionBy(*series_key).orderBy("obs_time").rowsBetween(W.unboundedPreceding, -1)
    reached = times.withColumn("reached", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(F.broadcast(inside), series_key)
    # a bound that lies in an hour is at its start
    from_row, to_row = F.col("before") + F.col("reached"), F.col("before") + F.col("reached") + F.col("n")
    k1, k2 = F.greatest("lo", F.floor(F.col("before") / F.col("share")) + 1, F.ceil(from_row / F.col("share"))), F.least(F.col("hi"), F.ceil(to_row / F.col("share")) - 1)
    cuts = at_start.unionByName(reached.where(k1 <= k2).select(*series_key, "obs_time"))
    cuts = cuts.groupBy("period").agg(F.array_sort(F.collect_set(F.struct("station_id", "variable_id", "obs_time"))).alias("cuts"))
    of_earlier = W.orderBy("period").rowsBetween(W.unboundedPreceding, -1)  # a row a period
    return counted.join(cuts, "period", "left").withColumn("first_file", F.coalesce(F.sum("files").over(of_earlier), F.lit(0)).cast("int"))


#: What Spark calls the folder of a null.
NO_PERIOD = "__HIVE_DEFAULT_PARTITION__"


def write_in_order(rows: DataFrame, path: str, most_rows: int, listed: str) -> DataFrame:
    """rows (period and other columns), as they lie in each partition, as files of at most most_rows below path/period=<period>; path, rows of each file, kept as a table at listed.

    For files by the million: a task writes each by itself, without a writer of Spark's and a
    commit for it. Files count by being in the table, which Spark commits: those of a task that was run again are in no one's list.
    """

    def write(batches):
        name, made, n = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}", set(), 0
        held: list[pa.RecordBatch] = []
        size, of, done = 0, None, []

        def put() -> None:
            nonlocal size, n
            folder = f"{path}/period={of}"
            if folder not in made:
                fl.make_folder(folder)
                made.add(folder)
            file = f"{folder}/{name}-{n:07d}.parquet"
            with fl.created(file) as f:
                pq.write_table(pa.Table.from_batches(held), f, use_dictionary=False)
            done.append((file, size))
            held.clear()
            size, n = 0, n + 1

        def out() -> pa.RecordBatch:
            found = pa.record_batch([pa.array([f for f, _ in done], pa.string()), pa.array([k for _, k in done], pa.int64())], ["path", "rows"])
            done.clear()
            return found

        for batch in batches:
            period, own = batch.column("period").fill_null(NO_PERIOD).dictionary_encode(), batch.drop_columns(["period"])
            code = period.indices.to_numpy()
            starts = [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist()] if len(code) else []
            for a, b in zip(starts, [*starts[1:], len(code)], strict=False):
                if held and period[a].as_py() != of:
                    put()
                of = period[a].as_py()
                while a < b:
                    k = min(b - a, most_rows - size)
                    held.append(own.slice(a, k))
                    a, size = a + k, size + k
                    if size == most_rows:
                        put()
            if len(done) >= 1000:
                yield out()
        if held:
            put()
        yield out()

    rows.mapInArrow(write, "path string, rows bigint").write.parquet(listed)
    return rows.sparkSession.read.schema("path string, rows bigint").parquet(listed)


def cuts_up_to(cuts: Column, key: Column) -> Column:
    """How many of the sorted cuts are not above key, by halving: of n cuts about log2(n) are looked at."""
    top = F.floor(F.log2(F.size(cuts))).cast("int")
    steps = F.transform(F.sequence(top, F.lit(0), F.lit(-1)), lambda i: F.pow(F.lit(2.0), i).cast("int"))
    # the key is made once, as the one element of an array
    found = F.transform(F.array(key), lambda k: F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(cuts, at + s - 1) <= k, at + s).otherwise(at)))
    return F.when(F.size(cuts) < 1, F.lit(0)).otherwise(F.get(found, F.lit(0)))


#: Buckets of stations for each cut: so few have a cut in them that nearly all rows need no search.
_BUCKETS_A_CUT = 16


def _buckets(cuts: list[tuple]) -> tuple[int, int, int, list[tuple[int, int, list[tuple]]]]:
    """lo, width, n and (bucket, base, cuts) of sorted cuts (station first): stations in n buckets of equal width from lo, the cuts in each and how many come before.

    Bucket 0 is of stations below lo and null ones, n + 1 of those above all; a bucket
    that is not listed has none of its own and the base of the next that is.
    """
    none, known = [c for c in cuts if c[0] is None], [c for c in cuts if c[0] is not None]
    lo, hi = (known[0][0], known[-1][0]) if known else (0, -1)
    width = max(1, -(-(hi - lo + 1) // (_BUCKETS_A_CUT * max(1, len(known)))))
    n = -(-(hi - lo + 1) // width)
    own: list[list[tuple]] = [none, *[[] for _ in range(n + 1)]]
    for c in known:
        own[(c[0] - lo) // width + 1].append(c)
    out, base = [], 0
    for b, inside in enumerate(own):
        out.append((b, base, inside))
        base += len(inside)
    return lo, width, n, out


def with_cuts_up_to(rows: DataFrame, cuts: dict[str, list[tuple]], cut_type: str, key: Column, name: str) -> DataFrame:
    """rows with `name`, how many of their period's sorted cuts are not above key; 0 for a period without any.

    The cuts of a period are broadcast by buckets of stations, so a row meets those
    of its bucket only, mostly none, however many files its period has.
    """
    spark = rows.sparkSession
    found = {period: _buckets(own) for period, own in cuts.items()}
    spans = spark.createDataFrame([(p, lo, width, n) for p, (lo, width, n, _) in found.items()], "__of string, __lo long, __width long, __n long")
    inside = spark.createDataFrame([(p, *row) for p, (_, _, _, of) in found.items() for row in of], f"__in string, __b long, __base int, __cuts array<{cut_type}>")
    station = F.col("station_id").cast("long")
    bucket = F.when(station >= F.col("__lo"), F.least(F.call_function("div", station - F.col("__lo"), F.col("__width")), F.col("__n")) + 1).otherwise(F.lit(0))
    # two joins, as a row must not carry all cuts of its period
    placed = rows.join(F.broadcast(spans), F.col("period") == F.col("__of"), "left").withColumn("__at", bucket)
    placed = placed.join(F.broadcast(inside), (F.col("__of") == F.col("__in")) & (F.col("__at") == F.col("__b")), "left")
    number = F.when(F.size("__cuts") > 0, F.col("__base") + cuts_up_to(F.col("__cuts"), key)).otherwise(F.coalesce("__base", F.lit(0)))
    return placed.select(*rows.columns, number.cast("int").alias(name))


def write_observations(rows: DataFrame, path: str, bytes_per_row: float = 1.4, target: int = TARGET_BYTES, floor: int = MIN_BYTES, ceiling: int = MAX_BYTES, mode: str = "error") -> None:
    """Sorted files of bounded size by period.

    A period of n files' size is cut into n runs of its key order of equal numbers
    of rows; each is one partition, dealt out by its number, and one file. rows
    is read once for the plan and once to be written, so it should be a table.
    """
    plan = file_plan(rows, bytes_per_row, target, floor, ceiling).collect()  # a row a period, a key a file
    total = max(1, sum(r.files for r in plan))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    cut_type = f"struct<{', '.join(f'{k}: {kinds[k]}' for k in KEYS)}>"
    cut = with_cuts_up_to(rows, {r.period: [tuple(c) for c in r.cuts or []] for r in plan}, cut_type, F.struct(*KEYS), "__cut")
    first = rows.sparkSession.createDataFrame([(r.period, r.first_file) for r in plan], "period string, __first int")
    numbered = cut.join(F.broadcast(first), "period").withColumn("__file", F.col("__first") + F.col("__cut"))
    dealt = numbered.repartitionById(total, "__file").select(*rows.columns)
    writer = dealt.sortWithinPartitions("period", *KEYS).write.options(**WRITE_OPTIONS).partitionBy("period")
    if mode == "replace_periods":
        # only the periods in rows are replaced, each in one commit
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode(mode).parquet(path)


def write_manifest(manifest: DataFrame, root: str) -> None:
    """The manifest by path and its summaries, whole and by period, below root; a row a file, so each is one sorted file."""
    from ..operators.manifest import by_period, summarize

    spark = manifest.sparkSession
    manifest.orderBy("path").coalesce(1).write.mode("overwrite").parquet(f"{root}/_manifest")
    written = spark.read.schema(struct(MANIFEST)).parquet(f"{root}/_manifest")
    summarize(written).coalesce(1).write.mode("overwrite").parquet(f"{root}/_summary")
    by_period(written).orderBy("period").coalesce(1).write.mode("overwrite").parquet(f"{root}/_summary_by_period")


def write_delta(rows: DataFrame, path: str, run_id: str, ingested_at) -> None:
    """Rows stamped with one time, sorted, below run_id=."""
    stamped = rows.withColumn("ingested_at", F.date_trunc("second", F.lit(ingested_at).cast("timestamp_ntz")).cast("timestamp_ntz")).withColumn("run_id", F.lit(run_id))
    stamped.sortWithinPartitions(*KEYS).write.mode("append").partitionBy("run_id").parquet(path)


def delta_files(deltas: DataFrame) -> list[str]:
    """The files that a fold reads, to be captured before it begins."""
    return deltas.inputFiles()


def clear_files(spark: SparkSession, files: list[str]) -> None:
    """Delete exactly these files; what came later stays."""
    conf = spark._jsc.hadoopConfiguration()
    for f in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(conf).delete(path, False)


def write_dimension(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def frequencies(histories: DataFrame) -> DataFrame:
    """The vocabulary: distinct, sorted, without null."""
    return histories.select("freq").where(F.col("freq").isNotNull()).distinct().orderBy("freq")


def spatial(points: DataFrame) -> DataFrame:
    """points with geometry (WKB) and bbox, along the Hilbert curve, points without coordinates last."""
    placed = points.withColumn("__key", hilbert_key(F.col("lon"), F.col("lat")))
    ordered = placed.orderBy(F.col("__key").isNull(), "__key", F.col(points.columns[0])).drop("__key")
    return ordered.withColumn("geometry", wkb_point(F.col("lon"), F.col("lat"))).withColumn("bbox", bbox(F.col("lon"), F.col("lat")))


def write_spatial(points: DataFrame, path: str, row_group_rows: int = 10_000) -> None:
    spatial(points).write.mode("overwrite").option("parquet.block.row.count.limit", str(row_group_rows)).parquet(path)


def write_layout(layout: DataFrame, path: str) -> None:
    doc = layout.select(F.struct("period", "start_year", "end_year").alias("p")).agg(F.sort_array(F.collect_list("p")).alias("periods"))
    doc.select(F.lit(1).alias("version"), "periods").coalesce(1).write.mode("overwrite").json(path)


def write_state(state: DataFrame, path: str, writer: str) -> None:
    """By station, one folder a writer, so that writers do not meet. A new table is published by one rename; what was there before is then deleted."""
    spark, folder = state.sparkSession, f"{path}/writer={writer}"
    number = (versions.latest(spark, folder) or 0) + 1
    name = f"g{number:06d}-{uuid.uuid4().hex[:12]}"
    state.orderBy("station_id").coalesce(1).write.parquet(f"{folder}/{name}")
    versions.publish(spark, folder, number, {"list": name, "removed": []})
    versions.drop_others(spark, folder, number, name)
