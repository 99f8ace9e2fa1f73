"""Folding staged deltas into an archive, and moving one to another layout: whole operations on its files.

Each ends in a new version (sources.versions): stopped anywhere, readers find the
old rows or the new ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schema
from ..functions.labels import period_years
from ..sources import files, sinks, tables, versions
from ..sources.scratch import scratch
from . import layout as lo
from . import manifest as mf
from . import merge as mg
from . import neighbours as nb
from . import repartition as rp

_KEY = versions.LISTED.split("first_key ")[1].split(", last_key")[0]


def label_spans(labels: DataFrame, layout: DataFrame) -> DataFrame:
    """period, start_year, end_year of labels (period): the layout's years, or for labels it does not have those that they say."""
    years = period_years(F.col("period"))
    own = labels.select("period").distinct().join(layout.select("period", "start_year", "end_year"), "period", "left")
    return own.select("period", F.coalesce("start_year", years["start_year"]).alias("start_year"), F.coalesce("end_year", years["end_year"]).alias("end_year"))


def described(spark: SparkSession, root: str, found: DataFrame, written_at=None) -> DataFrame:
    """The rows of a list (versions.LISTED) of data files (name, path, file_bytes, modified): only these files are read, their tails and their key columns."""
    names = [r.name for r in found.select("name").collect()]  # a name a file
    if not names:
        return spark.createDataFrame([], schema.struct(versions.LISTED))
    path = scratch(spark, "described")
    rows = mf.build_manifest(files.footers(spark, root, found), written_at)
    bounds = nb.key_bounds(nb.key_segments(spark, root, versions.paths(spark, root, names)))
    ends = bounds.select(F.regexp_extract("path", r"/observations/(.+)$", 1).alias("name"), "first_key", "last_key", (F.col("extra") + F.col("down") + F.col("nulls") == 0).alias("in_order"))
    whole = found.select("name", "path", "modified").join(rows, "path").join(ends, "name", "left")
    whole.select(*versions.COLUMNS).write.parquet(path)
    return spark.read.schema(schema.struct(versions.LISTED)).parquet(path)


def index_stations(spark: SparkSession, root: str, names: list[str], as_: str) -> None:
    """Write which stations these files have: a bitmap of each file and each 32,768 ids, beside the lists."""
    rows = versions.read_files(spark, root, names).select("station_id", F.regexp_extract(F.col("_metadata.file_path"), r"/observations/(.+)$", 1).alias("name")) if names else None
    if rows is not None:
        # first the stations, by hash along the sorted files: bitmaps are made by sorting, and so of few rows
        bits = rows.where(F.col("station_id").isNotNull()).distinct().groupBy("name", F.bitmap_bucket_number("station_id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("station_id")).alias("bits"))
        bits.orderBy("bucket", "name").write.option("compression", "zstd").parquet(f"{root}/_versions/stations/{as_}")


def _start(change: versions.Change) -> DataFrame:
    """The files that an operation starts from: the newest version's and those that others have put there, as a table."""
    spark, root = change.spark, change.root
    found = described(spark, root, versions.foreign_files(spark, root))
    return found if change.base is None else versions.listed(spark, root, change.base).unionByName(found)


def adopt(spark: SparkSession, root: str) -> int:
    """Make the files of an archive that has no versions its first one; the newest version's number."""
    change = versions.Change(spark, root, "adopt")
    if change.base is None:
        before = _start(change)
        index_stations(spark, root, [r.name for r in before.select("name").collect()], f"{change.id}-base")
        change.adopt(before)
    return change.base


def _finish(change: versions.Change, before: DataFrame, removed: list[str], now, **more) -> None:
    """Place what is staged, check it, publish the version."""
    spark, root = change.spark, change.root
    if change.base is None:
        index_stations(spark, root, [r.name for r in before.select("name").collect()], f"{change.id}-base")
        change.adopt(before)  # from here on only what a list names is read
    placed = spark.createDataFrame([(n,) for n in change.place()], "name string")
    new = described(spark, root, versions.data_files(spark, root).join(placed, "name", "left_semi"), now)
    bad = [r.name for r in new.where("not in_order").select("name").limit(20).collect()]
    if bad:
        raise ValueError("files with null, repeated or falling keys are not published: " + ", ".join(bad))
    foreign = [] if not change.base else [r.name for r in before.join(versions.indexed(spark, root).select("name").distinct(), "name", "left_anti").select("name").collect()]
    index_stations(spark, root, [r.name for r in placed.collect()] + foreign, change.id)
    kept = before.join(spark.createDataFrame([(n,) for n in removed], "name string"), "name", "left_anti")
    change.publish(kept.unionByName(new), removed, **more)


def rebuild_manifest(spark: SparkSession, root: str, written_at) -> DataFrame:
    """The manifest and its summaries written anew; the manifest as it was written. Only files that it does not have as they are now are read, by their footers."""
    if versions.versioned(spark, root):
        sinks.write_manifest(versions.listed(spark, root).select("modified", *[c.split()[0] for c in schema.MANIFEST.split(", ")]), root)
        return tables.manifest(spark, root)
    here = versions.data_files(spark, root)
    if tables.exists(spark, f"{root}/_manifest"):
        known = spark.read.schema(schema.struct(f"{schema.MANIFEST}, modified bigint")).parquet(f"{root}/_manifest")
        same = known.join(here.select("path", "file_bytes", "modified"), ["path", "file_bytes", "modified"], "left_semi")
    else:
        same = spark.createDataFrame([], schema.struct(f"{schema.MANIFEST}, modified bigint"))
    changed = here.join(same.select("path"), "path", "left_anti")
    rows = mf.build_manifest(files.footers(spark, root, changed), written_at).join(changed.select("path", "modified"), "path")
    staged = scratch(spark, "manifest")
    same.unionByName(rows).write.parquet(staged)  # what is overwritten below is read here
    sinks.write_manifest(spark.read.schema(schema.struct(f"{schema.MANIFEST}, modified bigint")).parquet(staged), root)
    return tables.manifest(spark, root)


def _routed(rows: DataFrame, before: DataFrame, whole: list[str]) -> tuple[DataFrame, list[tuple[str, int, str]]]:
    """rows with stretch, the number of the file in its period that a row's key belongs to; and (period, stretch, name) of the files.

    A period's files are cut apart by their first keys. Those of periods in
    `whole`, or whose files are out of order or lie across each other, are one stretch.
    """
    w = W.partitionBy("period").orderBy("first_key", "last_key", "name")  # a row a file
    placed = before.withColumn("reach", F.max("last_key").over(w.rowsBetween(W.unboundedPreceding, -1)))
    loose = F.max(~F.col("in_order") | F.coalesce(F.col("first_key") <= F.col("reach"), F.lit(False))).over(W.partitionBy("period"))
    placed = placed.withColumn("loose", F.coalesce(loose, F.lit(True)) | F.col("period").isin(whole)).withColumn("stretch", F.when(F.col("loose"), F.lit(0)).otherwise(F.row_number().over(w) - 1))
    found = placed.select("period", "stretch", "name", "first_key", "loose").collect()  # a row a file
    cuts: dict[str, list] = {}
    for r in sorted(found, key=lambda r: (r.period, r.stretch)):
        cuts.setdefault(r.period, [])
        if r.stretch:
            cuts[r.period].append(tuple(r.first_key))
    key = F.struct(F.col("station_id").cast("long").alias("station_id"), F.col("variable_id").cast("long").alias("variable_id"), F.unix_micros(F.col("obs_time").cast("timestamp")).alias("obs_time"))
    return sinks.with_cuts_up_to(rows, cuts, _KEY, key, "stretch"), [(r.period, r.stretch, r.name) for r in found]


def compact_archive(spark: SparkSession, root: str, layout: DataFrame, periods: list[str] | None = None, include_deltas: bool = True, now=None, keep_versions: int = 1, **sizes) -> DataFrame:
    """Fold the deltas below root/deltas into root/observations; period, rows_before, rows_delta, rows_after of what was rewritten.

    Without periods the deltas there are now are folded: each goes to the file
    of its period that has its key's place, only those files are rewritten, and the delta
    files are deleted at the end; later ones stay. Given periods are rewritten
    whole whether or not deltas touch them, and no delta is deleted. A label
    that the layout does not have has the years that it says. A period without
    files and deltas is skipped. The new files are published as a version and
    what they replace is deleted, but for what the newest keep_versions name.
    A run after one that was stopped does what is left.
    """
    change = versions.Change(spark, root, "compact")
    if change.base is not None:  # deltas that a stopped run has folded, but not deleted
        sinks.clear_files(spark, versions.describe(spark, root, change.base).get("folded", []))
    captured = sinks.delta_files(tables.deltas(spark, root)) if include_deltas else []
    # exactly the captured files are read, so what is deleted is what was folded
    new = spark.read.schema(schema.struct(schema.DELTA)).parquet(*captured) if captured else mg.empty(spark, schema.DELTA)
    labels = spark.createDataFrame([(p,) for p in periods], "period string") if periods is not None else mg.touched_periods(new, layout)
    spans = label_spans(labels, layout)
    before = _start(change)
    # a label for each of its years: some hundreds
    years = F.broadcast(lo.year_periods(spans).withColumnRenamed("year", "y").withColumnRenamed("period", "to"))
    placed = new.withColumn("y", F.year("obs_time")).join(years, "y").withColumn("period", F.col("to")).drop("y", "to")
    routed, stretches = _routed(placed, before, periods or [])
    staged_deltas = scratch(spark, "routed")
    routed.write.parquet(staged_deltas)
    routed = spark.read.parquet(staged_deltas)
    wanted = {(r.period, r.stretch) for r in routed.select("period", "stretch").distinct().collect()} | {(p, n) for p, n, _ in stretches if p in (periods or [])}
    if not wanted:
        return mg.compact_stats(*[d.select("period") for d in (before.limit(0), before.limit(0), before.limit(0))])
    replaced = {name: (p, n) for p, n, name in stretches if (p, n) in wanted}
    of_file = F.broadcast(spark.createDataFrame([(name, n) for name, (_, n) in replaced.items()], "name string, stretch int"))
    old = versions.read_files(spark, root, list(replaced)) if replaced else tables.none(spark)
    file_name = F.regexp_extract(F.col("_metadata.file_path"), r"/observations/(.+)$", 1) if replaced else F.lit("")
    old = old.withColumn("name", file_name).join(of_file, "name").drop("name")
    staged = scratch(spark, "compaction")
    folded = mg.latest(old.withColumn("ingested_at", F.lit(mg.BASE_STAMP).cast("timestamp_ntz")).unionByName(routed), [*schema.KEYS, "period", "stretch"])
    folded.select(*schema.KEYS, "value", F.concat("period", F.lit(versions.STRETCH), "stretch").alias("period")).write.parquet(staged)
    after = spark.read.schema(schema.observations()).parquet(staged)
    touched = {p for p, _ in wanted}
    rows_of = {r.name: (r.period, r.rows) for r in before.where(F.col("period").isin(list(touched))).select("name", "period", "rows").collect()}  # a row a file
    deltas_of = {r.period: r["count"] for r in routed.groupBy("period").count().collect()}
    made = {}
    for r in after.groupBy("period").count().collect():  # a row a stretch
        label = r.period.split(versions.STRETCH)[0]
        made[label] = made.get(label, 0) + r["count"]
    stats = []
    for p in sorted(touched):
        here = sum(n for own, n in rows_of.values() if own == p)
        untouched = sum(n for name, (own, n) in rows_of.items() if own == p and name not in replaced)
        if here or p in made:
            stats.append((p, here, deltas_of.get(p, 0), untouched + made.get(p, 0)))
    if made:
        sinks.write_observations(after, change.staged, **sizes)
        _finish(change, before, list(replaced), now, folded=captured if periods is None else [])
    if periods is None:
        sinks.clear_files(spark, captured)
    if made:
        versions.vacuum(spark, root, keep_versions)
    if now is not None and tables.exists(spark, f"{root}/_manifest"):
        rebuild_manifest(spark, root, now)
    return spark.createDataFrame(stats, "period string, rows_before long, rows_delta long, rows_after long")


def apply_repartition(spark: SparkSession, root: str, layout: DataFrame, dry_run: bool = True, now=None, keep_versions: int = 1, **sizes) -> DataFrame:
    """The plan of moving root/observations to a layout (written, period, verdict, files, action), carried out unless dry_run.

    Refuses if a written period straddles two of the layout. Periods that keep
    their label and have one file are not read; those of several files are folded
    in place. New files and layout are published as one version; what they replace
    is then deleted, but for what the newest keep_versions name.
    """
    change = versions.Change(spark, root, "repartition")
    before = _start(change)
    plan = rp.plan_moves(before, layout).orderBy("written").collect()  # a row a period
    out = spark.createDataFrame(plan, "written string, lo int, hi int, period string, verdict string, files long, action string")
    if dry_run:
        return out
    refused = [r for r in plan if r.action == "refuse"]
    if refused:
        raise ValueError("periods do not nest in the layout: " + ", ".join(f"{r.written} ({r.verdict})" for r in refused[:20]))
    work = [r.written for r in plan if r.action in ("move", "fold")]
    if work:
        # whole target periods are rewritten, with what is in them already
        targets = {r.period for r in plan if r.written in work}
        sources = [r.written for r in plan if r.period in targets]
        names = [r.name for r in before.where(F.col("period").isin(sources)).select("name").collect()]  # a name a file
        staged = scratch(spark, "repartition")
        lo.with_period(mg.merged(versions.read_files(spark, root, names), None), layout).write.parquet(staged)
        sinks.write_observations(spark.read.schema(schema.observations()).parquet(staged), change.staged, **sizes)
        sinks.write_layout(layout, f"{root}/_versions/layouts/{change.id}")
        _finish(change, before, names, now, layout=change.id)
        sinks.write_layout(layout, f"{root}/layout.json")  # for readers that go by the file
        versions.vacuum(spark, root, keep_versions)
        if now is not None and tables.exists(spark, f"{root}/_manifest"):
            rebuild_manifest(spark, root, now)
    return out

