"""The two stateful operators on Structured Streaming: merging deltas, and state by station.

Both keep their table below `out` in generations, one a micro-batch, each
written whole or not at all. A batch that runs again reads what was there before
it and writes the same generation.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..operators.layout import with_period
from ..operators.merge import latest
from ..operators.state import fold_attempts
from ..sources.tables import delete

#: Generations that are kept of a period, and of state.
KEPT = 2
STATE = "station_id long, watermark timestamp_ntz, last_attempt_at timestamp_ntz, last_success_at timestamp_ntz, rows_fetched_total bigint, consecutive_failures int, last_error string"
ATTEMPTS = "station_id long, at timestamp_ntz, status string, max_time timestamp_ntz, rows long, error string"


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return [str(f.getPath().toString()) for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []]


def _generations(spark: SparkSession, out: str) -> list[int]:
    """The generations that are written whole."""
    return sorted(int(re.search(r"generation=(\d+)/_SUCCESS$", f)[1]) for f in _matching(spark, f"{out}/generation=*/_SUCCESS"))


def _newest_folders(spark: SparkSession, out: str, before: int | None = None) -> dict[str, str]:
    """period -> the folder of its newest generation, of those before a batch."""
    whole = {g for g in _generations(spark, out) if before is None or g < before}
    newest: dict[str, tuple[int, str]] = {}
    for folder in _matching(spark, f"{out}/generation=*/period=*"):
        found = re.search(r"generation=(\d+)/period=([^/]+)$", folder)
        if int(found[1]) in whole:
            newest[found[2]] = max(newest.get(found[2], (-1, "")), (int(found[1]), folder))
    return {period: folder for period, (_, folder) in newest.items()}


def _read(spark: SparkSession, out: str, folders: list[str]) -> DataFrame:
    ddl = schema.struct(schema.DELTA + ", generation int, period string")
    rows = spark.read.schema(ddl).option("basePath", out).parquet(*folders) if folders else spark.createDataFrame([], ddl)
    return rows.drop("generation")


def merged_rows(spark: SparkSession, out: str) -> DataFrame:
    """The table that merge_stream keeps: of every period its newest generation."""
    return _read(spark, out, list(_newest_folders(spark, out).values()))


def drop_superseded(spark: SparkSession, out: str, before: int, keep: int = KEPT) -> None:
    """Delete what batches before this one have superseded: of each period all but its newest `keep` whole generations.

    A batch is not run again once the next has begun, so none of these is read by
    a batch any more; `keep` above one is for readers that began earlier.
    """
    whole = {g for g in _generations(spark, out) if g < before}
    of_period: dict[str, list[tuple[int, str]]] = {}
    for folder in _matching(spark, f"{out}/generation=*/period=*"):
        found = re.search(r"generation=(\d+)/period=([^/]+)$", folder)
        if int(found[1]) in whole:
            of_period.setdefault(found[2], []).append((int(found[1]), folder))
    needed = set()
    for generations in of_period.values():
        needed |= {g for g, _ in sorted(generations)[-keep:]}
        delete(spark, [folder for _, folder in sorted(generations)[:-keep]])
    if of_period:
        delete(spark, [f"{out}/generation={g:09d}" for g in whole - needed])


def fold_batch(batch: DataFrame, number: int, out: str, layout: DataFrame | None = None) -> None:
    """Fold a batch of deltas into the table below out, as its generation `number`."""
    own = batch.sparkSession
    drop_superseded(own, out, number)
    placed = with_period(batch, layout) if layout is not None else batch.withColumn("period", F.year("obs_time").cast("string"))
    touched = [r.period for r in placed.select("period").distinct().collect()]  # labels
    known = _newest_folders(own, out, number)
    rows = placed.unionByName(_read(own, out, [known[p] for p in touched if p in known]))
    latest(rows, [*schema.KEYS, "period"]).write.mode("overwrite").partitionBy("period").parquet(f"{out}/generation={number:09d}")


def merge_stream(spark: SparkSession, deltas: str, out: str, checkpoint: str, layout: DataFrame | None = None, files_a_batch: int = 4) -> DataFrame:
    """Fold all delta files that have landed below `deltas` into the table below `out`; the table as it is then.

    A batch reads and writes the periods that it touches and no others. Without
    a layout every year is a period. Rows keep their stamp, hence late or
    repeated deltas can't undo newer ones, however late they are.
    """

    def fold(batch: DataFrame, number: int) -> None:
        fold_batch(batch, number, out, layout)

    stream = spark.readStream.schema(schema.struct(schema.DELTA)).option("maxFilesPerTrigger", files_a_batch).parquet(deltas)
    stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return merged_rows(spark, out)


def station_states(spark: SparkSession, out: str, before: int | None = None) -> DataFrame:
    """The state that run_state_stream keeps, a row a station; before the first batch an empty one."""
    whole = [g for g in _generations(spark, out) if before is None or g < before]
    return spark.read.schema(STATE).parquet(f"{out}/generation={whole[-1]:09d}") if whole else spark.createDataFrame([], STATE)


def run_state_stream(spark: SparkSession, attempts: str, out: str, checkpoint: str, files_a_batch: int = 4) -> DataFrame:
    """The newest state of every station after all attempt files below `attempts`, batch by batch through fold_attempts.

    State is a row a station, so a batch writes all of it. Attempts that land late
    follow the same rules: a late failure counts only if no success is later, and
    failures in state stay until a success that is later than all attempts.
    """

    def fold(batch: DataFrame, number: int) -> None:
        old = [g for g in _generations(batch.sparkSession, out) if g < number][:-KEPT]
        delete(batch.sparkSession, [f"{out}/generation={g:09d}" for g in old])
        state = station_states(batch.sparkSession, out, number)
        fold_attempts(state, batch).write.mode("overwrite").parquet(f"{out}/generation={number:09d}")

    stream = spark.readStream.schema(ATTEMPTS).option("maxFilesPerTrigger", files_a_batch).parquet(attempts)
    stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return station_states(spark, out)
