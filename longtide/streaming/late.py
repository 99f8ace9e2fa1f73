"""Deltas with a revision window: keyed state says which rows are too late, and those go to a table of their own.

State has a row a station: the newest stamp that came in with earlier batches. A
row whose stamp is more than the window below it is late. The others are merged
as they come; late rows are kept beside, for whoever folds them in on purpose. A
station that has been silent for the time to live is forgotten, by a timer on
the time at which batches are read, so state holds the stations that report.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import schema
from .fold import _generations, fold_batch, merged_rows

#: Fixed value: days for which observations are revised.
REVISION_DAYS = 30
#: By how much the driver's clock may go back, after a restart elsewhere, without a row counting as read before.
CLOCK_SLACK = dt.timedelta(days=1)
_MARKED = f"{schema.DELTA}, late boolean"


def marked(deltas: DataFrame, window: dt.timedelta, time_to_live: dt.timedelta, clock_slack: dt.timedelta = CLOCK_SLACK) -> DataFrame:
    """A stream of deltas with `late`: whether ingested_at is more than the window below the station's newest stamp of earlier batches.

    The rows of a station go through in pieces, so a station of very many rows
    takes no more memory than another. A null stamp is late once a stamp is known.
    """
    milliseconds = int(time_to_live / dt.timedelta(milliseconds=1))

    def mark(key: tuple, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        clock = pd.Timestamp(state.get[0]) if state.exists else None
        newest = clock
        for piece in pieces:
            stamps, read_at = piece["ingested_at"], piece["read_at"].max()
            late = (stamps < clock - window) | stamps.isna() if clock is not None else pd.Series(False, piece.index)
            top = stamps.max()
            if not pd.isna(top) and (newest is None or top > newest):
                newest = top
            yield piece.drop(columns="read_at").assign(late=late)
        if newest is not None:
            state.update((newest.to_pydatetime(),))
            state.setTimeoutTimestamp(read_at.value // 1_000_000 + milliseconds)

    # rows carry when they are read, not when they are from: the watermark moves timers and drops nothing
    read = deltas.withColumn("read_at", F.current_timestamp()).withWatermark("read_at", f"{clock_slack // dt.timedelta(milliseconds=1)} milliseconds")
    return read.groupBy("station_id").applyInPandasWithState(mark, schema.struct(_MARKED), schema.struct("newest timestamp_ntz"), "append", GroupStateTimeout.EventTimeTimeout)


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    """The rows that came too late, of all batches that are written whole."""
    paths = [f"{out}/late/generation={g:09d}" for g in _generations(spark, f"{out}/late")]
    return spark.read.schema(schema.struct(schema.DELTA)).parquet(*paths) if paths else spark.createDataFrame([], schema.struct(schema.DELTA))


def revision_stream(
    spark: SparkSession, deltas: str, out: str, checkpoint: str, layout: DataFrame | None = None, window: dt.timedelta = dt.timedelta(days=REVISION_DAYS),
    time_to_live: dt.timedelta = dt.timedelta(days=2 * REVISION_DAYS), files_a_batch: int = 4, clock_slack: dt.timedelta = CLOCK_SLACK,
) -> tuple[DataFrame, DataFrame]:
    """Fold all delta files that have landed below `deltas` into the table below out/merged, late rows into out/late; both as they are then."""

    def fold(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # both tables are of one pass through the state
        try:
            fold_batch(batch.where("not late").drop("late"), number, f"{out}/merged", layout)
            batch.where("late").drop("late").write.mode("overwrite").parquet(f"{out}/late/generation={number:09d}")
        finally:
            batch.unpersist()

    stream = spark.readStream.schema(schema.struct(schema.DELTA)).option("maxFilesPerTrigger", files_a_batch).parquet(deltas)
    marked(stream, window, time_to_live, clock_slack).writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return merged_rows(spark, f"{out}/merged"), late_rows(spark, out)


def stations_known(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What state holds: station_id, newest."""
    return spark.read.format("statestore").load(checkpoint).select(F.col("key.station_id").alias("station_id"), F.col("value.groupState.newest").alias("newest"))
