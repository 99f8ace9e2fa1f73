"""Per-station state: high-water marks, attempts, quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import short_error

QUARANTINE_AFTER = 10


def merge_marks(states: DataFrame) -> DataFrame:
    """One row a station of several writers' states: the later watermark, null last, ties by the later attempt, then by the other columns."""
    rest = [c for c in states.columns if c not in ("station_id", "watermark", "last_attempt_at")]
    best = states.groupBy("station_id").agg(F.max(F.struct("watermark", "last_attempt_at", *rest)).alias("s"))
    return best.select("station_id", "s.*").select(*states.columns)


def fold_attempts(state: DataFrame, attempts: DataFrame) -> DataFrame:
    """state after attempts (station_id, at, status 'ok' or 'error', max_time, rows, error), early or late ones.

    A mark only moves forward; rows of successes add up in rows_fetched_total. A
    failure counts if it is later than every success, those in state too. A
    success clears the failures in state if it is later than the last attempt in
    it; one that comes in late does not, as it says nothing of the attempts
    after it. last_error is that of the latest failure that counts.
    """
    ok = F.col("status") == "ok"
    successes = attempts.groupBy("station_id").agg(F.max(F.when(ok, F.col("at"))).alias("success_at"))
    known = successes.join(state.select("station_id", "last_success_at"), "station_id", "left")
    last_ok = known.select("station_id", F.greatest("success_at", "last_success_at").alias("last_ok"))
    counts = ~ok & (F.col("last_ok").isNull() | (F.col("at") > F.col("last_ok")))
    new = attempts.join(last_ok, "station_id").groupBy("station_id").agg(
        F.max(F.when(ok, F.col("max_time"))).alias("new_mark"),
        F.max("at").alias("attempt_at"),
        F.max(F.when(ok, F.col("at"))).alias("success_at"),
        F.coalesce(F.sum(F.when(ok, F.col("rows"))), F.lit(0)).alias("new_rows"),
        F.count_if(counts).alias("failures"),
        F.max(F.when(counts, F.struct("at", short_error(F.col("error")).alias("error")))).alias("failure"),
    )
    both = state.join(new, "station_id", "full_outer")
    cleared = F.coalesce(F.col("success_at") > F.col("last_attempt_at"), F.col("success_at").isNotNull() & F.col("last_attempt_at").isNull())
    kept = F.when(cleared, F.lit(0)).otherwise(F.coalesce("consecutive_failures", F.lit(0)))
    newest = F.coalesce(F.col("failure.at") > F.col("last_attempt_at"), F.col("failure").isNotNull()) | (F.col("failure").isNotNull() & (kept == 0))
    return both.select(
        "station_id",
        F.greatest("watermark", "new_mark").alias("watermark"),
        F.greatest("last_attempt_at", "attempt_at").alias("last_attempt_at"),
        F.greatest("last_success_at", "success_at").alias("last_success_at"),
        (F.coalesce("rows_fetched_total", F.lit(0)) + F.coalesce("new_rows", F.lit(0))).cast("bigint").alias("rows_fetched_total"),
        (kept + F.coalesce("failures", F.lit(0))).cast("int").alias("consecutive_failures"),
        F.when(newest, F.col("failure.error")).when(kept > 0, F.col("last_error")).alias("last_error"),
    )


def accepted_rows(rows: DataFrame, attempts: DataFrame, keep_partial: bool) -> DataFrame:
    """Rows of successful attempts; of failed ones too if partial rows are kept (their marks do not move either way)."""
    return rows if keep_partial else rows.join(attempts.where("status = 'ok'").select("station_id").distinct(), "station_id", "left_semi")


def quarantined(state: DataFrame, after: int = QUARANTINE_AFTER) -> DataFrame:
    return state.withColumn("quarantined", F.col("consecutive_failures") >= after)


def worst_stations(state: DataFrame, k: int, after: int = QUARANTINE_AFTER) -> DataFrame:
    """The k stations with most consecutive failures, worst first."""
    return quarantined(state.where("consecutive_failures > 0"), after).orderBy(F.desc("consecutive_failures"), "station_id").limit(k)


def run_summary(attempts: DataFrame, flag_above: float = 0.1) -> DataFrame:
    """rows, attempts, failures, failure_share, flagged."""
    failed = F.sum((F.col("status") != "ok").cast("int"))
    share = F.try_divide(failed, F.count("*"))
    return attempts.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count("*").alias("attempts"), F.coalesce(failed, F.lit(0)).alias("failures"),
        F.coalesce(share, F.lit(0.0)).alias("failure_share"), F.coalesce(share > flag_above, F.lit(False)).alias("flagged"),
    )
