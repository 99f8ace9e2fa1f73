"""Moving an archive to another layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import period_years
from .layout import nesting, with_period
from .merge import merged


def spans(manifest: DataFrame) -> DataFrame:
    """written, lo, hi: the years that each written period's files hold, or of its label where they do not say."""
    years = period_years(F.col("period"))
    return manifest.groupBy("period").agg(F.min(F.year("obs_time_min")).alias("lo"), F.max(F.year("obs_time_max")).alias("hi"), F.count("*").alias("files")).select(
        F.col("period").alias("written"), F.coalesce("lo", years["start_year"]).alias("lo"), F.coalesce("hi", years["end_year"]).alias("hi"), "files"
    )


def plan_moves(manifest: DataFrame, layout: DataFrame) -> DataFrame:
    """written, lo, hi, period, verdict, files, action ('keep', 'fold' of several files, 'move', 'refuse') of every written period."""
    own = spans(manifest)
    judged = nesting(own.select("written", "lo", "hi"), layout).join(own.select("written", "files"), "written")
    action = (
        F.when(F.col("verdict") != "ok", "refuse").when(F.col("written") != F.col("period"), "move").when(F.col("files") > 1, "fold").otherwise("keep")
    )
    return judged.select("written", "lo", "hi", "period", "verdict", "files", action.alias("action"))


def repartitioned(rows: DataFrame, manifest: DataFrame, layout: DataFrame) -> DataFrame:
    """All rows under the new layout's labels, each key once. Refuses if a written period straddles two."""
    refused = plan_moves(manifest, layout).where("action = 'refuse'").select("written", "verdict").limit(20).collect()
    if refused:
        raise ValueError("periods do not nest in the layout: " + ", ".join(f"{r.written} ({r.verdict})" for r in refused))
    return with_period(merged(rows, None), layout)
