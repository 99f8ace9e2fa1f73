"""A corpus pipeline of five stages: rules, exact and near duplicates, mixing, pieces.

Each stage takes (spark, docs, sf_dir) and gives the documents that go on, with
the columns of documents; the last gives one row per document of the mix with
the ids of its n best segmentations and its decoded text's hash.
"""

from __future__ import annotations

import functools
import threading

from pyspark.sql import DataFrame, SparkSession

from longtide.llm import exact_dedup, jaccard_join, mixing, nbest_pieces, quality_rules
from longtide.llm.storage import Scope

_thread = threading.local()


def _stage(f):
    """A stage that first deletes what the stages before it in its run left over, but for what its docs still read.

    The first stage begins a run, with tables of its own; the others go on in the
    run that their thread has begun last. No run deletes another's tables.
    """

    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if f.__name__ == "rules" or not hasattr(_thread, "run"):
            _thread.run = Scope()
        _thread.run.delete_unread(docs)
        with _thread.run:
            return f(spark, docs, sf_dir)

    return run_stage


@_stage
def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their own rules and whose host is kept."""
    return quality_rules.quality_filter(docs)


@_stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one of the largest doc_id."""
    return exact_dedup.exact_dedup(docs)


@_stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8, the one of the smallest doc_id."""
    return jaccard_join.near_dedup(docs)


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: documents as often as they are taken."""
    return mixing.mix_documents(docs)


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document of the mix in pieces: its n best segmentations' ids and scores, and whether all decode to its text."""
    return nbest_pieces.segmentations(docs).drop("best_ids")


STAGES = [("quality rules", rules), ("exact dedup", exact), ("n-gram jaccard join", near), ("mixing", mix), ("sentencepiece", encode)]

#: Near duplicates of a corpus cut by rules, hash-random mixing of what is left and
#: lattice search can't be said in one SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's result, which reads tables of this run; they stay as long as the shared folder does."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        # the stage after the next one deletes it
        path = _thread.run.path(spark, "stage-" + name.replace(" ", "-"))
        result.write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
