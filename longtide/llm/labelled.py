"""Bounded, deterministic samples of labelled rows, and applying a broadcast model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text has this remainder; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == remainder


def usable(labels: DataFrame, label: str, held: Column, id: str = "doc_id") -> DataFrame:
    """doc_id, label of the labelled ids that may be learned from.

    Null ids and labels are left out; of contradicting labels of one id the larger holds.
    """
    rows = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull() & ~held)
    return rows.groupBy(F.col(id).alias("doc_id")).agg(F.max(label).cast("int").alias("label"))


def training_labels(labels: DataFrame, label: str, held: Column, most: int, id: str = "doc_id") -> DataFrame:
    """doc_id, label of at most `most` usable ids, half of each label at most, in hash order."""
    rows = usable(labels, label, held, id)
    parts = [rows.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most // 2) for k in (0, 1)]
    return parts[0].unionByName(parts[1])
