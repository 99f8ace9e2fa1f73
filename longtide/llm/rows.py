"""Whole rows as one column, so that their names can't clash with an operator's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(docs: DataFrame) -> Column:
    """All columns of docs as a struct `doc`; select("doc.*") gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")


def order(docs: DataFrame) -> Column:
    """What rows (as `doc`) are ordered by where one of several has to be chosen: all columns of a type that has an order."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    return F.struct(F.lit(0).alias("first"), *[F.col("doc")[c].alias(f"c{k}") for k, c in enumerate(docs.columns) if "map<" not in kinds[c] and "variant" not in kinds[c]])


def others(docs: DataFrame, used) -> Column:
    """The columns of docs that are not used, as a struct `doc`, which is never without a field: the first one's name is longer than any column's."""
    first = F.lit(0).alias("_" * (1 + max(map(len, docs.columns), default=0)))
    return F.struct(first, *[F.col(f"`{c}`") for c in docs.columns if c not in used]).alias("doc")
