"""Mixing sources to target weights.

Every row gets a hash-random key, the MD5 of its doc_id. Within a source the
rows are range-partitioned by that key into as many buckets as its size asks
for, sums of the buckets are added up along the key, and the running sum inside
a bucket finishes the distributed prefix sum. A source whose target is t times
its size is taken floor(t) times whole; the epoch that is left is cut at the
exact word of its budget, in key order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .rows import others
from .storage import materialise
from .words import SPACE, WORD

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
#: Rows of a source to a bucket of the range partitioning, on average; in sources of
#: many rows more, so that neither the buckets nor their rows get too many.
BUCKET_ROWS = 1_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """source, source_size, rows, target of a table (source, size).

    The sources share the sum of all sizes by weight. A target stops at
    max_epochs times its source's size and the excess is shared again by weight
    among the others, until none is above. A source of no words has target 0.

    Stopped targets have the highest weight to size: for a common rate r, target =
    min(max_epochs * size, r * weight). So the order by size / weight decides who
    stops, with running sums, without iterating.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    # one row a source: sums over pre-aggregated rows
    ranked = by_source.withColumn("n", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("n") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(max_epochs))
    order = W.orderBy(F.col("limit") / F.col("weight"), "n")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    ranked = (
        ranked.withColumn("total", F.sum("source_size").over(every))
        .withColumn("weights", F.sum("weight").over(every))
        .withColumn("spent", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        # the rate if exactly the rows before this one are stopped
        .withColumn("rate", (F.col("total") - F.col("spent")) / (F.col("weights") - F.col("gone")))
        .withColumn("stops", F.col("limit") <= F.col("rate") * F.col("weight"))
    )
    first_open = F.min(F.when(~F.col("stops"), F.struct((F.col("limit") / F.col("weight")).alias("k"), "n", "rate"))).over(every)
    return ranked.withColumn("open", first_open).select(
        "source",
        "source_size",
        "rows",
        F.when(F.col("stops") | F.col("open").isNull(), F.col("limit")).otherwise(F.col("open.rate") * F.col("weight")).alias("target"),
    )


def mix(sizes: DataFrame, weights=WEIGHTS, max_epochs: float = MAX_EPOCHS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """row, doc_id, source, size, source_size, target, taken of a table (row, doc_id, source, size).

    taken counts the words that the mix takes of the row, repeats counted:
    floor(target / source_size) whole passes and what the cut leaves of the last
    one, so a source's taken words add up to floor(target). Rows of one doc_id
    are ordered by tie, where sizes has it (a hash of the text), then by size and row; rows without doc_id have their key from it,
    so that they are not all one bucket.
    """
    sizes = materialise(sizes if "tie" in sizes.columns else sizes.withColumn("tie", F.lit(0).cast("long")), "sizes")
    targets = materialise(source_targets(sizes, weights, max_epochs), "targets")
    uniform = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    per_bucket = F.greatest(F.lit(float(bucket_rows)), 4 * F.sqrt("rows"))
    keyed = (
        sizes.withColumn("key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("tie"), F.col("tie").cast("string"))).cast("binary")))
        .join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("bucket", F.floor(uniform * F.ceil(F.col("rows") / per_bucket)).cast("long"))
    )
    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = materialise(sums.select(F.col("source").alias("of"), F.col("bucket").alias("nr"), F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("offset")), "bucket-sums")
    inside = W.partitionBy("source", "bucket").orderBy("key", "doc_id", "tie", "size", "row").rowsBetween(W.unboundedPreceding, -1)
    placed = keyed.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        sums, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("nr"))
    )
    budget = F.floor("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - passes * F.col("source_size")
    start = F.col("offset") + F.col("start")
    taken = passes * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - start))
    return placed.select("row", "doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def document_sizes(docs: DataFrame, text: str = "text", id: str = "doc_id", source: str = "source") -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("tie"))


def mix_documents(docs: DataFrame, text: str = "text", id: str = "doc_id", source: str = "source", n_chars: str = "n_chars", **options) -> DataFrame:
    """The mixed corpus: each row as often as the mix takes it, with docs' columns.

    A row taken 2.5 times comes twice whole and once with the first half of its
    words; only the one row of each source at which its budget ends is cut.
    n_chars, where there is such a column, follows the text. Rows of no words are
    not taken. Columns may have any name and type.
    """
    named = {text: "text", id: "id", source: "source"}
    own = docs.select(others(docs, named), *[F.col(f"`{c}`").alias(n) for c, n in named.items()], word_count(F.col(text)).alias("size"))
    own = materialise(own.withColumn("row", F.monotonically_increasing_id()), "rows")
    mixed = mix(own.select("row", F.col("id").alias("doc_id"), "source", "size", F.xxhash64("text").alias("tie")), **options)
    taken = mixed.where("taken > 0").select("row", "taken")
    copies = own.join(taken, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))))
    left = F.least(F.col("size"), F.col("taken") - (F.col("copy") - 1) * F.col("size"))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"{SPACE}?{WORD}".replace("+?", "*")), F.lit(0)), F.lit(1), left.cast("int")), "")
    out = copies.withColumn("text", F.when(left < F.col("size"), cut).otherwise(F.col("text")))

    def column(c):
        if c == n_chars:
            return F.length("text").cast(docs.schema[c].dataType).alias(c)
        return F.col(named[c]).alias(c) if c in named else F.col("doc")[c].alias(c)

    return out.select(*map(column, docs.columns))
