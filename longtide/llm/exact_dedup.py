"""Exact deduplication by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. The distinct blocks of
all documents are sorted and numbered; that number is the block's name. Then
adjacent names are paired, the distinct pairs sorted and numbered, and so on,
until one name is left of each document. Two documents have the same last
level and name exactly if their texts are equal byte for byte: a name stands
for one pair of names, and a first name for one block's content.

Blocks are compared by content where they are numbered. The text crosses two
shuffles for that, one that makes blocks distinct and one that sorts them, and
copies cross the first of them once a task; occurrences are matched to their
names by a 128-bit routing hash, and should two different blocks ever share one, which the numbering sees,
it starts again with another salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import order, whole
from .storage import discard_since, mark, materialise


def _route(block: Column, salt: int) -> Column:
    return F.struct(F.xxhash64(block).alias("a"), F.xxhash64(F.lit(salt), block).alias("b"))


def _blocks(text: Column, block_bytes: int) -> Column:
    """The text's bytes in blocks; an empty text is one empty block."""
    data = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    last = F.greatest(F.ceil(F.octet_length(data) / F.lit(float(block_bytes))) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes)))


def _sequences(named: DataFrame) -> DataFrame:
    """The names of each row in order; a row's sequence is no longer than its own text."""
    return named.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("s")).select("row", F.col("s.name").alias("names"))


def identities(docs: DataFrame, text: str = "text", id: str = "doc_id", block_bytes: int = 4096, route=_route) -> DataFrame:
    """One row per row of docs: row (a number of this run), doc_id, sha (SHA-256 of the text, bytes), level, name.

    (level, name) is equal for equal texts and for no others. Null texts count
    as empty; repeated rows keep apart by row.
    """
    base = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    salt = 0
    while True:
        rows = materialise(
            base.select(
                F.monotonically_increasing_id().alias("row"),
                "doc_id",
                F.unhex(F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)).alias("sha"),
                F.transform(_blocks(F.col("text"), block_bytes), lambda b: route(b, salt)).alias("routes"),
            ),
            "blocks",
        )
        # one order of all blocks, in which names ascend: by their first bytes, a hash and then all; what is sampled
        # for the ranges is short, and many blocks of one beginning are dealt out by the hash
        distinct = base.select(F.explode(_blocks(F.col("text"), block_bytes)).alias("block")).distinct()
        keys = [F.substring("block", 1, 16), F.xxhash64("block")]
        sorted_blocks = distinct.repartitionByRange(*keys).sortWithinPartitions(*keys, "block")
        first = materialise(sorted_blocks.select(route(F.col("block"), salt).alias("route"), F.monotonically_increasing_id().alias("name")), "names")
        if first.groupBy("route").count().where("count > 1").isEmpty():
            break
        salt += 1
    occurrences = rows.select("row", F.posexplode("routes").alias("pos", "route"))
    state = materialise(_sequences(occurrences.join(first, "route").select("row", "pos", "name")), "level-0")
    done, level = [], 0
    while True:
        done.append(state.where(F.size("names") == 1).select("row", F.lit(level).alias("level"), F.col("names")[0].alias("name")))
        longer = state.where(F.size("names") > 1)
        if longer.isEmpty():
            break
        pairs = longer.select(
            "row",
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(0), F.size("names") - 1, F.lit(2)),
                    lambda i: F.struct(F.get("names", i).alias("left"), F.coalesce(F.get("names", i + 1), F.lit(-1)).alias("right")),
                )
            ).alias("pos", "pair"),
        )
        level += 1
        # written, so that the join below deals both sides anew and a pair of very many rows can be split
        names = materialise(pairs.select("pair").distinct().orderBy("pair").withColumn("name", F.monotonically_increasing_id()), f"names-{level}")
        state = materialise(_sequences(pairs.join(names, "pair").select("row", "pos", "name")), f"level-{level}")
    last = done[0]
    for d in done[1:]:
        last = last.unionByName(d)
    return rows.select("row", "doc_id", "sha").join(last, "row")


def exact_groups(docs: DataFrame, text: str = "text", id: str = "doc_id", block_bytes: int = 4096, route=_route) -> DataFrame:
    """One row per document: row, doc_id, keep_id, group_size, kept, sha.

    Of equal texts the row with the largest doc_id stays; among repeated rows
    of that doc_id exactly one. Null doc_ids are smallest. Null and empty texts
    are one group. An empty table gives no rows.
    """
    before = mark()
    named = materialise(identities(docs, text, id, block_bytes, route), "identities")
    discard_since(docs.sparkSession, before, named)
    groups = materialise(named.groupBy("level", "name").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size")), "groups")
    return named.join(groups, ["level", "name"]).select(
        "row", "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), "sha"
    )


def exact_dedup(docs: DataFrame, text: str = "text", id: str = "doc_id", block_bytes: int = 4096) -> DataFrame:
    """docs without all but one row of equal texts, all columns as they were, whatever their names and types.

    The row that stays is that of the largest doc_id. Where rows repeat with that
    doc_id, the first of them by their other columns stays. Ids may be null and of
    any type that has an order.
    """
    groups = exact_groups(docs, text, id, block_bytes)
    # how often the row that stays is there, with its id and text
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("doc_id", "sha").agg(F.count("*").alias("n"))
    kept = materialise(kept.select(F.col("doc_id").alias("keep_id"), F.col("sha").alias("keep_sha"), "n"), "kept")
    own = docs.select(whole(docs), F.col(id).alias("id"), F.unhex(F.sha2(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8"), 256)).alias("sha"))
    found = own.join(kept, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("sha") == F.col("keep_sha")))
    if kept.where("n > 1").isEmpty():
        return found.select("doc.*")
    # of rows that repeat with id and text the first by the rest of their columns
    several = found.where("n > 1").groupBy("id", "sha").agg(F.min_by("doc", order(docs)).alias("doc")).select("doc.*")
    return several.unionByName(found.where("n = 1").select("doc.*"))
