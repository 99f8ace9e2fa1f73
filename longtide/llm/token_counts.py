"""Token counts by a two-tier lookup on the map side.

Tier one is a broadcast table of the corpus's frequent pre-token parts and their
lengths in tokens. Each task counts the parts of all its texts in a bounded
table and hands on those that may be frequent; their sums choose the table. Tier
two is each Python worker's cache of the parts that it met, bounded in bytes.
Counts are the library's whatever is in the tables. Texts' parts are never
shuffled, only the tasks' bounded tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import PartCache, encoder, no_cycle_search, text_batches, tokenizer_path, worker_cache

TOKENIZER = "byte_bpe_50k.json"
#: Entries of the broadcast table at most, of parts up to so many bytes: under 8 MB.
FREQUENT, FREQUENT_BYTES = 50_000, 64
#: Parts that a task counts at once; above it the half with the smallest counts goes.
COUNTED = 200_000
#: A task hands on parts that are one in so many of its own, so 20,000 at most.
SHARE = 20_000
LIMIT = 512
SLICE_BYTES = 2 << 20


def frequent_parts(docs: DataFrame, text: str, path: str, most: int = FREQUENT) -> list[bytes]:
    """The parts that are most frequent in all texts, at most `most`; none for a tokenizer whose texts can't be cut."""
    if encoder(path).cuts is None:
        return []

    def count(batches):
        counts: dict[bytes, int] = {}
        total = 0
        for batch in text_batches(batches, "text", SLICE_BYTES):
            parts = encoder(path).parts(batch.column("text"))
            total += len(parts.codes)
            for p, n in zip(parts.distinct.to_pylist(), np.bincount(parts.codes, minlength=len(parts.distinct)).tolist(), strict=True):
                if len(p) <= FREQUENT_BYTES:
                    counts[p] = counts.get(p, 0) + n
            if len(counts) > COUNTED:
                middle = float(np.median(np.fromiter(counts.values(), np.int64, len(counts))))
                counts = {p: n for p, n in counts.items() if n > middle}
        found = [(p, n) for p, n in counts.items() if n * SHARE >= total]
        yield pa.record_batch([pa.array([p for p, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int64())], ["part", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(count, "part binary, n long").groupBy("part").agg(F.sum("n").alias("n"))
    return [bytes(r.part) for r in counted.orderBy(F.desc("n"), "part").limit(most).collect()]


def token_counts(docs: DataFrame, text: str = "text", id: str = "doc_id", tokenizer: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    Null and empty texts have no tokens; rows may repeat, ids may be null and of
    any type. tokenizer is a .json file of the tokenizers library or a
    sentencepiece .model; where its kind does not allow texts to be cut, whole
    texts are encoded and tier one is empty.
    """
    path = tokenizer_path(tokenizer)
    found = frequent_parts(docs, text, path)
    table = docs.sparkSession.sparkContext.broadcast(dict(zip(found, map(len, encoder(path).ids(found)), strict=True)))

    def count(batches):
        tokens = encoder(path)
        cache = worker_cache("lengths", path, lambda: PartCache(lambda parts: [len(ids) for ids in tokens.ids(parts)], table.value, weigh=lambda n: 0))
        for batch in text_batches(batches, "text", SLICE_BYTES):
            with no_cycle_search():
                parts = tokens.parts(batch.column("text"))
                n = parts.sums(np.array(cache.values(parts.distinct.to_pylist()), np.int64))
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.select(id).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).alias("text"))
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
