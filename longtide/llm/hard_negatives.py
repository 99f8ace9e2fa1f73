"""Hard negatives of anchors by exact integer scores, several candidates to a multiplication.

Components are whole numbers. Of a block of candidates some are packed into one
wide integer a dimension: each component is made positive and has a field of its
own, wide enough that sums of products with an anchor's components stay inside
it. Multiplying such an integer by an anchor's component multiplies all its
candidates' at once; after adding up over the dimensions each field has a
candidate's score, less what making it positive has added. Where fields fit, the
wide integers are 64-bit; else Python's, which have any width.

Anchors are a stated set. They are taken a bounded number at a time, broadcast,
and held against all candidates where those are read; a task passes on what
may be among an anchor's first few and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import materialise

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
#: Anchors, and components of anchors, that are broadcast at once (32 MB).
ANCHORS_AT_ONCE, COMPONENTS_AT_ONCE = 16_384, 4_000_000
#: Candidates and anchors of a block of scores.
BLOCK = 2048
#: Fields of an integer that has more than 64 bits.
WIDE_FIELDS = 64
_LEAST = np.iinfo(np.int64).min


class PackedBlock:
    """Candidates' components (m x d whole numbers) in fields of wide integers, for anchors whose components' sizes add up to `most` at most."""

    def __init__(self, components: np.ndarray, most: int):
        self.count, dimensions = components.shape
        #: What makes components positive, and what makes sums positive.
        self.bias = int(np.abs(components).max(initial=0))
        self.offset = 2 * self.bias * max(1, most) + 1
        self.width = (2 * self.offset).bit_length()
        self.fields = 62 // self.width or WIDE_FIELDS
        kind = np.int64 if self.width <= 62 else object
        fields = np.zeros((-(-self.count // self.fields) * self.fields, dimensions), kind)
        fields[: self.count] = components.astype(kind) + self.bias
        fields = fields.reshape(-1, self.fields, dimensions)
        self.packed = fields[:, 0].copy()
        for k in range(1, self.fields):
            self.packed += fields[:, k] << (self.width * k)
        self._offsets = sum(self.offset << (self.width * k) for k in range(self.fields))

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products of anchors (n x d) with the candidates, n x m."""
        anchors = anchors.astype(self.packed.dtype)
        # a sum may pass 64 bits on its way; what it ends in does not, and whole numbers wrap around
        sums = anchors @ self.packed.T + self._offsets
        added = self.offset + self.bias * anchors.sum(1)
        mask, out = (1 << self.width) - 1, np.empty((len(anchors), len(self.packed), self.fields), np.int64)
        for k in range(self.fields):
            out[:, :, k] = ((sums >> (self.width * k)) & mask) - added[:, None]
        return out.reshape(len(anchors), -1)[:, : self.count]


class FirstFew:
    """Of each slot the first k entries met so far: higher scores first, then smaller ids, then smaller rows."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score = np.full((slots, k), _LEAST, np.int64)
        self.id, self.row = np.full((slots, k), np.iinfo(np.int64).max, np.int64), np.full((slots, k), -1, np.int64)

    def may_enter(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which entries (slots x candidates) may be among the first k of their slot."""
        last, last_id = self.score[slots, -1][:, None], self.id[slots, -1][:, None]
        enter = scores > last
        tied = scores == last
        if tied.any():
            enter |= tied & (ids[None, :] <= last_id)
        return enter

    def add(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        touched, slot = np.unique(slots, return_inverse=True)
        slot = np.concatenate((np.repeat(np.arange(len(touched)), self.k), slot))
        score, id, row = (np.concatenate((old[touched].ravel(), new)) for old, new in ((self.score, scores), (self.id, ids), (self.row, rows)))
        order = np.lexsort((row, id, ~score, slot))  # ~ turns the order of whole numbers
        place = np.arange(len(order)) - np.searchsorted(slot[order], slot[order])
        order = order[place < self.k]
        for old, new in ((self.score, score), (self.id, id), (self.row, row)):
            old[touched] = new[order].reshape(-1, self.k)

    def entries(self) -> tuple[np.ndarray, ...]:
        """slot, score, id, row of all entries."""
        slot, at = np.nonzero(self.row >= 0)
        return slot, self.score[slot, at], self.id[slot, at], self.row[slot, at]


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """Lists of whole numbers as rows, filled up with zeros."""
    offsets = column.offsets.to_numpy()
    lengths, flat = np.diff(offsets), column.flatten().to_numpy()
    if (lengths == dimensions).all():
        return flat.reshape(-1, dimensions)
    out = np.zeros((len(lengths), dimensions), np.int64)
    of = np.repeat(np.arange(len(lengths)), lengths)
    out[of, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _blocks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[np.ndarray, ...]]:
    """components, label, id, row of some candidates at a time; the first few set what others have to reach."""
    size = BLOCK // 8
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, size)
            yield (_matrix(part.column("components"), dimensions), *(part.column(c).to_numpy() for c in ("label", "id", "row")))
            at, size = at + size, BLOCK


def usable_vectors(vectors: DataFrame, id: str, label: str, vector: str, scale: int = SCALE) -> DataFrame:
    """row, id, label, components of the rows that take part: floor(scale * x) of each x, as double.

    Rows with a null id or label, a null vector, or a component that is null or not finite take no part.
    """
    x = F.col(f"`{vector}`").cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    own = vectors.where(F.col(f"`{id}`").isNotNull() & F.col(f"`{label}`").isNotNull() & F.col(f"`{vector}`").isNotNull() & sound)
    return own.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), F.transform(x, lambda c: F.floor(c * scale)).alias("components")
    )


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k of each group with their rank, of what the tasks have passed on."""
    order = W.partitionBy(*by).orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _searched(candidates: DataFrame, dimensions: int, anchors: dict[str, np.ndarray], slots: int, k: int, look: Callable) -> DataFrame:
    """anchor (its row), slot, score, id, row: of each task's candidates the first k of every slot. look(anchors, few, block) fills them."""
    known = candidates.sparkSession.sparkContext.broadcast(anchors)
    each = slots // max(1, len(anchors["row"]))

    def search(batches):
        held = known.value
        few = FirstFew(slots, k)
        for block in _blocks(batches, dimensions):
            look(held, few, block)
        slot, score, id, row = few.entries()
        if len(slot):
            yield pa.record_batch([held["row"][slot // each], slot % each, score, id, row], ["anchor", "slot", "score", "id", "row"])

    return candidates.select("row", "id", "label", "components").mapInArrow(search, "anchor long, slot long, score long, id long, row long")


def _look_for_positives(held, few, block) -> None:
    components, label, id, row = block
    for own in np.intersect1d(label, held["label"]):
        mine = np.flatnonzero(label == own)
        packed = PackedBlock(components[mine], held["most"])
        anchors = np.flatnonzero(held["label"] == own)
        for part in (anchors[i : i + BLOCK] for i in range(0, len(anchors), BLOCK)):
            scores = packed.scores(held["components"][part])
            a, c = np.nonzero(few.may_enter(part, scores, id[mine]) & (held["row"][part][:, None] != row[mine][None, :]))
            few.add(part[a], scores[a, c], id[mine][c], row[mine][c])


def _look_for_negatives(held, few, block) -> None:
    components, label, id, row = block
    packed = PackedBlock(components, held["most"])
    low, high = held["low"], held["high"]  # n x bands, of scores
    for first in range(0, len(low), BLOCK):
        part = np.arange(first, min(first + BLOCK, len(low)))
        scores = packed.scores(held["components"][part])
        other = held["label"][part][:, None] != label[None, :]
        for band in range(low.shape[1]):
            slots = part * low.shape[1] + band
            inside = other & (scores >= low[part, band][:, None]) & (scores <= high[part, band][:, None])
            a, c = np.nonzero(inside & few.may_enter(slots, scores, id))
            few.add(slots[a], scores[a, c], id[c], row[c])


def hard_negatives(
    vectors: DataFrame, anchor: Column, id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, anchors_at_once: int = ANCHORS_AT_ONCE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of the rows of vectors where `anchor` (over column id) holds.

    Scores are inner products of components floor(scale * x). An anchor's
    positives are the first `positives` other rows of its label; of each, the
    first `negatives` rows of other labels are given whose score is low to high
    percent of the positive's. Higher scores come first, ties by smaller id;
    equal ids are told apart by row. All rows are candidates. Ids and labels are
    whole numbers; rows with a null among id, label and vector, or with a
    component that is null or not finite, take no part. Vectors may differ in
    length: what one lacks counts as zero. A score beyond 64 bits is an error.
    No rows or no anchors give no rows.
    """
    spark = vectors.sparkSession
    # dealt out evenly: what a task does is its candidates times the anchors
    own = materialise(usable_vectors(vectors, id, label, vector, scale), "vectors")
    asked = own.where(anchor)
    count, dimensions = asked.agg(F.count("*"), F.max(F.size("components"))).first()
    passes = max(1, -(-count // anchors_at_once), -(-count * (dimensions or 0) // COMPONENTS_AT_ONCE))
    found = []
    for turn in range(passes if count else 0):
        rows = asked.where(F.pmod(F.xxhash64("row"), F.lit(passes)) == turn).toArrow().combine_chunks()  # about anchors_at_once of them
        if not rows.num_rows:
            continue
        components = _matrix(rows["components"].combine_chunks() if isinstance(rows["components"], pa.ChunkedArray) else rows["components"], dimensions)
        held = {c: rows[c].to_numpy() for c in ("row", "label")} | {"components": components, "most": int(np.abs(components.astype(object)).sum(1).max())}
        own_ids = rows.select(["row", "id"])
        best = _first(_searched(own, dimensions, held, rows.num_rows, positives, _look_for_positives), ["anchor"], positives)
        best = materialise(best.select("anchor", "rank", "score", "id"), "positives")
        # a band of each score that an anchor's positives have
        bands = best.groupBy("anchor").agg(F.array_sort(F.collect_set("score")).alias("scores")).toArrow()
        at = {a: k for k, a in enumerate(held["row"].tolist())}
        lows, highs = np.ones((rows.num_rows, positives), np.int64), np.zeros((rows.num_rows, positives), np.int64)
        for a, scores in zip(bands["anchor"].to_pylist(), bands["scores"].to_pylist(), strict=True):
            lows[at[a], : len(scores)] = [-(-low * s // 100) for s in scores]
            highs[at[a], : len(scores)] = [high * s // 100 for s in scores]
        near = _searched(own, dimensions, held | {"low": lows, "high": highs}, rows.num_rows * positives, negatives, _look_for_negatives)
        near = _first(near, ["anchor", "slot"], negatives)
        # which band a positive has: equal scores share one
        placed = best.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), (F.dense_rank().over(W.partitionBy("anchor").orderBy("score")) - 1).cast("long").alias("slot"))
        named = spark.createDataFrame(own_ids.rename_columns(["anchor", "anchor_id"]))
        both = near.select("anchor", "slot", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(placed, ["anchor", "slot"]).join(named, "anchor")
        found.append(both.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
    if not found:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
