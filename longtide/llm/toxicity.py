"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct single words, pairs of neighbours and pairs with one
word between, of the whole text, and the words' first letters (stems, for words
that are inflected), hashed to a fixed number of coordinates. Every
coordinate has its own learning rate and an L1 penalty that leaves most weights
at zero. Shards of the training rows are learned side by side, each in one
task, and their weights averaged; what is left is a small sparse table, which is
broadcast to score the documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import training_labels, usable
from .storage import materialise
from .tokens import text_batches
from .words import Words, mix, packed

BITS = 18
#: Bytes of a word that stand for it as well.
STEMS = (5, 7)
#: The most labelled rows that are learned from, half of each label.
TRAINING_ROWS = 8_000
#: Rows that one task learns from.
SHARD_ROWS = 4_000
PASSES = 10
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 0.01
THRESHOLD = 0.3
#: Bytes that end a word here: ASCII without letters and digits.
_BREAKS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def features(texts: pa.Array, bits: int = BITS) -> list[np.ndarray]:
    """For each text its distinct coordinates, sorted. Letter case of A-Z does not matter."""
    data, offsets = packed(texts)
    words = Words(data, offsets, _BREAKS)
    one = words.hashes()
    two = mix(one[:-1] * np.uint64(3) + one[1:])
    skip = mix(one[:-2] * np.uint64(5) + one[2:] * np.uint64(7))
    shift = np.uint64(64 - bits)
    one, two, skip, *stems = ((x >> shift).astype(np.uint32) for x in (one, two, skip, *(mix(words.hashes(k) + np.uint64(k)) for k in STEMS)))
    out = []
    for a, b in zip(words.firsts[:-1].tolist(), words.firsts[1:].tolist(), strict=True):
        if a == b:
            out.append(np.zeros(0, np.uint32))
            continue
        own = np.sort(np.concatenate((one[a:b], two[a : max(a, b - 1)], skip[a : max(a, b - 2)], *(x[a:b] for x in stems))))
        out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
    return out


class Ftrl:
    """z and n of each coordinate; the last one is the bias, which is not penalised."""

    def __init__(self, bits: int = BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self._alpha, self._beta, self._l1, self._l2, self._bias = alpha, beta, l1, l2, 1 << bits

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(np.asarray(at) == self._bias, 0.0, self._l1)
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((self._beta + np.sqrt(n)) / self._alpha + self._l2))

    def learn(self, coordinates: np.ndarray, label: int) -> None:
        at = np.append(coordinates, self._bias)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self._alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def train(rows: DataFrame, n_rows: int, bits: int = BITS, passes: int = PASSES) -> np.ndarray:
    """Dense float32 weights, the bias last, from n_rows rows (doc_id, text, label), a bounded sample.

    No rows, or rows of one label only, give what they can: weights of zero and
    a bias towards that label.
    """

    def vectorise(batches):
        for batch in text_batches(batches, "text"):
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("label"), pa.array([x.tobytes() for x in features(batch.column("text"), bits)], pa.binary())], ["doc_id", "label", "x"]
            )

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        model, pdf = Ftrl(bits), pdf.sort_values(["order", "doc_id"])
        examples = [(np.frombuffer(x, np.uint32), y) for x, y in zip(pdf.x, pdf.label, strict=True)]
        for _ in range(passes):
            for x, y in examples:
                model.learn(x, y)
        w = model.weights(np.arange(len(model.z)))
        at = np.flatnonzero(w)
        return pd.DataFrame({"at": at, "w": w[at]})

    kind = rows.schema["doc_id"].dataType.simpleString()
    shards = max(1, -(-n_rows // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards))
    found = (
        rows.select("doc_id", "label", "text")
        .mapInArrow(vectorise, f"doc_id {kind}, label int, x binary")
        .withColumns({"shard": shard, "order": F.xxhash64("doc_id", F.lit("order"))})
        .groupBy("shard")
        .applyInPandas(fit, "at long, w double")
        .groupBy("at")
        .agg((F.sum("w") / shards).alias("w"))
        .collect()  # at most 2^bits + 1 weights
    )
    weights = np.zeros((1 << bits) + 1, np.float32)
    for r in found:
        weights[r.at] = r.w
    return weights


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", id: str = "doc_id", bits: int = BITS) -> DataFrame:
    """doc_id, score of every row; texts without a word, null ones too, get the bias alone."""
    at = np.flatnonzero(weights[:-1])
    model = docs.sparkSession.sparkContext.broadcast((at.astype(np.uint32), weights[at], float(weights[-1])))
    kind = docs.select(id).schema[0].dataType.simpleString()

    def apply(batches):
        where, values, bias = model.value
        dense = np.zeros(1 << bits, np.float32)
        dense[where] = values
        for batch in text_batches(batches, "text"):
            margin = np.array([dense[x].sum(dtype=np.float64) for x in features(batch.column("text"), bits)]) + bias
            yield pa.record_batch([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(margin, -35, 35))))], ["doc_id", "score"])

    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(apply, f"doc_id {kind}, score double")


def training_rows_of(docs: DataFrame, ids: DataFrame, most: int) -> DataFrame:
    """doc_id, text, label of at most `most` rows of docs (doc_id, text) with these ids, at most half of them of each label.

    Equal rows are one. Where an id has several texts they are taken in hash
    order, so that copies of some ids can't outgrow the bound.
    """
    keyed = docs.join(F.broadcast(ids), "doc_id").withColumn("digest", F.xxhash64("text"))  # no more ids than rows
    keys = keyed.select("doc_id", "digest", "label").distinct()
    parts = [keys.where(F.col("label") == k).orderBy(F.xxhash64("doc_id", "digest"), "doc_id", "digest").limit(most // 2) for k in (0, 1)]
    chosen = materialise(parts[0].unionByName(parts[1]), "training-rows")
    return keyed.join(F.broadcast(chosen), ["doc_id", "digest", "label"]).groupBy("doc_id", "digest", "label").agg(F.min("text").alias("text")).drop("digest")


def toxicity(docs: DataFrame, labels: DataFrame, held, label: str = "toxic", threshold: float = THRESHOLD, text: str = "text", id: str = "doc_id", training_rows: int = TRAINING_ROWS) -> DataFrame:
    """doc_id, score, predicted (score >= threshold) of every row of docs; labelled ids where held is true are not learned from.

    At most training_rows rows are learned from, half of each label, whatever
    copies ids have. Ids may be of any type that has an order. Repeated rows are scored alike. An empty table of labels gives 0.5 to all.
    """
    ids = materialise(training_labels(labels, label, held, training_rows), "training-ids")
    taken = {r.label: r["count"] for r in ids.groupBy("label").count().collect()}
    rows = training_rows_of(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")), ids, training_rows)
    weights = train(rows, sum(taken.values()))
    if len(taken) == 2:
        # the two labels were not sampled at one rate: the bias goes back to their true odds
        every = {r.label: r.n for r in usable(labels, label, held).groupBy("label").agg(F.count("*").alias("n")).collect()}
        weights[-1] -= np.log(taken[1] / every[1] / (taken[0] / every[0]))
    scored = score(docs, weights, text, id)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
