"""A quality classifier on random Fourier features of document statistics.

Twenty statistics of the whole text, standardised, are mapped to cosines of
random projections, which approximate a Gaussian kernel. Ridge regression on
them needs only sums of outer products, which slices of the training rows add
up; the scores are then made probabilities by isotonic regression. For that every
training row is scored by weights that its own slice had no part in, which are
the solution of all sums but that slice's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import training_labels, usable
from .storage import materialise
from .tokens import text_batches
from .words import Words, packed, windows

FEATURES = 200
GAMMA = 0.05
RIDGE = 1e-3
SEED = 7
#: The most labelled rows that are learned from, half of each label; they are weighted back to the labels' true odds.
TRAINING_ROWS = 40_000
SLICES = 8
BINS = 1_000
#: Rows of the overall rate that every step of the calibration counts besides its own, so that none is certain.
PRIOR_ROWS = 1.0
THRESHOLD = 0.5

_CLASSES = [
    [c for c in range(256) if chr(c).islower() and c < 128],
    list(range(65, 91)),
    list(range(48, 58)),
    [32],
    [10],
    [9, 11, 12, 13],
    [ord(c) for c in ".,;:"],
    [ord(c) for c in "!?"],
    [ord(c) for c in "#*$%&|<>"],
    [ord(c) for c in "\"'`()[]{}@/\\^~_+=-"],
    list(range(128, 256)),
]
_CLASS = np.full(256, len(_CLASSES), np.uint8)
for _k, _members in enumerate(_CLASSES):
    _CLASS[_members] = _k
_LINE = np.zeros(256, bool)
_LINE[10] = True
N_STATISTICS = len(_CLASSES) + 1 + 8


def _distinct_share(hashes: np.ndarray) -> float:
    return len(np.unique(hashes)) / len(hashes) if len(hashes) else 1.0


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of statistics for each text; those of a text without words are of its bytes alone."""
    data, offsets = packed(texts)
    n = np.diff(offsets)
    kinds = _CLASS[data]
    out = np.zeros((len(n), N_STATISTICS))
    for k in range(len(_CLASSES) + 1):
        run = np.concatenate(([0], np.cumsum(kinds == k)))
        out[:, k] = (run[offsets[1:]] - run[offsets[:-1]]) / np.maximum(n, 1)
    words, lines = Words(data, offsets), Words(data, offsets, _LINE, lower=False)
    hashes, line_hashes = words.hashes(), lines.hashes()
    five = windows(hashes, 5)
    lengths = words.ends - words.starts
    at = len(_CLASSES) + 1
    out[:, at] = np.log1p(words.counts)
    out[:, at + 1] = np.log1p(lines.counts)
    for i in range(len(n)):
        a, b = words.firsts[i], words.firsts[i + 1]
        c, d = lines.firsts[i], lines.firsts[i + 1]
        if b > a:
            own = lengths[a:b]
            out[i, at + 2 :] = own.mean(), own.std(), np.log1p(own.max()), _distinct_share(hashes[a:b]), _distinct_share(five[a : max(a, b - 4)]), _distinct_share(line_hashes[c:d])
    return out


def document_statistics(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """doc_id, x (array<double>) of every row; null is empty."""
    kind = docs.select(id).schema[0].dataType.simpleString()

    def measure(batches):
        for batch in text_batches(batches, "text"):
            yield pa.record_batch([batch.column("doc_id"), pa.array(list(statistics(batch.column("text"))), pa.list_(pa.float64()))], ["doc_id", "x"])

    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(measure, f"doc_id {kind}, x array<double>")


class Model:
    """Standardisation, random features, ridge weights and the steps of the calibration."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES, gamma: float = GAMMA, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.omega = rng.normal(0, np.sqrt(2 * gamma), (len(mean), features))
        self.phase = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.steps = np.array([0.0]), np.array([0.5])

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        cosines = np.cos(z @ self.omega + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack((cosines, np.ones((len(x), 1))))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def probability(self, raw: np.ndarray) -> np.ndarray:
        """Between the calibrated points by straight lines, so that scores keep their order."""
        return np.clip(np.interp(raw, *self.steps), 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The non-decreasing fit to y, weighted by w, in the order of x (pool adjacent violators)."""
    blocks: list[list[float]] = []  # mean, weight, members
    for i in np.argsort(x, kind="stable"):
        blocks.append([y[i], w[i], 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, v, k = blocks.pop()
            blocks[-1] = [(blocks[-1][0] * blocks[-1][1] + m * v) / (blocks[-1][1] + v), blocks[-1][1] + v, blocks[-1][2] + k]
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def calibrated(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The isotonic fit with PRIOR_ROWS of the overall rate in every step; still non-decreasing."""
    fit, rate = isotonic(x, y, w), np.average(y, weights=w)
    starts = np.concatenate(([True], fit[1:] != fit[:-1]))
    size = np.bincount(np.cumsum(starts) - 1, w[np.argsort(x, kind="stable")])[np.cumsum(starts) - 1]
    return np.maximum.accumulate((fit * size + rate * PRIOR_ROWS) / (size + PRIOR_ROWS))


def solve(sums: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge weights of normal equations (features and bias by features, bias and label); the bias is not penalised."""
    k = len(sums)
    penalty = ridge * sums[-1, -2] * np.diag([1.0] * (k - 1) + [0.0]) + 1e-9 * np.eye(k)
    return np.linalg.solve(sums[:, :-1] + penalty, sums[:, -1])


def fit(rows: DataFrame, features: int = FEATURES, gamma: float = GAMMA, ridge: float = RIDGE, seed: int = SEED, slices: int = SLICES, bins: int = BINS) -> Model:
    """A model of rows (doc_id, x, label, weight), a bounded sample. No rows give 0.5 for all."""
    d = N_STATISTICS
    mean_of = lambda c: F.sum(c * F.col("weight")) / F.sum("weight")
    moments = rows.select("weight", F.posexplode("x").alias("k", "v")).groupBy("k").agg(mean_of(F.col("v")).alias("m"), mean_of(F.col("v") * F.col("v")).alias("q")).collect()  # a row a statistic
    if not moments:
        return Model(np.zeros(d), np.ones(d), features, gamma, seed)
    mean, scale = np.zeros(d), np.ones(d)
    for r in moments:
        mean[r.k], scale[r.k] = r.m, max(np.sqrt(max(r.q - r.m * r.m, 0.0)), 1e-6)
    model = Model(mean, scale, features, gamma, seed)
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(slices)).cast("int"))

    def sums(batches):
        total = {}
        for batch in batches:
            x, of, w = model.features(np.array(batch.column("x").to_pylist())), batch.column("slice").to_numpy(), batch.column("weight").to_numpy()
            xy = np.column_stack((x, batch.column("label").to_numpy()))
            for k in np.unique(of):
                own = of == k
                total[int(k)] = total.get(int(k), 0.0) + (x[own] * w[own, None]).T @ xy[own]
        for k, s in total.items():
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([s.tobytes()], pa.binary())], ["slice", "sums"])

    # a slice lies in one partition, so the driver adds as many matrices as there are slices, 0.3 MB each
    by_slice = np.zeros((slices, features + 1, features + 2))
    for r in sliced.repartition(slices, "slice").mapInArrow(sums, "slice int, sums binary").toLocalIterator():
        by_slice[r.slice] += np.frombuffer(r.sums).reshape(features + 1, features + 2)
    total = by_slice.sum(0)
    model.weights = solve(total, ridge)
    others = [total - s for s in by_slice]
    apart = np.stack([solve(s, ridge) if s[-1, -2] > 0 else model.weights for s in others], 1)

    def scores(batches):
        for batch in batches:
            raw = (model.features(np.array(batch.column("x").to_pylist())) * apart[:, batch.column("slice").to_numpy()].T).sum(1)
            yield pa.record_batch([pa.array(raw), batch.column("label"), batch.column("weight")], ["raw", "label", "weight"])

    bin_of = F.round(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), F.col("raw"))) * (bins // 3))
    scored = sliced.mapInArrow(scores, "raw double, label int, weight double").groupBy(bin_of.alias("b"))
    binned = scored.agg(mean_of(F.col("raw")).alias("x"), mean_of(F.col("label")).alias("y"), F.sum("weight").alias("n")).orderBy("x").collect()  # a row a bin
    x, y, w = (np.array([r[k] for r in binned], float) for k in ("x", "y", "n"))
    model.steps = x, calibrated(x, y, w)
    return model


def quality(docs: DataFrame, labels: DataFrame, held, label: str = "quality", threshold: float = THRESHOLD, text: str = "text", id: str = "doc_id", training_rows: int = TRAINING_ROWS) -> DataFrame:
    """doc_id, score, predicted (score >= threshold) of every row of docs; labelled ids where held is true are not learned from.

    The statistics are measured once for all rows and written; training and
    scoring read them. Repeated rows are scored alike.
    """
    measured = materialise(document_statistics(docs, text, id), "statistics")
    ids = training_labels(labels, label, held, training_rows)
    # a label of which only some rows are taken counts for all of them
    odds = usable(labels, label, held).groupBy("label").agg(F.count("*").alias("every")).join(ids.groupBy("label").agg(F.count("*").alias("taken")), "label")
    weighted = ids.join(F.broadcast(odds), "label").select("doc_id", "label", (F.col("every") / F.col("taken")).alias("weight"))  # two rows
    model = fit(materialise(measured.join(weighted, "doc_id"), "training"))
    kind = measured.schema[0].dataType.simpleString()

    def apply(batches):
        for batch in batches:
            x = np.array(batch.column("x").to_pylist()).reshape(-1, N_STATISTICS)
            yield pa.record_batch([batch.column("doc_id"), pa.array(model.probability(model.raw(x)))], ["doc_id", "score"])

    return measured.mapInArrow(apply, f"doc_id {kind}, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
