"""Hard negatives against plain search on whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from longtide.llm import hard_negatives as hn


def plain(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    """anchor, positive, rank, negative and both scores; rows (id, label, vector) that take part."""
    own = [(k, i, l, [math.floor(256 * x) for x in v]) for k, (i, l, v) in enumerate(rows) if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a[3], b[3]))
    out = []
    for a in own:
        if not is_anchor(a[1]):
            continue
        ranked = sorted((-score(a, b), b[1], b[0], b[2]) for b in own if b[0] != a[0])
        for p in [r for r in ranked if r[3] == a[2]][:positives]:
            near = [r for r in ranked if r[3] != a[2] and low * -p[0] <= 100 * -r[0] <= high * -p[0]][:negatives]
            out += [(a[1], p[1], k, r[1], -p[0], -r[0]) for k, r in enumerate(near, 1)]
    return sorted(out)


SCHEMA = "vec_id long, label int, embedding array<float>, row int"


def mined(spark, rows, **options):
    table = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    return sorted(map(tuple, hn.hard_negatives(table, F.col("id") % 4 == 0, **options).collect()))


@pytest.mark.parametrize("size, bits", [(0, 0), (3, 0), (159, 0), (10**6, 0), (10**9, 40), (2**40, 20)])
def test_packed_scores(size, bits):
    """Fields of 64-bit integers, and of wider ones."""
    rng = np.random.default_rng(size)
    c, a = rng.integers(-size, size + 1, (101, 9)), rng.integers(-size, size + 1, (7, 9)) >> bits
    packed = hn.PackedBlock(c, int(np.abs(a).sum(1).max()))
    assert (packed.scores(a) == a.astype(object) @ c.astype(object).T).all()


def test_vectors(spark):
    rng = random.Random(3)
    vector = lambda: [rng.uniform(-0.6, 0.6) for _ in range(8)]
    rows = [(k, rng.randint(0, 2), vector()) for k in range(120)]
    want = plain(rows, lambda i: i % 4 == 0)
    assert len(want) > 300
    assert mined(spark, rows) == want
    # anchors in several passes
    assert mined(spark, rows, anchors_at_once=7) == want
    assert mined(spark, rows, positives=2, negatives=3, low=10, high=100) == plain(rows, lambda i: i % 4 == 0, 2, 3, 10, 100)


def test_ties_copies_and_odd_rows(spark):
    """Scores that are equal, repeated rows and ids, vectors of several lengths, and rows that take no part."""
    rng = random.Random(4)
    few = [[rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(3)] for _ in range(6)]
    rows = [(rng.randint(-8, 40), rng.randint(0, 1), rng.choice(few)) for _ in range(200)]
    rows += [(None, 0, few[0]), (4, None, few[0]), (8, 0, None), (12, 0, [0.1, None, 0.2]), (16, 1, [float("nan"), 0.0, 0.0]), (20, 1, [float("inf"), 0.0, 0.0])]
    assert mined(spark, rows) == plain(rows, lambda i: i % 4 == 0)
    rows = [(4, 0, [0.5]), (5, 0, [0.5, 0.5, 0.1]), (6, 1, [0.3, 0.1]), (7, 1, []), (8, 1, [0.2, 0.4, -0.3]), (9, 0, [-0.5, 0.9])]
    assert mined(spark, rows) == plain(rows, lambda i: i % 4 == 0)


def test_blocks_of_candidates(spark, monkeypatch):
    """First few entries kept over many small blocks."""
    rng = np.random.default_rng(5)
    few = hn.FirstFew(3, 4)
    entries = []
    for _ in range(30):
        scores, ids = rng.integers(-3, 4, (3, 5)), rng.integers(0, 20, 5)
        a, c = np.nonzero(few.may_enter(np.arange(3), scores, ids))
        rows = np.arange(5) + len(entries)
        entries += [(int(k), -int(scores[k, j]), int(ids[j]), int(rows[j])) for k in range(3) for j in range(5)]
        few.add(a, scores[a, c], ids[c], rows[c])
    for k in range(3):
        want = sorted(e[1:] for e in entries if e[0] == k)[:4]
        got = [(-int(s), int(i), int(r)) for s, i, r in zip(few.score[k], few.id[k], few.row[k], strict=True)]
        assert [g[:2] for g in got] == [w[:2] for w in want]


def test_no_rows(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert hn.hard_negatives(table, F.col("id") % 4 == 0).count() == 0
    assert mined(spark, [(1, 0, [0.1]), (2, 1, [0.2])]) == []
