"""Katz scores against plain Python over words, and the tables' sums."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from longtide.llm import katz, queries

SF = "/root/testdata/sf0.001"


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def plain_discounts(counts):
    n = Counter(counts.values())
    for k in range(5, 1, -1):
        if any(not n[r] for r in range(1, k + 2)):
            continue
        past = (k + 1) * n[k + 1] / n[1]
        d = {r: ((r + 1) * n[r + 1] / n[r] / r - past) / (1 - past) for r in range(1, k + 1)} if past < 1 else {1: 2}
        if all(0 < x < 1 for x in d.values()):
            return d
    return {r: (r - 0.5) / r for r in range(1, 6)}


def plain_scores(rows, spread=10**9):
    """(n_tokens, n_known, train_tokens, base, score) of rows (text, learn)."""
    words, pairs = Counter(), Counter()
    for text, learn in rows:
        if learn:
            t = tokens(text)
            words.update(t)
            pairs.update(zip(["<begin>", *t[:-1]], t))
    total, d1, d2 = sum(words.values()), plain_discounts(words), plain_discounts(pairs)
    left = sum(n * (1 - d1.get(n, 1)) for n in words.values())
    of = total + (left <= 0)
    p1 = lambda w: words[w] * d1.get(words[w], 1) / of if words[w] else ((left or 1) / of if total else 1.0)
    after = defaultdict(dict)
    for (v, w), n in pairs.items():
        after[v][w] = n

    def p2(v, w):
        own = after.get(v)
        if not own:
            return p1(w)
        c = sum(own.values())
        c += (c > spread) or not any(n <= 2 for n in own.values())
        if w in own:
            return own[w] * d2.get(own[w], 1) / c
        return p1(w) * (1 - sum(n * d2.get(n, 1) for n in own.values()) / c) / (1 - sum(map(p1, own)))

    out = []
    for text, _ in rows:
        t = tokens(text)
        base = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (len(words) + 1))) for w in t)
        score = sum(math.log10(p2(v, w)) for v, w in zip(["<begin>", *t[:-1]], t))
        out.append((len(t), sum(words[w] > 0 for w in t), total, base, score))
    return out


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert tuple(g)[:3] == w[:3] and g[3] == pytest.approx(w[3], rel=1e-9) and g[4] == pytest.approx(w[4], rel=1e-9)


def drawn(rng, n):
    common = [f"W{min(int(rng.expovariate(0.15)), 60)}" for _ in range(n)]
    return " ".join(x if rng.random() < 0.95 else f"rare{rng.random()}" for x in common)


@pytest.mark.parametrize("bucket, spread", [(10**6, 10**6), (300, 10**6), (300, 80)])
def test_scores(spark, bucket, spread):
    """One bucket, several, and several with contexts spread over them."""
    rng = random.Random(1)
    rows = [(drawn(rng, rng.randint(0, 60)), rng.random() < 0.8) for _ in range(150)]
    rows += [(None, True), ("", False), ("a\x0bA \t a", True), ("never seen before", False), (rows[0][0], True), (rows[0][0], True), ("W0 " * 500, True)]
    table = spark.createDataFrame([(k, t, b, "x") for k, (t, b) in enumerate(rows)], "doc_id long, text string, learn boolean, n string").repartition(3)
    docs = katz.materialise(table, "docs")
    got = sorted(katz.katz_scores(docs, F.col("learn"), bucket_tokens=bucket, spread_tokens=spread).collect())
    assert [r[0] for r in got] == list(range(len(rows)))
    same([r[1:] for r in got], plain_scores(rows, spread))


def test_probabilities_add_up(spark):
    """Of every context: those of its pairs and, by its weight, of all other tokens and of an unknown one."""
    rng = random.Random(2)
    rows = [(drawn(rng, 40), True) for _ in range(60)] + [("b b b " * 20, True)]
    docs = katz.materialise(spark.createDataFrame(rows, "text string, learn boolean").withColumn("doc_id", F.lit("x")), "docs")
    for spread in (10**6, 30):
        words, pairs, contexts = (t.collect() for t in katz.katz_tables(docs, F.col("learn"), bucket_tokens=500, spread_tokens=spread))
        p1 = {r.w: 10**r.log10_p for r in words}
        assert sum(p1.values()) == pytest.approx(1)
        own = defaultdict(dict)
        for r in pairs:
            own[r.v][r.w] = 10**r.log10_p
        weight = {r.v: 10**r.log10_weight for r in contexts}
        assert set(weight) == set(own) and katz.BEGIN in own
        for v, seen in own.items():
            assert sum(seen.values()) + weight[v] * sum(p for w, p in p1.items() if w not in seen) == pytest.approx(1)


def test_nothing_to_learn_and_no_rows(spark):
    docs = katz.materialise(spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None)], "doc_id int, text string"), "docs")
    got = sorted(map(tuple, katz.katz_scores(docs, F.lit(None).cast("boolean")).collect()), key=str)
    assert [r[:4] for r in got] == [(3, 1, 0, 0), (None, 3, 0, 0), (None, 3, 0, 0)] and all(r[5] == 0 for r in got)
    assert katz.katz_scores(docs.limit(0), F.lit(True)).count() == 0


def test_discounts():
    d = katz.discounts([1000, 400, 220, 140, 100, 75])
    assert d[0] == 1 and all(0 < x < 1 for x in d[1:]) and list(d[1:]) == sorted(d[1:])
    assert list(katz.discounts([0] * 6)) == [1.0, 0.5, 0.75, 2.5 / 3, 3.5 / 4, 0.9]


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    learn = [zlib.crc32(str(d.doc_id).encode()) % 10 != 0 for d in docs]
    want = {d.doc_id: w for d, w in zip(docs, plain_scores([(d.text, x) for d, x in zip(docs, learn, strict=True)]), strict=True)}
    got = queries.op12_lm_scoring(spark, SF).collect()
    assert {r.doc_id: not r.held_out for r in got} == {d.doc_id: x for d, x in zip(docs, learn, strict=True)}
    same([r[2:] for r in got], [want[r.doc_id] for r in got])
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) and np.isfinite([r.score for r in got]).all()


def test_frequent_contexts_do_not_meet_in_a_bucket(spark):
    """Words whose names say the same bucket, each with a third of one."""
    alike = [w for w in (f"w{i}" for i in range(400)) if katz.names(katz.pa.array([w.encode()])).view(np.int64)[0] % 8 == 3][:24]
    rng = random.Random(3)
    rows = [(k, " ".join(f"{w} x{rng.random()}" for w in rng.sample(alike, 24)), True) for k in range(60)]
    docs = katz.materialise(spark.createDataFrame(rows, "doc_id long, text string, learn boolean"), "docs")
    counted = katz.Counted(docs, 360, 10**6)
    assert counted.buckets == 9
    sizes = {r.bucket: r.n for r in counted.pairs.groupBy("bucket").agg(F.sum(F.aggregate("n", F.lit(0), lambda a, x: a + x)).alias("n")).collect()}
    assert sum(sizes.values()) == 60 * 49 and max(sizes.values()) < 2 * 360


def test_a_task_adds_up_its_buckets(spark, monkeypatch):
    """However many buckets there are, a text's sums are written once a task; the scores are the same."""
    monkeypatch.setattr(katz, "GROUPS", 2)
    rng = random.Random(4)
    rows = [(k, drawn(rng, 60), rng.random() < 0.8) for k in range(100)]
    docs = katz.materialise(spark.createDataFrame(rows, "doc_id long, text string, learn boolean"), "docs")
    got = sorted(katz.katz_scores(docs, F.col("learn"), bucket_tokens=100).collect())
    same([r[1:] for r in got], plain_scores([r[1:] for r in rows]))
    sums = spark.read.parquet([f for f in katz.materialise.__globals__["scope"]().folders if "pair-sums" in f][-1])
    tasks = 2 * spark.sparkContext.defaultParallelism
    assert sums.select(F.sum(F.size("doc"))).first()[0] <= tasks * len(rows) and sums.where("chunk is null").count() > 50


def test_sums_passed_on_early(monkeypatch):
    """A task that holds too many texts passes on what it has: the same sums in more rows."""
    n = 5
    row = lambda k: {"doc": np.arange(0, n, k), "n_known": np.ones(len(range(0, n, k))), "base": np.full(len(range(0, n, k)), 0.5), "score": np.full(len(range(0, n, k)), 2.0), "small": np.ones(5 * len(range(0, n, k)))}
    head = [katz.pa.array([0, 1, 0], katz.pa.int64()), katz.pa.array([n] * 3, katz.pa.int32()), katz.pa.nulls(3, katz.pa.list_(katz.pa.int64())), katz.pa.nulls(3, katz.pa.list_(katz.pa.int32()))]
    batches = [katz._sums_batch([row(1), row(2), row(3)], head)] * 2
    found = []
    for most in (katz.MOST_HELD, 4):
        monkeypatch.setattr(katz, "MOST_HELD", most)
        total = Counter()
        rows = [r for b in katz._added_up(iter(batches)) for r in b.to_pylist()]
        for r in rows:
            for k, i in enumerate(r["doc"]):
                total.update({(r["chunk"], i, "known"): r["n_known"][k], (r["chunk"], i, "score"): r["score"][k], (r["chunk"], i, "small"): sum(r["small"][5 * k : 5 * k + 5])})
        found.append((len(rows), total))
    assert found[0][0] == 2 < found[1][0] and found[0][1] == found[1][1] and found[0][1][0, 0, "score"] == 8
