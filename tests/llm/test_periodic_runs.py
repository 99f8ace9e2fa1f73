"""Periodic runs against plain search on words."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from longtide.llm import periodic_runs as pr
from longtide.llm import queries

SF = "/root/testdata/sf0.001"


def plain_runs(w, least=24, copies=3):
    """Every period's stretches, kept where no smaller period fits."""
    n, out = len(w), []
    for p in range(1, n // copies + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            length = j + p - i
            if j > i and length >= max(least, copies * p):
                s = w[i : i + length]
                if all(s[q:] != s[:-q] for q in range(1, p)):
                    out.append((i, length, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(1500):
        texts = []
        for _ in range(rng.randint(1, 3)):
            w = []
            while len(w) < rng.randint(0, 60):
                w += [rng.randint(0, 2) for _ in range(rng.randint(1, 5))] * rng.randint(1, 6)
            texts.append(w)
        least = rng.choice([3, 6, 24])
        firsts = np.concatenate(([0], np.cumsum([len(w) for w in texts])))
        found = pr.runs_of(np.array([x for w in texts for x in w], np.int64), firsts, least)
        assert found == [(s + firsts[k], n, p) for k, w in enumerate(texts) for s, n, p in plain_runs(w, least)]


def test_lyndon_words_of_both_orders():
    """Powers against the definition: a Lyndon word is below all its suffixes."""
    rng = random.Random(6)
    for _ in range(300):
        w = [rng.randint(1, 3) for _ in range(rng.randint(1, 25))]
        for own in (w, [4 - x for x in w]):
            longest = []
            for i in range(len(own)):
                j = i + 1
                while j < len(own) and own[j:] > own[i:]:
                    j += 1
                longest.append(j - i)
            want = set()
            for i, p in enumerate(longest):
                root = own[i : i + p]
                if own[i - p : i] == root and i >= p and longest[i - p] == p:
                    continue
                k = 1
                while own[i + k * p : i + (k + 1) * p] == root and longest[i + k * p] == p:
                    k += 1
                if k > 1:
                    want.add((i, p, k))
            assert {(i - 1, p, k) for i, p, k in pr._powers(np.array([0, *own, 0]))} == want


def test_no_two_periods_only():
    with pytest.raises(ValueError):
        pr.runs_of(np.zeros(3, np.int64), np.array([0, 3]), 24, 2)


def test_texts_of_all_kinds(spark):
    loop = " ".join(["a", "b", "c"] * 10)
    rows = [
        (1, None, "x"), (2, "", "x"), (3, " \t\n", None), (4, loop, "x"), (4, loop, "x"), (None, "one " * 30, "x"),
        (5, "p q " + loop + " d " + "z " * 24, "x"), (6, " ".join(f"w{i}" for i in range(50)), "x"), (7, "é " * 30 + "É " * 30, "x"),
        (8, "long " * 200_000, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id int, text string, runs string")
    found = {}
    for r in pr.periodic_runs(docs).collect():
        found.setdefault(r.doc_id, []).append(([tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), r.collapsed))
    assert found[1] == found[2] == found[3] == [([], None, "")]
    assert found[4] == [([(0, 30, 3)], (0, 30, 3), "a b c")] * 2
    assert found[None] == [([(0, 30, 1)], (0, 30, 1), "one")]
    assert found[5] == [([(2, 30, 3), (33, 24, 1)], (33, 24, 1), "p q a b c d z")]
    assert found[6][0][0] == [] and len(found[6][0][2].split()) == 50
    assert found[7] == [([(0, 30, 1), (30, 30, 1)], (0, 30, 1), "é É")]
    assert found[8] == [([(0, 200_000, 1)], (0, 200_000, 1), "long")]
    assert pr.periodic_runs(docs.limit(0)).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {}
    for d in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        h, n = zlib.crc32(str(d.doc_id).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        number = {x: k for k, x in enumerate(dict.fromkeys(w))}
        runs = plain_runs([number[x] for x in w])
        gone = {i for s, m, p in runs for i in range(s + p, s + m)}
        best = next((r for r in runs if all(r[1] * x[2] >= x[1] * r[2] for x in runs)), (None,) * 3)
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want[d.doc_id] = (len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest("".join("%d,%d,%d\n" % r for r in runs)), digest(" ".join(x for i, x in enumerate(w) if i not in gone)))
    got = queries.op11_periodic_runs(spark, SF).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == want and len(got) == len(docs)
    assert sum(r.n_runs for r in got) > 10
