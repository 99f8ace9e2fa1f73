"""The numbered queries against their SQL on the smallest tables, and the pipeline against its stages by hand."""

import hashlib
from pathlib import Path

import duckdb
import pytest

from longtide.llm import nbest_pieces, queries
from longtide.llm.tokens import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def _plain(df, columns):
    df = df[columns].copy()
    for c in columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].round(6)
    return sorted(map(tuple, df.astype(str).values.tolist()))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, duck, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = duck.execute(queries.ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and _plain(got, columns) == _plain(want, columns)


def test_pipeline(spark):
    import re

    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    by_hand = {}
    rules = queries.QUERIES["op6_quality_rules"](spark, SF)
    kept = {r.doc_id for r in rules.where("kept").collect()}
    left = [d for d in docs if d.doc_id in kept]
    last = {d.text: d for d in sorted(left, key=lambda d: d.doc_id)}
    left = list(last.values())
    sets = []
    for d in left:
        w = [x.lower() if x.isascii() else x for x in words(d.text)]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
    parent = list(range(len(left)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(left)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    for i, d in enumerate(left):
        by_hand.setdefault(find(i), []).append(d.doc_id)
    unique = {min(g) for g in by_hand.values()}
    stage_docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        stage_docs = stage(spark, stage_docs, SF)
        assert stage_docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r.doc_id for r in stage_docs.collect()} == unique
    # mixing: targets by weight, stopped at three times; then whole rounds and a cut in the order of keys
    own = {d.doc_id: d for d in docs}
    sizes = {i: len(words(own[i].text)) for i in unique}
    names = sorted({own[i].source for i in unique}, key=lambda n: (n is None, n or ""))
    size = {n: sum(s for i, s in sizes.items() if own[i].source == n) for n in names}
    weight = {n: 1.0 + k % 3 for k, n in enumerate(names)}
    target, stopped = {}, set()
    while True:
        left = sum(size.values()) - sum(3.0 * size[n] for n in stopped)
        open_ = [n for n in names if n not in stopped]
        target = {n: 3.0 * size[n] for n in stopped} | {n: left * weight[n] / sum(weight[m] for m in open_) for n in open_}
        above = {n for n in open_ if target[n] > 3.0 * size[n]}
        if not above:
            break
        stopped |= above
    taken = {}
    for n in names:
        budget = int(target[n] + 1e-9)
        rounds, rest = divmod(budget, size[n]) if size[n] else (0, 0)
        for i in sorted((i for i in unique if own[i].source == n), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i)):
            cut = min(sizes[i], rest)
            taken[i], rest = rounds * sizes[i] + cut, rest - cut
    mixed = corpus_pipeline.mix(spark, stage_docs, SF).collect()
    got = {}
    for r in mixed:
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words(r.text))
        assert own[r.doc_id].text.startswith(r.text) or r.text == own[r.doc_id].text
    assert got == {i: t for i, t in taken.items() if t}
    # encoding: every document of the mix as often, its best segmentation by a plain dynamic programme
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.decoded_sha256) for r in out) == sorted((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in mixed)
    assert all(r.round_trip and len(r.nbest_ids) == len(r.scores) for r in out)
    vocabulary = nbest_pieces.vocabulary(tokenizer_path(nbest_pieces.MODEL))
    text_of = {hashlib.sha256(r.text.encode()).hexdigest(): r.text for r in mixed}
    for r in sorted(out, key=lambda r: r.doc_id)[:20]:
        text = "▁" + text_of[r.decoded_sha256].replace(" ", "▁")
        best = [0.0]
        for end in range(1, len(text) + 1):
            best.append(max(best[start] + score for start, score, _ in vocabulary.edges_into(text, end)))
        assert r.scores[0] == pytest.approx(best[-1])
