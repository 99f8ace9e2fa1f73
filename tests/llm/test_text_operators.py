"""The operators on one text column against brute force, with nulls, ties, repeats and odd texts."""

import hashlib
import io
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from longtide.llm import chat_format, exact_dedup, jaccard_join, mixing, nbest_pieces, quality_classifier, quality_rules, token_counts, token_shards, toxicity
from longtide.llm.components import connected
from longtide.llm.labelled import held_out
from longtide.llm.tokens import PartCache, encoder, tokenizer_path
from longtide.llm.words import shingle_sets

#: Columns beside those of documents, with names that operators use inside, and a map, which has no order.
DDL = "doc_id long, text string, lang string, source string, n_chars long, row long, name string, size int, doc int, host_kept int, __hash int, level int, m map<string,int>, `a.b` int"
LONG = " ".join(f"word{i % 997}x{i}" for i in range(30_000))


def _docs(spark, rows):
    """rows (doc_id, text, source) with extra columns that operators use names of."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, "n", 3, 1, 2, 3, 4, {"k": 1}, 5) for i, t, s in rows], DDL)


ODD = [
    (1, "a b c d e f g h i j k l", "s"), (2, "a b c d e f g h i j k l", "s"), (2, "a b c d e f g h i j k l", "s"), (3, None, "s"), (4, "", None), (5, " \n\t ", "t"),
    (None, "a b c d e f g h i j k l", "t"), (None, None, None), (6, "one two", "t"), (7, LONG, "u"), (8, LONG + " end", "u"), (9, "ünï日本 \x0b x" * 3, "u"), (10, "One TWO", "t"),
]


def _empty(spark):
    return _docs(spark, [])


# exact dedup


@pytest.mark.parametrize("block_bytes", [3, 4096])
def test_exact_groups(spark, block_bytes):
    rows = ODD if block_bytes > 3 else [r for r in ODD if r[0] not in (7, 8)] + [(20, "abcdefg" * 9, "s"), (21, "abcdefg" * 9, "s"), (22, "abcdefg" * 9 + "x", "s")]
    got = exact_dedup.exact_groups(_docs(spark, rows), block_bytes=block_bytes).collect()
    assert len(got) == len(rows)
    by_text = {}
    for i, t, _ in rows:
        by_text.setdefault(t or "", []).append(i)
    want = sorted((hashlib.sha256(t.encode()).digest(), len(ids), max((i for i in ids if i is not None), default=None) or -1) for t, ids in by_text.items() for _ in ids)
    assert sorted((bytes(r.sha), r.group_size, r.keep_id or -1) for r in got) == want
    assert sum(r.kept for r in got) == len(by_text)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_names_survive_route_collisions(spark):
    salts = []

    def route(block, salt):
        salts.append(salt)
        return F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")) if salt < 2 else exact_dedup._route(block, salt)

    got = exact_dedup.exact_groups(_docs(spark, [(1, "x", "s"), (2, "y", "s"), (3, "x", "s")]), route=route)
    assert max(salts) == 2 and {r.doc_id: r.keep_id for r in got.collect()} == {1: 3, 2: 2, 3: 3}


def test_exact_dedup_rows(spark):
    out = exact_dedup.exact_dedup(_docs(spark, ODD))
    assert out.columns == _docs(spark, ODD).columns
    assert sorted(((r.doc_id or -1), (r.text or "")) for r in out.collect()) == sorted((max(i or -1 for i, t, _ in ODD if (t or "") == text), text) for text in {t or "" for _, t, _ in ODD})
    assert exact_dedup.exact_dedup(_empty(spark)).count() == 0 and exact_dedup.exact_groups(_empty(spark)).count() == 0


# near duplicates


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _sets(rows, k):
    out = []
    for _, t, _ in rows:
        w = _words(t)
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def _components(rows, k, percent):
    sets = _sets(rows, k)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d if d is not None else -1, len(sets[i]), (least.get(find(i)) if sets[i] else d) or -1) for i, (d, *_) in enumerate(rows))


def _near_rows():
    """A group of many near copies, chains of copies of copies, a passage that many share, and small texts."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: list(rng.choice(vocabulary, n))
    rows, base, passage = [], text(150), text(25)
    for i in range(60):
        copy = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 5)):
            copy[at] = f"e{rng.integers(10**6)}"
        rows.append(copy)
    chain = text(100)
    for i in range(20):
        rows.append(list(chain))
        chain[(7 * i) % 100] = f"c{i}"
    rows += [text(60) + passage for _ in range(40)] + [text(int(n)) for n in rng.integers(1, 8, 30)]
    order = rng.permutation(len(rows))
    return [(int(order[i]) + 1, " ".join(r), "s") for i, r in enumerate(rows)]


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_near_groups(spark, k, percent, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT_FROM", 4)
    rows = _near_rows() + ODD[:6] + ODD[8:]
    rows = [(i + 1000 if i is not None and k >= len(rows) - len(ODD) else i, t, s) for k, (i, t, s) in enumerate(rows)]
    got = jaccard_join.near_groups(_docs(spark, rows).repartition(5), words=k, percent=percent).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id or -1) for r in got) == _components(rows, k, percent)


def test_near_links(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT_FROM", 4)
    odd = [("a b c d e f g", 2), ("A b c d e f g", 1), ("one two", 3), ("", 2), (None, 1)]
    rows = _near_rows() + [(None, t, "s") if k == 0 else (500 + 10 * i + k, t, "s") for i, (t, n) in enumerate(odd) for k in range(n)]
    links, members = jaccard_join.near_links(_docs(spark, rows).repartition(4))
    sets = {}
    for i, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i, t] = frozenset(" ".join(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    own = [sets[i, t] for i, t, _ in rows]
    alike = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    want = sorted((i or -1, len(s), sum(alike(s, o) for o in own) - 1 if s else 0) for (i, *_), s in zip(rows, own, strict=True))
    got = members.collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.n_links) for r in got) == want
    distinct = sorted({s for s in own if s}, key=sorted)
    assert links.count() == sum(alike(a, b) for k, a in enumerate(distinct) for b in distinct[:k]) == links.distinct().count() > 100
    assert len({r.class_id for r in got if r.n_shingles}) == len(distinct) and all(r.class_id is None for r in got if not r.n_shingles)
    links, members = jaccard_join.near_links(_empty(spark))
    assert links.count() == members.count() == 0


def test_near_dedup(spark):
    out = jaccard_join.near_dedup(_docs(spark, ODD))
    assert sorted((r.doc_id or -1) for r in out.collect()) == [-1, 1, 3, 4, 5, 6, 7, 9]
    assert jaccard_join.near_dedup(_empty(spark)).count() == 0


def test_ids_of_text(spark):
    texts = [" ".join(f"{c}{i}" for i in range(20)) for c in "ab"]
    rows = [("d3", texts[0] + " end", "s"), ("d10", texts[0], "s"), ("x", texts[1], "t"), (None, texts[1], "t"), ("x", texts[1], "t")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    assert {(r.doc_id, r.component_id) for r in jaccard_join.near_groups(docs).collect()} == {("d3", "d10"), ("d10", "d10"), ("x", "x"), (None, "x")}
    assert sorted(r.doc_id for r in jaccard_join.near_dedup(docs).collect()) == ["d10", "x"]
    assert sorted(r.doc_id for r in exact_dedup.exact_dedup(docs).collect()) == ["d10", "d3", "x"]
    assert mixing.mix_documents(docs).columns == docs.columns
    assert [r.doc_id for r in token_counts.token_counts(docs).collect()] == [r[0] for r in rows]


def test_rows_are_picked_alike_by_filter_and_by_join(spark, monkeypatch):
    rows = _near_rows()
    want = _components(rows, 5, 80)
    monkeypatch.setattr(jaccard_join, "MOST_FILTERED", 10)
    got = jaccard_join.near_groups(_docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_a_hot_passage_makes_no_pairs_of_unrelated_texts(spark, monkeypatch):
    """A passage that all of many dissimilar texts share is late in the order, so its bucket stays out of prefixes."""
    rng = np.random.default_rng(3)
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 10**6, 60)) + " " + passage, "s") for i in range(2000)]
    seen = []
    monkeypatch.setattr(jaccard_join, "_open_pairs", lambda buckets, *rest: seen.append(buckets.count()) or _open_pairs(buckets, *rest))
    got = jaccard_join.near_groups(_docs(spark, rows)).collect()
    assert {r.doc_id for r in got if r.doc_id == r.component_id} == set(range(2000)) and seen[0] < 2000


_open_pairs = jaccard_join._open_pairs


def test_near_dedup_keeps_unrelated_rows_of_one_id(spark):
    texts = [" ".join(f"{c}{i}" for i in range(20)) for c in "abcde"]
    a, b, c, d, e = texts
    rows = [(None, a, "s"), (None, a + " more", "s"), (None, b, "s"), (None, b, "s"), (None, e, "s"), (5, c, "s"), (5, c, "s"), (5, d, "s"), (5, d + " more", "s"), (None, d + " end", "s"), (6, c + " end", "s")]
    empty = [(None, None, "s"), (None, "", "s"), (5, None, "s"), (5, None, "s")]
    out = jaccard_join.near_dedup(_docs(spark, rows + empty).repartition(3)).collect()
    assert sorted((r.doc_id or -1, r.text[:2]) for r in out if r.text) == [(-1, "a0"), (-1, "b0"), (-1, "e0"), (5, "c0"), (5, "d0")]
    assert sorted((r.doc_id or -1, r.text or "") for r in out if not r.text) == [(-1, ""), (-1, ""), (5, ""), (5, "")]
    # without repeated rows
    out = jaccard_join.near_dedup(_docs(spark, [(None, a, "s"), (None, b, "s"), (5, c, "s"), (5, d, "s"), (5, d + " more", "s")])).collect()
    assert sorted((r.doc_id or -1, r.text[:2]) for r in out) == [(-1, "a0"), (-1, "b0"), (5, "c0"), (5, "d0")]


def test_matches_asked():
    assert jaccard_join.matches_asked(np.ones(200), 170, 85) == 1
    assert jaccard_join.matches_asked(np.array([1.0] * 5 + [500.0] * 195), 170, 85) > 1
    # frequent shingles that come too late for a link to a set of the same size
    assert jaccard_join.matches_asked(np.array([1.0] * 20 + [500.0] * 180), 170, 85) == 1


def test_bitmaps_never_exceed_the_difference():
    rng = np.random.default_rng(2)
    for n, m in ((1, 1), (300, 280), (1500, 1300), (5000, 900), (3000, 3000)):
        x, y = (np.unique(rng.integers(0, 2**63, k).astype(np.uint64)) for k in (n, m))
        y[: m // 2] = x[: m // 2]
        x, y = np.unique(x), np.unique(y)
        bits = jaccard_join.bits_between(jaccard_join.parity_bitmap(x), jaccard_join.parity_bitmap(y))
        assert bits <= len(np.setxor1d(x, y)) and bits == jaccard_join.bits_between(jaccard_join.parity_bitmap(y), jaccard_join.parity_bitmap(x))
        assert jaccard_join.bits_between(jaccard_join.parity_bitmap(x), jaccard_join.parity_bitmap(x)) == 0


def test_connected(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.id: r.label for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 90, 90: 90, 95: 90}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingles_of_odd_texts():
    texts = ["A b c d e", "a B c d e", "a b c", "", None, "a  b\tc\x0bd", "a b c d"]
    sets = shingle_sets(pa.array(texts), 4)
    assert [len(s) for s in sets] == [2, 2, 1, 0, 0, 1, 1] and (sets[0] == sets[1]).all() and (sets[5] == sets[6]).all() and sets[2] not in sets[5]
    assert (shingle_sets(pa.array(texts).slice(5), 4)[0] == sets[5]).all()


# quality rules


def _rules(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i : i + 5]), []).append(i)
    repeats = {j for spots in at.values() if len(spots) > 1 for i in spots for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeats)


def test_base_rules(spark):
    texts = [t for _, t, _ in ODD] + ["a b c d e " * 7, "x\nx\n \nx y\nx y", "# * $ % & | < > words\x1fhere", "p q r s t p q r s t u", "a a a a a a a"]
    got = quality_rules.base_rules(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")).orderBy("doc_id").collect()
    for r, t in zip(got, texts, strict=True):
        want = _rules(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_hosts(spark):
    good, bad = " ".join(f"w{i}" for i in range(20)), "few words"
    rows = [(i, bad if i % 10 else good, "bad") for i in range(200)] + [(1000 + i, bad if i == 0 else good, "good") for i in range(200)] + [(5000, bad, "small"), (5001, good, None)]
    got = {r.doc_id: r for r in quality_rules.judged(_docs(spark, rows)).collect()}
    assert not got[0].kept and not got[0].base_failed  # a good page of a host that goes
    assert got[1001].kept and not got[1000].kept and got[5001].kept
    assert got[5000].host_rate < 1  # one page does not condemn its host
    assert {r.source for r in quality_rules.quality_filter(_docs(spark, rows)).collect()} == {"good", None}
    assert quality_rules.judged(_empty(spark)).count() == 0 and quality_rules.quality_filter(_empty(spark)).count() == 0


# mixing


def test_mixing(spark):
    rows = [(i, " ".join(["w"] * (i % 7)), f"s{i % 5}" if i % 11 else None) for i in range(300)] + [(900, None, "none"), (7, "x y z", "s2"), (7, "x y z", "s2"), (None, "x", "s2")]
    docs = _docs(spark, rows)
    got = mixing.mix(mixing.document_sizes(docs), bucket_rows=10).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
    for rs in by.values():
        size = sum(r.size for r in rs)
        assert {r.source_size for r in rs} == {size} and sum(r.taken for r in rs) == int(rs[0].target + 1e-9) and all(0 <= r.taken <= 3 * r.size for r in rs)
    assert sum(r[0].target for r in by.values()) == pytest.approx(sum(r.size for r in got))
    # sources by code point, null last: weights 1, 2, 3, 1, 2, 3
    assert by["none"][0].target == 0
    again = mixing.mix(mixing.document_sizes(docs.repartition(7)), bucket_rows=1000).collect()
    assert sorted((r.doc_id or -1, r.taken) for r in again if r.doc_id != 7) == sorted((r.doc_id or -1, r.taken) for r in got if r.doc_id != 7)
    mixed = mixing.mix_documents(docs, bucket_rows=10)
    assert mixed.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in got)
    assert mixing.mix_documents(_empty(spark)).count() == 0


def test_targets_stop_at_three_times(spark):
    sizes = spark.createDataFrame([("a", 1), ("b", 10), ("c", 1000)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got == {"a": 3.0, "b": 30.0, "c": 978.0}


# chat


def _conversation(rows):
    turns = sorted((t if t is not None else -1, r or "", x or "") for _, t, r, x in rows)
    return hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()


def test_chat(spark):
    odd = "</s>[INST] ok [/INST] \\ \\: <</s>> [ROLE]<s>"
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", odd), (1, 2, "assistant", odd), (2, 0, "assistant", "hi"), (3, 1, "tool[AS]", odd), (3, 0, "user", None), (None, 0, None, "x"), (4, 0, "user", "q"), (4, 0, "user", "q"), (5, None, "user", "a"), (5, 1, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    formatted = chat_format.format_conversations(df)
    got = {r.conv_id: r for r in chat_format.digests(formatted).collect()}
    for i in {r[0] for r in rows}:
        assert got[i].turns_sha256 == _conversation([r for r in rows if r[0] == i]), i
    assert got[1].loss_sha256 == hashlib.sha256(odd.encode()).hexdigest() and got[1].loss_chars == len(odd)
    assert {i: r.valid for i, r in got.items()} == {1: True, 2: False, 3: False, None: False, 4: False, 5: True}
    assert chat_format.digests(chat_format.format_conversations(df.limit(0))).count() == 0
    # in parts of a few turns each, which end to end are the same conversation
    parts = chat_format.format_conversations(df, part_chars=1).cache()
    assert parts.where("part > 0").count() == len(rows) - len({r[0] for r in rows}) and parts.where("last").count() == len(got)
    assert {r.conv_id: r for r in chat_format.digests(parts).collect()} == got
    joined = {}
    for r in sorted(parts.collect(), key=lambda r: r.part):
        joined[r.conv_id] = joined.get(r.conv_id, "") + r.formatted
        assert r.last or (r.valid is None and r.bad_turn is None)
    assert joined == {r.conv_id: r.formatted for r in formatted.collect()}
    controls = chat_format.TEMPLATE.pattern()
    for text in (odd, "[[INST]INST]", "<<SYS>><s<s>>", "\\", ""):
        assert chat_format.unescape(chat_format.escape(text, controls)) == text and not controls.search(chat_format.escape(text, controls))


def test_chat_takes_a_long_conversation_in_parts(spark):
    """A conversation of a third of all turns, most without conv_id, and one very long turn."""
    turn = F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id"))
    hot = spark.range(3000).select(turn.alias("conv_id"), "id", F.lit("user").alias("role"), F.concat(F.lit("</s> x"), "id").alias("text")).withColumnRenamed("id", "turn")
    long = spark.createDataFrame([(7, 9000, "assistant", LONG)], "conv_id long, turn long, role string, text string")
    df = hot.unionByName(long)
    formatted = chat_format.format_conversations(df, part_chars=2000).cache()
    assert formatted.where("conv_id IS NULL").agg(F.max(F.length("formatted"))).first()[0] < 2100 and formatted.where("conv_id IS NULL").count() > 5
    got = {r.conv_id: r for r in chat_format.digests(formatted).collect()}
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    assert got[None].turns_sha256 == _conversation([r for r in rows if r[0] is None]) and got[None].n_turns == 1000
    assert got[7].turns_sha256 == _conversation([r for r in rows if r[0] == 7]) and got[7].loss_chars == len(LONG) and got[7].valid


# tokens

TOKEN_TEXTS = ["", None, "Hello world", "a  b\n\nc \t d ", "<|endoftext|>x <|endoftext|>", " \n <|endoftext|>", "don't we'll ü 日本語 x\x1cy\x85z", "trailing ", "\nlead", "." * 200, "a" * 500, LONG[:5000]]


def _ids(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_parts_have_the_library_s_ids():
    tokens = encoder(tokenizer_path("byte_bpe_50k.json"))
    rng = np.random.default_rng(0)
    bits = [" ", " ", "  ", "\n", "\n", "\t", "ab", "B", "12", "'s", "'", "é", "\u00a0", "\u3000", "\u2003", "\x1c", "\x85", "<|endoftext|>", "<|", "|>", ".", ",", "!", "_", "日本", "\r\n", "\ufeff", "«", "—", "\0", "ª", "٣"]
    texts = [t for t in TOKEN_TEXTS if t] + ["".join(rng.choice(bits, rng.integers(0, 14))) for _ in range(4000)]
    cache = PartCache(lambda parts: [np.array(ids, "<u2").tobytes() for ids in tokens.ids(parts)], most_bytes=20_000)
    for k in range(0, len(texts), 200):
        some = texts[k : k + 200]
        parts = tokens.parts(pa.array(some))
        values = cache.values(parts.distinct.to_pylist())
        data, at = parts.spread(values)
        at = at[parts.firsts]
        lengths = parts.sums(np.array([len(v) for v in values]))
        for i, ids in enumerate(_ids(some)):
            assert np.frombuffer(data[at[i] : at[i + 1]].tobytes(), "<u2").tolist() == ids and lengths[i] == 2 * len(ids), some[i]
    assert len(cache._young) + len(cache._old) < 4000  # it forgets


def test_token_counts(spark):
    docs = _docs(spark, [(i, t, "s") for i, t in enumerate(TOKEN_TEXTS)])
    got = token_counts.token_counts(docs).orderBy("doc_id").collect()
    for r, t, ids in zip(got, TOKEN_TEXTS, _ids(TOKEN_TEXTS), strict=True):
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((t or "").encode()), len(ids), len(ids) > 512)
    assert token_counts.token_counts(_empty(spark)).count() == 0


def test_frequent_parts_are_of_all_texts(spark):
    rows = [(i, "common " * 40 + f"rare{i} x{i}", "s") for i in range(50)] + [(99, "late " * 3000, "s")]
    found = token_counts.frequent_parts(_docs(spark, rows).repartition(3), "text", tokenizer_path("byte_bpe_50k.json"), most=2)
    assert found == [b" late", b" common"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(spark, tmp_path, name):
    """Whole texts by the library where they can't be cut."""
    import sentencepiece
    from tokenizers import Tokenizer

    path = tokenizer_path(name)
    if name.endswith(".json"):
        library = Tokenizer.from_file(path)
        want = [library.encode(t or "", add_special_tokens=False).ids for t in TOKEN_TEXTS]
    else:
        want = sentencepiece.SentencePieceProcessor(model_file=path).encode([t or "" for t in TOKEN_TEXTS])
    docs = _docs(spark, [(i, t, "s") for i, t in enumerate(TOKEN_TEXTS)])
    assert [r.n_tokens for r in token_counts.token_counts(docs, tokenizer=name).orderBy("doc_id").collect()] == [len(x) for x in want]
    out = token_shards.round_trip(docs, tokenizer=name, end_id=70_000).orderBy("doc_id").collect()  # an id that needs four bytes
    assert [r.ids_crc32 for r in out] == [zlib.crc32(np.array(x + [70_000], "<u4")) for x in want]


def test_token_shards(spark, tmp_path):
    rows = [(3 * i - 5, t, "s") for i, t in enumerate(TOKEN_TEXTS)] + [(-5, "again", "s"), (None, "no id", "s")]
    got = token_shards.round_trip(_docs(spark, rows)).collect()
    at, want = 0, []
    for (d, _, _), ids in sorted(zip(rows, _ids([t for _, t, _ in rows]), strict=True), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[0][1] or "")):
        want.append((d, at, len(ids) + 1, zlib.crc32(np.array(ids + [0], "<u4"))))
        at += len(ids) + 1
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert token_shards.round_trip(_empty(spark)).count() == 0


@pytest.mark.parametrize("text", [False, True])
def test_shard_lookup(text):
    rng = np.random.default_rng(1)
    ids = {int(d): rng.integers(0, 50_000, rng.integers(1, 3000)).astype("<u2") for d in rng.integers(-(2**62), 2**62, 300)}
    if text:
        ids = {f"doc/{d}/ü": x for d, x in ids.items()}
    file = io.BytesIO()
    writer = token_shards.ShardWriter(file, 2)
    for d in sorted(ids, key=token_shards.encode_key):
        writer.add(token_shards.encode_key(d), ids[d].tobytes())
    writer.close()
    shard = token_shards.Shard(file)
    assert len(shard._index) > 3 and shard.documents == 300
    assert all((shard.get(d) == x).all() for d, x in ids.items())
    assert not any(shard.get(d + ("x" if text else 1)) is not None for d in ids) and shard.get(None) is None
    assert [d for block in shard.blocks() for d, _, _ in block] == sorted(ids, key=token_shards.encode_key)


def test_shards_of_bounded_size_and_text_ids(spark, tmp_path):
    """Many small shards: positions go on over files and partitions."""
    rows = [(f"d{i:03d}" if i else None, f"text {i} " * (i % 5), "s") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    files = token_shards.write_shards(docs, f"file://{tmp_path}/out", shards=3, shard_bytes=300).cache()
    assert files.count() > 6 and files.agg(F.sum("documents")).first()[0] == 200
    starts = {r.shard: r.before for r in token_shards.shard_starts(files).collect()}
    got = sorted((starts[r.shard] + r.start, r.doc_id, r.n_tokens) for r in token_shards.read_digests(spark, f"file://{tmp_path}/out", "string").collect())
    assert [d for _, d, _ in got] == [None] + [f"d{i:03d}" for i in range(1, 200)]
    assert [at for at, _, _ in got] == [sum(n for _, _, n in got[:k]) for k in range(200)]
    with token_shards.open_shard(f"file://{tmp_path}/out/" + min(starts)) as shard:
        assert shard.get("d001").tolist() == _ids(["text 1 "])[0] + [0]


def test_read_shards(spark, tmp_path):
    token_shards.write_shards(_docs(spark, [(2, "b", "s"), (1, "a b", "s")]), f"file://{tmp_path}/out", shards=2).collect()
    got = token_shards.read_shards(spark, f"file://{tmp_path}/out").orderBy("doc_id").collect()
    assert [list(r.ids) for r in got] == [x + [0] for x in _ids(["a b", "b"])]


# pieces


def _every(text, words):
    """All segmentations (score, ids), best first."""
    out = []

    def go(at, score, ids):
        if not at:
            out.append((score, ids))
        for start, s, x in words.edges_into(text, at) if at else ():
            go(start, score + s, x + ids)

    go(len(text), 0.0, ())
    return sorted(out, key=lambda x: -x[0])


def test_n_best_against_all_segmentations():
    words = nbest_pieces.vocabulary(tokenizer_path(nbest_pieces.MODEL))
    texts = ["▁hello", "▁▁the", "▁añÿ", "▁in.日", "\n", "▁x🙂y", "▁▁▁", "▁", "aaaaaaaa", "🙂", "-----", "▁international"]
    solved = nbest_pieces.best_and_drop(texts, words)
    for text, (best, drop, ids) in zip(texts, solved, strict=True):
        want = _every(text, words)
        got = nbest_pieces.n_best(text, words, 6)
        assert [s for s, _ in got] == pytest.approx([s for s, _ in want[:6]])
        assert len({ids for _, ids in got}) == len(got) and set(got) <= set(want)
        assert (best, tuple(np.frombuffer(ids, "<u4").tolist())) in want and best == want[0][0]
        assert drop == (want[0][0] - want[1][0] if len(want) > 1 else np.inf)


def test_segmentations_of_whole_texts_against_all():
    """Texts of several parts: the n best scores of all, and ids that have these scores."""
    words = nbest_pieces.vocabulary(tokenizer_path(nbest_pieces.MODEL))
    texts = ["the cat", "a\nb", " x", "no.", "on, é", "", "aa aa", "to --"]
    for n in (1, 2, 4, 7):
        got = nbest_pieces.encode_batch(pa.array(texts), words, nbest_pieces._solved(words), nbest_pieces._searched(words, n), n)
        for text, scores, ids in zip(texts, got["scores"].to_pylist(), got["nbest_ids"].to_pylist(), strict=True):
            want = _every("▁" + text.replace(" ", "▁"), words) if text else [(0.0, ())]
            assert scores == pytest.approx([s for s, _ in want[:n]])
            of = {i: s for s, i in want}
            assert [of[tuple(i)] for i in ids] == pytest.approx(scores) and len(set(map(tuple, ids))) == len(ids)


@pytest.mark.parametrize("unit", ["a", " ", "-", "ab", "🙂", "日本", "x\n"])
def test_long_texts_without_breaks_take_time_in_proportion(unit):
    """Equal scores everywhere: one path is finished before others like it are opened."""
    words = nbest_pieces.vocabulary(tokenizer_path(nbest_pieces.MODEL))

    def took(n):
        began = time.process_time()
        got = nbest_pieces.encode_batch(pa.array([unit * (n // len(unit))]), words, nbest_pieces._solved(words), nbest_pieces._searched(words, 4), 4)
        assert got["round_trip"].to_pylist() == [True] and len(set(map(tuple, got["nbest_ids"].to_pylist()[0]))) == len(got["scores"].to_pylist()[0])
        return time.process_time() - began

    took(1000)
    assert took(100_000) < 30 * max(took(10_000), 0.1)


def test_segmentations(spark):
    texts = ["", None, "the cat", " two  spaces ", "a\nb\n", "🙂 ÿ", LONG[:20_000], "the cat"]
    docs = _docs(spark, [(i, t, "s") for i, t in enumerate(texts)])
    out = nbest_pieces.segmentations(docs).orderBy("doc_id").collect()
    words = nbest_pieces.vocabulary(tokenizer_path(nbest_pieces.MODEL))
    for r, t in zip(out, texts, strict=True):
        assert r.round_trip and r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest() and r.n_pieces == len(r.best_ids)
        assert sorted(r.scores, reverse=True) == r.scores
        assert words.decode(r.best_ids) == (t or "")
    whole = _every("▁the▁cat", words)[:4]
    assert out[2].scores == pytest.approx([s for s, _ in whole]) and out[2].nbest_crc32[0] == zlib.crc32(np.array(whole[0][1], "<u4"))
    decoded = nbest_pieces.decode(nbest_pieces.segmentations(docs)).orderBy("doc_id").collect()
    assert [r.decoded for r in decoded] == [t or "" for t in texts]
    assert nbest_pieces.segmentations(_empty(spark)).count() == 0


def test_all_segmentations_are_given_out(spark, tmp_path):
    import corpus_pipeline
    from longtide.llm import queries

    texts = ["", None, "the cat", " two  spaces ", "a\nb\n", "🙂 ÿ", LONG[:20_000]]
    docs = _docs(spark, [(i, t, "s") for i, t in enumerate(texts)])
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    words = nbest_pieces.vocabulary(tokenizer_path(nbest_pieces.MODEL))
    for out in (nbest_pieces.segmentations(docs), queries.op10_sentencepiece_nbest(spark, f"file://{tmp_path}"), corpus_pipeline.encode(spark, docs, "")):
        got = out.orderBy("doc_id").collect()
        for r, t in zip(got, texts, strict=True):
            every = [tuple(ids) for ids in r.nbest_ids]
            assert len(set(every)) == len(every) == len(r.scores) <= 4 and r.round_trip
            assert [words.decode(ids) for ids in every] == [t or ""] * len(every)
            assert r.nbest_crc32 == [zlib.crc32(np.array(ids, "<u4")) for ids in every] and r.n_pieces == len(every[0])
        assert [len(r.nbest_ids) for r in got if r.doc_id in (0, 1, 2, 6)] == [1, 1, 4, 4]
        score = {ids: s for s, ids in _every("▁the▁cat", words)}
        assert [score[tuple(ids)] for ids in got[2].nbest_ids] == pytest.approx(sorted(score.values(), reverse=True)[:4])


# classifiers


def _labelled(spark, kind):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    return docs, labels, labels.select("doc_id", F.col(kind).alias("truth"))


def test_toxicity_held_out(spark):
    docs, labels, truth = _labelled(spark, "toxic")
    held = held_out(F.col("doc_id"), 4, 2)
    got = toxicity.toxicity(docs, labels, held).join(truth, "doc_id").where(held).toPandas()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    assert (got.predicted[got.truth == 0] == 0).mean() > 0.95 and got.score[got.truth == 1].mean() > 5 * got.score[got.truth == 0].mean()


def test_quality_held_out(spark):
    docs, labels, truth = _labelled(spark, "quality")
    held = held_out(F.col("doc_id"), 3, 1)
    got = quality_classifier.quality(docs, labels, held).join(truth, "doc_id").where(held).toPandas()
    assert got.score.between(0, 1).all() and (got.predicted == got.truth).mean() > 0.93


@pytest.mark.parametrize("operator", [toxicity.toxicity, quality_classifier.quality])
def test_classifiers_on_odd_tables(spark, operator):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (6, None, None), (7, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    out = operator(_docs(spark, ODD), labels, held_out(F.col("doc_id"), 4, 2)).collect()
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 for r in out)
    out = operator(_docs(spark, ODD), labels.limit(0), held_out(F.col("doc_id"), 4, 2)).collect()
    assert {r.score for r in out} == {0.5}
    assert operator(_empty(spark), labels, held_out(F.col("doc_id"), 4, 2)).count() == 0


def test_isotonic():
    fit = quality_classifier.isotonic(np.arange(6.0), np.array([0, 2, 1, 1, 5, 4.0]), np.ones(6))
    assert fit.tolist() == pytest.approx([0, 4 / 3, 4 / 3, 4 / 3, 4.5, 4.5])


def test_calibration_is_never_certain():
    fit = quality_classifier.calibrated(np.arange(4.0), np.array([0, 0, 1.0, 1]), np.array([5.0, 4, 1, 8]))
    assert 0 < fit[0] == fit[1] < 0.1 and fit[2] == fit[3] and 0.9 < fit[3] < 1


def test_ridge_on_random_features_against_numpy(spark):
    """Sums by slice give the weights of all rows at once, and of all but a slice; the calibration uses the latter."""
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (300, quality_classifier.N_STATISTICS)) * np.arange(1, quality_classifier.N_STATISTICS + 1)
    y, w = (x[:, 0] + x[:, 1] / 2 + rng.normal(0, 0.5, 300) > 0).astype(int), rng.choice([1.0, 3.0], 300)
    rows = spark.createDataFrame([(i, list(map(float, x[i])), int(y[i]), float(w[i])) for i in range(300)], "doc_id long, x array<double>, label int, weight double").repartition(3)
    model = quality_classifier.fit(rows, features=40)
    mean = (x * w[:, None]).sum(0) / w.sum()
    assert model.mean == pytest.approx(mean) and model.scale == pytest.approx(np.sqrt((x**2 * w[:, None]).sum(0) / w.sum() - mean**2))
    f = model.features(x)
    penalty = np.diag([quality_classifier.RIDGE] * 40 + [0.0])

    def by_hand(own):
        a, v = f[own], w[own]
        return np.linalg.solve((a * v[:, None]).T @ a + penalty * v.sum() + 1e-9 * np.eye(41), (a * v[:, None]).T @ y[own])

    assert model.weights == pytest.approx(by_hand(np.ones(300, bool)), rel=1e-6, abs=1e-8)
    slices = np.array([r[0] for r in rows.orderBy("doc_id").select(F.pmod(F.xxhash64("doc_id"), F.lit(quality_classifier.SLICES))).collect()])
    raw = np.array([f[i] @ by_hand(slices != slices[i]) for i in range(300)])
    bins = np.round(np.clip(raw, -1, 2) * (quality_classifier.BINS // 3))
    groups = [np.flatnonzero(bins == b) for b in np.unique(bins)]
    at = np.array([np.average(raw[g], weights=w[g]) for g in groups])
    assert model.steps[0] == pytest.approx(at, abs=1e-6)
    assert model.steps[1] == pytest.approx(quality_classifier.calibrated(at, np.array([np.average(y[g], weights=w[g]) for g in groups]), np.array([w[g].sum() for g in groups])), abs=1e-6)


def test_ftrl_against_plain_python(spark):
    """Weights of train() against the update rule coordinate by coordinate."""
    import math

    texts = ["you fool", "a fine day", "fool of a day", "a day", "you are a fool", "fine", ""]
    labels = [1, 0, 1, 0, 1, 0, 0]
    rows = spark.createDataFrame([(i, labels[i % 7], texts[i % 7] + f" w{i % 3}") for i in range(40)], "doc_id long, label int, text string")
    got = toxicity.train(rows, 40, bits=10, passes=3)
    ordered = rows.withColumn("order", F.xxhash64("doc_id", F.lit("order"))).orderBy("order", "doc_id").collect()
    z, n, bias = {}, {}, 1 << 10

    def weight(i):
        l1 = 0.0 if i == bias else toxicity.L1
        s = z.get(i, 0.0)
        return 0.0 if abs(s) <= l1 else (math.copysign(l1, s) - s) / ((toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2)

    for _ in range(3):
        for r in ordered:
            own = [*map(int, toxicity.features(pa.array([r.text]), 10)[0]), bias]
            w = {i: weight(i) for i in own}
            g = 1 / (1 + math.exp(-sum(w.values()))) - r.label
            for i in own:
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA
                z[i], n[i] = z.get(i, 0.0) + g - sigma * w[i], n.get(i, 0.0) + g * g
    want = np.array([weight(i) for i in range(bias + 1)])
    assert got == pytest.approx(want, abs=1e-5) and 0 < np.count_nonzero(got[:-1]) < len(z) and got[:-1].max() > 0


def test_features_of_toxicity_are_words_pairs_skips_and_stems():
    of = lambda t: set(toxicity.features(pa.array([t]))[0].tolist())
    assert len(of("ab cd ef")) == 3 + 2 + 1 + 2 * 3 and of("AB, cd! ef") == of("ab cd ef") and not of(" .. ")
    assert len(of("ab cd ef") & of("cd ef gh")) == 2 + 1 + 2 * 2


def test_words_whose_plain_hashes_collide(spark):
    """Texts of one word or few that share nothing, though polynomials over their bytes are equal."""
    thue = "".join("ab"[i.bit_count() & 1] for i in range(2048))
    morse = thue.translate(str.maketrans("ab", "ba"))
    texts = [thue, morse, f"x y z {thue} x y z {morse}", f"p q {thue} r s", f"p q {morse} r s"]
    docs = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id int, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_groups(docs, words=4, percent=85).collect()} == {1: (1, 1), 2: (1, 2), 3: (5, 3), 4: (2, 4), 5: (2, 5)}
    links, members = jaccard_join.near_links(docs)
    assert links.count() == 0 and not any(r.n_links for r in members.collect())
    assert jaccard_join.near_dedup(docs).count() == 5


def test_a_shared_shingle_is_shared_in_both_lanes():
    x = np.array([[1, 2, 3], [7, 8, 9]], np.uint64)
    assert jaccard_join._similar(x, x, 100) and not jaccard_join._similar(x, np.array([[1, 2, 3], [7, 8, 1]], np.uint64), 80)
    assert jaccard_join._similar(x, np.array([[1, 2, 3], [7, 8, 1]], np.uint64), 50)


def test_chat_parts_in_any_order(spark):
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} said {t} " * 40) for c in (1, 2, None) for t in range(40)]
    formatted = chat_format.format_conversations(spark.createDataFrame(turns, "conv_id int, turn int, role string, text string"), part_chars=2000)
    want = sorted(map(str, chat_format.digests(formatted).collect()))
    assert len(want) == 3 and formatted.count() > 12
    for other in (formatted.repartition(4, "part"), formatted.orderBy("formatted"), formatted.orderBy(F.desc("part")).coalesce(1)):
        assert sorted(map(str, chat_format.digests(other).collect())) == want
    for bad in (formatted.where("part <> 1 or conv_id = 1"), formatted.where("not last"), formatted.union(formatted.where("part = 2"))):
        with pytest.raises(Exception, match="no part|no last part"):
            chat_format.digests(bad).collect()


def test_toxicity_of_text_ids_and_copies(spark):
    """Ids that are text, and an id of very many rows: no more are learned from than the bound says."""
    words = ["calm", "kind", "vile", "rude"]
    rows = [(f"d{i}", " ".join([words[2 * (i % 2)], words[2 * (i % 2) + 1]] * 3)) for i in range(40)]
    rows += [("d0", f"calm kind {i}") for i in range(300)] + [("d1", rows[1][1])] * 300 + [(None, "vile rude")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    labels = spark.createDataFrame([(f"d{i}", i % 2) for i in range(40)], "doc_id string, toxic int")
    ids = toxicity.training_labels(labels, "toxic", F.lit(False), 100)
    taken = toxicity.training_rows_of(docs, ids, 100).collect()
    assert len(taken) == 70 and sum(r.label for r in taken) == 20 and len({(r.doc_id, r.text) for r in taken}) == 70
    scored = toxicity.toxicity(docs, labels, F.lit(False)).collect()
    assert len(scored) == len(rows) and {r.doc_id: r.predicted for r in scored if r.doc_id not in ("d0", None)} == {f"d{i}": i % 2 for i in range(1, 40)}


def test_columns_of_any_name(spark):
    """Names that could be an operator's own."""
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k", "x", 5, 6, 7), (2, "l m", None, 5, 6, 7)], "doc_id int, text string, source string, any int, first int, _ int")
    assert quality_rules.judged(docs).columns[:6] == docs.columns and quality_rules.judged(docs).count() == 2
    assert "text" not in quality_rules.judged(docs, keep_text=False).columns and quality_rules.judged(docs, keep_text=False).where("any = 5").count() == 2
    assert mixing.mix_documents(docs).columns == docs.columns and mixing.mix_documents(docs).count() >= 2


def test_rows_without_id_are_spread(spark):
    """Mixing: keys of rows without doc_id follow their texts, and reruns agree however the rows are dealt out."""
    docs = spark.createDataFrame([(None, f"w{i} " * (1 + i % 7), "s") for i in range(400)] + [(7, "same id " * (1 + i), "t") for i in range(5)], "doc_id int, text string, source string")
    runs = [sorted((str(r.doc_id), r.size, r.taken) for r in mixing.mix(mixing.document_sizes(docs.repartition(n)), bucket_rows=20).collect()) for n in (1, 5)]
    assert runs[0] == runs[1]
    for source in ("s", "t"):
        own = mixing.mix(mixing.document_sizes(docs)).where(F.col("source") == source)
        assert own.agg(F.sum("taken")).first()[0] == int(own.first().target)


def test_shards_of_one_id(spark, tmp_path):
    """Rows without id, or of one id, are not one task's."""
    docs = spark.createDataFrame([(None, f"text {i}") for i in range(300)] + [(5, f"five {i}") for i in range(300)] + [(6, "six")], "doc_id int, text string")
    written = token_shards.write_shards(docs, f"file://{tmp_path}/shards", shards=8).collect()
    assert len(written) >= 6 and max(r.documents for r in written) < 300 and sum(r.documents for r in written) == 601
    found = token_shards.round_trip(docs).collect()
    assert len(found) == 601 and [r.doc_id for r in sorted(found, key=lambda r: r.start)] == [None] * 300 + [5] * 300 + [6]
    starts = sorted((r.start, r.n_tokens) for r in found)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    with pytest.raises(Exception, match="can't be keys"):
        token_shards.write_shards(spark.createDataFrame([("k" * 70_000, "x")], "doc_id string, text string"), f"file://{tmp_path}/long").collect()
