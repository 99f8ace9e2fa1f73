"""Katz backoff over word pairs: discounted counts, exact backoff weights, scores of whole texts.

A text's tokens are its words and one end. The probability of a token after
another is its pair's count, discounted by Good and Turing's estimate, over the
context's; what that leaves to pairs not seen goes to them in proportion to the
tokens' own discounted probabilities, by a weight that makes each context's
probabilities add up to one. Tokens not seen at all are one token.

Counts are kept in tables by words' 64-bit names: one of words, and one of pairs
in buckets by context. Texts are read in chunks, and a chunk's distinct pairs
go to their buckets once each, with the numbers of the texts that have them, so
that a bucket has all it takes to count its pairs, to weigh its contexts and to
evaluate every token; sums by text go back. Contexts that are frequent enough to
fill a bucket are spread over all of them by pair, and their weights come from
sums over buckets; those that are a good part of one are given to the buckets that
have least. With many buckets nearly every token of a text is in another, so a task adds
up the sums of its buckets before it passes them on.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialise
from .tokens import text_batches
from .words import Words, names, packed

#: Names of what is no word: the end and the beginning of a text, and the number of all tokens.
END, BEGIN, ALL = 1, 2, 3
#: Counts up to this are discounted.
DISCOUNTED = 5
#: Added to each count in the base score.
ADDED = 0.1
#: Bytes and rows of texts in a chunk; rows have to fit into 15 bits.
CHUNK_BYTES, CHUNK_ROWS = 12 << 20, 32_000
#: Tokens to a bucket, and those of one context from which on it is spread; of those there are a million at most.
BUCKET_TOKENS, SPREAD_TOKENS = 3_000_000, 1_000_000
MOST_SPREAD = 1 << 20
#: Contexts with more than this part of a bucket's tokens are placed by their number.
PLACED_PART = 50
#: Tasks that go through the buckets; each passes on sums of every text once.
GROUPS = 48
#: Texts whose sums a task holds (44 bytes each) before it passes on what it has.
MOST_HELD = 4_000_000
#: Texts' sums that are made into one batch.
BATCH_SUMS = 1 << 18

_LISTS = "v array<bigint>, v_pairs array<int>, w array<bigint>, w_at array<int>, postings array<int>, doc array<smallint>, n array<int>"
#: Of a chunk's texts in a bucket, or in several: sums and tokens whose pairs have the counts 1 to 5. Of one bucket: contexts that leave a pair to its token, with what their weights are made of.
_TEXTS = "doc array<smallint>, n_known array<int>, base array<double>, score array<double>, small array<int>"
_OPEN = "open_v array<bigint>, open_total array<bigint>, open_large array<bigint>, open_small array<bigint>, open_left array<double>, open_at array<int>, open_doc array<smallint>, open_n array<int>"
#: Of a bucket: how many pairs have the counts 1 to 6, and the part it has of each context that is spread.
_WHOLE = "counts_of array<bigint>, spread_v array<bigint>, spread_large array<bigint>, spread_small array<bigint>, spread_lower array<double>"
_SUMS = ["doc", "n_known", "base", "score", "small"]


def discounts(counts_of: list[int]) -> np.ndarray:
    """What counts 0, 1, … DISCOUNTED are multiplied by, from how many things have the counts 1, 2, … DISCOUNTED + 1.

    Katz's: r* / r by Good and Turing, set back so that the largest discounted
    count runs into those that are not. Fewer counts are discounted where this
    gives no numbers between 0 and 1; where it never does, half a count is taken off each.
    """
    for k in range(DISCOUNTED, 1, -1):
        n = [0, *counts_of[: k + 1]]
        if min(n[1:]) <= 0:
            continue
        past = (k + 1) * n[k + 1] / n[1]
        if past >= 1:
            continue
        d = [((r + 1) * n[r + 1] / (r * n[r]) - past) / (1 - past) for r in range(1, k + 1)]
        if all(0 < x < 1 for x in d):
            return np.array([1.0, *d, *[1.0] * (DISCOUNTED - k)])
    return np.array([1.0, *[(r - 0.5) / r for r in range(1, DISCOUNTED + 1)]])


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return counts * np.where(counts < len(d), d[np.minimum(counts, len(d) - 1)], 1.0)


class WordModel:
    """Probabilities of single tokens, from their training counts."""

    def __init__(self, total: int, distinct: int, counts_of: list[int]):
        self.total, self.distinct, self.d = total, distinct, discounts(counts_of)
        left = sum((1 - self.d[r]) * r * n for r, n in enumerate(counts_of[:DISCOUNTED], 1))
        #: A token is kept for what was not seen where nothing is discounted.
        self._of = total + (left <= 0)
        self.unseen = 1.0 if not total else (left or 1.0) / self._of

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.d) / max(1, self._of), self.unseen)

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the plain estimate with a constant added."""
        return np.log10((counts + ADDED) / (self.total + ADDED * (self.distinct + 1)))


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Local numbers of all tokens in order, the number of tokens of each text, and the names by local number (the last two: end and beginning)."""
    data, offsets = packed(texts)
    words = Words(data, offsets)
    codes, distinct = words.coded()
    named = np.concatenate((names(distinct).view(np.int64), np.array([END, BEGIN])))
    sizes = words.counts + 1
    tokens = np.full(len(codes) + len(sizes), len(distinct), np.int32)  # an end after each text
    inner = np.ones(len(tokens), bool)
    inner[np.cumsum(sizes) - 1] = False
    tokens[inner] = codes
    return tokens, sizes, named


def _chunks(batches):
    for batch in text_batches(batches, "text", CHUNK_BYTES):
        for at in range(0, batch.num_rows, CHUNK_ROWS):
            yield batch.slice(at, CHUNK_ROWS)


def word_counts(docs: DataFrame) -> DataFrame:
    """w, n of docs (text, learn): how often each token is in the texts to learn from; ALL has the number of all texts' tokens."""

    def count(batches):
        for batch in _chunks(batches):
            tokens, sizes, named = _tokens(batch.column("text"))
            learn = np.repeat(batch.column("learn").to_numpy(zero_copy_only=False).astype(bool), sizes)
            n = np.bincount(tokens[learn], minlength=len(named))
            some = np.flatnonzero(n)
            yield pa.record_batch([np.append(named[some], ALL), np.append(n[some], len(tokens))], ["w", "n"])

    return docs.select("text", "learn").mapInArrow(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def _mixed(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A number below 2^62 of each pair of names, for dealing out."""
    x = v.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ w.view(np.uint64)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(2)).astype(np.int64)


def _list(lengths: np.ndarray, values: np.ndarray, kind=None) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), pa.array(values, kind))


def _counts_of(keys: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(keys, minlength=size)


def _placed(names_: np.ndarray, counts: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket for each name: the most frequent first, each where there is least so far."""
    held = [(0, b) for b in range(buckets)]
    out = np.zeros(len(names_), np.int64)
    for i in np.lexsort((names_, -counts)).tolist():
        n, b = held[0]
        out[i] = b
        heapq.heapreplace(held, (n + int(counts[i]), b))
    return out


def bucketed_pairs(docs: DataFrame, buckets: int, spread: np.ndarray, placed: np.ndarray, places: np.ndarray) -> DataFrame:
    """A row a chunk and bucket, of docs (doc_id, text, learn).

    v are contexts with v_pairs pairs each, w tokens, w_at the place in w of each
    pair, postings the number of its texts, doc and n each of them (of texts that
    are not learned from, -1 - doc) and how often the pair is in it; texts is the number of
    the chunk's texts. One row of each chunk has its texts' ids and numbers of tokens.
    spread names the contexts to be spread, placed (in order) those that go to the buckets in places.
    """
    known = docs.sparkSession.sparkContext.broadcast((spread, placed, places))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def dealt(batch: pa.RecordBatch, task: int, number: int) -> pa.RecordBatch:
        spread, placed, places = known.value
        tokens, sizes, named = _tokens(batch.column("text"))
        end = len(named) - 2
        before = np.empty_like(tokens)
        before[1:], before[:1] = tokens[:-1], end
        before[before == end] = end + 1  # a text begins where another ends
        doc = np.repeat(np.arange(batch.num_rows, dtype=np.int16), sizes)
        bucket_of = named % buckets
        if len(placed):
            at = np.minimum(np.searchsorted(placed, named), len(placed) - 1)
            bucket_of = np.where(placed[at] == named, places[at], bucket_of)
        bucket = bucket_of[before]
        often = np.isin(named, spread)
        if often.any():
            at = np.flatnonzero(often[before])
            bucket[at] = _mixed(named[before[at]], named[tokens[at]]) % buckets
        # sorted by bucket, context, token and text; texts are in order already
        key = bucket
        key *= len(named)
        key += before
        key *= len(named)
        key += tokens
        del bucket, before, tokens
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        del order
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        posting = np.flatnonzero(first)
        n = np.diff(np.append(posting, len(key))).astype(np.int32)
        key, doc = key[posting], doc[posting]
        pair = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        postings = np.diff(np.append(pair, len(key))).astype(np.int32)
        key = key[pair]
        del first, posting, pair
        token, context = (key % len(named)).astype(np.int32), key // len(named)
        del key
        start = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
        v_pairs = np.diff(np.append(start, len(context)))
        context = context[start]
        row_of_v = context // len(named)
        rows, row_of_v = np.unique(row_of_v, return_inverse=True)
        row_of_pair = np.repeat(row_of_v, v_pairs)
        own, w_at = np.unique(row_of_pair * len(named) + token, return_inverse=True)
        row_of_pair = row_of_pair.astype(np.int32)
        del token
        row_of_w = own // len(named)
        w_first = np.searchsorted(row_of_w, np.arange(len(rows)))
        learn = batch.column("learn").to_numpy(zero_copy_only=False).astype(bool)
        signed = np.where(learn[doc], doc, -1 - doc).astype(np.int16)
        # a text is found in the same row of its chunk as its number of tokens
        with_texts = (task * 7919 + number) % len(rows)
        in_one = lambda n: np.where(np.arange(len(rows) + 1) > with_texts, n, 0).astype(np.int32)
        nowhere = pa.array(np.arange(len(rows)) != with_texts)
        ids = pa.ListArray.from_arrays(pa.array(in_one(batch.num_rows)), batch.column("doc_id"), mask=nowhere)
        text_sizes = pa.ListArray.from_arrays(pa.array(in_one(batch.num_rows)), pa.array(sizes.astype(np.int32)), mask=nowhere)
        by_pair, by_posting = _counts_of(row_of_pair, len(rows)), _counts_of(np.repeat(row_of_pair, postings), len(rows))
        by_v = _counts_of(row_of_v, len(rows))
        return pa.record_batch(
            [
                pa.array(rows.astype(np.int32)), pa.array(np.full(len(rows), (task << 32) + number)), _list(by_v, named[context % len(named)]), _list(by_v, v_pairs.astype(np.int32)),
                _list(_counts_of(row_of_w, len(rows)), named[own % len(named)]), _list(by_pair, (w_at - w_first[row_of_pair]).astype(np.int32)), _list(by_pair, postings),
                _list(by_posting, signed), _list(by_posting, n), pa.array(np.full(len(rows), batch.num_rows, np.int32)), ids, text_sizes,
            ],
            ["bucket", "chunk", "v", "v_pairs", "w", "w_at", "postings", "doc", "n", "texts", "ids", "sizes"],
        )

    def deal(batches):
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(_chunks(batches)):
            yield dealt(batch, task, number)  # what it was made with is given up before it goes on

    return docs.select("doc_id", "text", "learn").mapInArrow(deal, f"bucket int, chunk long, {_LISTS}, texts int, ids array<{kind}>, sizes array<int>")


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy() if len(column) else np.zeros(0, np.int64)


def _lengths(column: pa.ChunkedArray) -> np.ndarray:
    return np.array([len(x) for x in column], np.int64)


class Bucket:
    """A bucket's pairs (of_v, of_w into v and w) with their counts, and its contexts with what their weights are made of."""

    def __init__(self, rows: pa.Table, words: pa.Table, model: WordModel, spread: np.ndarray, spread_counts: np.ndarray):
        own, counts = _flat(words["w"]), _flat(words["n"])
        order = np.argsort(own)
        self.w, self.word_count = own[order], counts[order]
        size = max(1, len(self.w))
        # pairs of the rows, one after the other, by where they are in the bucket
        v_at, w_at = _flat(rows["v"]), np.searchsorted(self.w, _flat(rows["w"]))
        self.v, v_at = np.unique(v_at, return_inverse=True)
        keys = np.repeat(v_at * size, _flat(rows["v_pairs"]))
        w_first, n_pairs = np.concatenate(([0], np.cumsum(_lengths(rows["w"]))))[:-1], _lengths(rows["w_at"])
        pair_ends, places = np.cumsum(n_pairs), _flat(rows["w_at"])
        for first, a, b in zip(w_first.tolist(), (pair_ends - n_pairs).tolist(), pair_ends.tolist(), strict=True):
            keys[a:b] += w_at[first + places[a:b]]
        keys, self.pair = np.unique(keys, return_inverse=True)
        self.pair = self.pair.astype(np.int32)
        self.of_v, self.of_w = (keys // size).astype(np.int32), (keys % size).astype(np.int32)
        del keys
        self.postings, self.doc, self.n = _flat(rows["postings"]), _flat(rows["doc"]), _flat(rows["n"])
        learned = np.add.reduceat(self.n * (self.doc >= 0), np.cumsum(self.postings) - self.postings, dtype=np.int64) if len(self.n) else self.n
        self.count = np.rint(np.bincount(self.pair, learned, minlength=len(self.of_v))).astype(np.int64)
        del learned
        self.lower = model.probability(self.word_count)

        by_v = lambda x: np.bincount(self.of_v, x, minlength=len(self.v))
        at = np.minimum(np.searchsorted(spread, self.v), max(0, len(spread) - 1))
        self.is_spread = spread[at] == self.v if len(spread) else np.zeros(len(self.v), bool)
        self.small = np.stack([by_v(self.count == r) for r in range(1, DISCOUNTED + 1)], 1).astype(np.int64)
        self.large = np.rint(by_v(self.count * (self.count > DISCOUNTED))).astype(np.int64)
        self.lower_mass = by_v(self.lower[self.of_w] * (self.count > 0))
        total = np.rint(by_v(self.count)).astype(np.int64)
        if len(spread):
            total[self.is_spread] = spread_counts[at[self.is_spread]]
        # a count is kept for pairs not seen where none of 1 or 2 is there to be discounted, and always in contexts that are spread
        self.total = total + (self.is_spread | (self.small[:, :2].sum(1) == 0))


def weights(total: np.ndarray, large: np.ndarray, small: np.ndarray, lower_left: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The backoff weight of contexts: what discounting leaves, over what their unseen tokens have by themselves.

    total is the number of a context's tokens, large of those in pairs that are not discounted, small how many pairs have each small count.
    """
    seen = (large + (small * (np.arange(1, DISCOUNTED + 1) * d[1:])).sum(-1)) / total
    return (1 - seen) / lower_left


def _asked_words(parts: int):
    def ask(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        own = np.unique(_flat(table["w"]))
        part = own % parts
        order = np.argsort(part, kind="stable")
        rows, counts = np.unique(part, return_counts=True)
        return pa.table([pa.array(rows.astype(np.int32)), pa.array(np.full(len(rows), bucket, np.int32)), _list(counts, own[order])], ["part", "bucket", "w"])

    return ask


def _told_counts(counts: pa.Table, asked: pa.Table) -> pa.Table:
    known, n = counts["w"].to_numpy(), counts["n"].to_numpy()
    order = np.argsort(known)
    known, n = known[order], n[order]
    own = _flat(asked["w"])
    at = np.minimum(np.searchsorted(known, own), max(0, len(known) - 1))
    told = np.where(known[at] == own, n[at], 0) if len(known) else np.zeros(len(own), np.int64)
    lengths = _lengths(asked["w"])
    return pa.table([pa.array(asked["bucket"].to_numpy()), _list(lengths, own), _list(lengths, told)], ["bucket", "w", "n"])


def _kinds() -> dict[str, pa.DataType]:
    of = {"smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}
    return {c.split()[0]: of[c.split("<")[1][:-1]] for c in f"{_TEXTS}, {_OPEN}, {_WHOLE}".split(", ")}


def _lists(rows: list[dict], name: str) -> pa.ListArray:
    """The lists of one name of all rows; where a row has none, an empty one."""
    kind, own = _kinds()[name], [r.get(name) for r in rows]
    flat = np.concatenate([x for x in own if x is not None] or [np.zeros(0)])
    if kind != pa.float64() and flat.dtype.kind == "f":
        flat = np.rint(flat).astype(np.int64)  # sums of whole numbers; names stay as they are
    return _list(np.array([0 if x is None else len(x) for x in own], np.int64), flat, None).cast(pa.list_(kind))


def _sums_batch(rows: list[dict], more: list[pa.Array]) -> pa.RecordBatch:
    """rows of sums after the columns chunk, texts, ids and sizes."""
    return pa.record_batch([*more, *[_lists(rows, c) for c in _kinds()]], ["chunk", "texts", "ids", "sizes", *_kinds()])


def _bucket_sums(rows: pa.Table, bucket: Bucket, model: WordModel) -> pa.Table:
    """A row a chunk, and one of the whole bucket."""
    pair_w, pair_v = bucket.of_w, bucket.of_v
    seen = bucket.count > 0
    with np.errstate(divide="ignore"):
        value = np.where(seen, np.log10(np.maximum(bucket.count, 1)) - np.log10(bucket.total)[pair_v], np.log10(bucket.lower)[pair_w])
    base, known = model.base(bucket.word_count), bucket.word_count > 0
    small = np.where(bucket.count <= DISCOUNTED, bucket.count, 0).astype(np.int8)
    head = [rows[c].combine_chunks() for c in ("chunk", "texts", "ids", "sizes")]
    ends, pair_ends = np.cumsum(_lengths(rows["doc"])), np.cumsum(_lengths(rows["postings"]))
    batches: list[pa.RecordBatch] = []
    done: list[dict] = []
    first = held = 0
    for i, (hi, pair_hi) in enumerate(zip(ends.tolist(), pair_ends.tolist(), strict=True)):
        lo, pair_lo = (int(ends[i - 1]), int(pair_ends[i - 1])) if i else (0, 0)
        p, n = np.repeat(bucket.pair[pair_lo:pair_hi], bucket.postings[pair_lo:pair_hi]), bucket.n[lo:hi]
        doc = np.where(bucket.doc[lo:hi] < 0, -1 - bucket.doc[lo:hi], bucket.doc[lo:hi])
        texts, doc = np.unique(doc, return_inverse=True)
        total = lambda x: np.bincount(doc, x, minlength=len(texts))
        few, w = small[p], pair_w[p]
        open_ = np.flatnonzero(~seen[p])
        contexts, at = np.unique(pair_v[p[open_]], return_inverse=True)
        spread = bucket.is_spread[contexts]
        done.append({
            "doc": texts, "n_known": total(n * known[w]).astype(np.int32), "base": total(n * base[w]), "score": total(n * value[p]),
            "small": np.bincount(doc[few > 0] * DISCOUNTED + few[few > 0] - 1, n[few > 0], minlength=DISCOUNTED * len(texts)).astype(np.int32),
            "open_v": np.where(spread, bucket.v[contexts], 0), "open_total": bucket.total[contexts], "open_large": bucket.large[contexts], "open_small": bucket.small[contexts].ravel(),
            "open_left": 1 - bucket.lower_mass[contexts], "open_at": at, "open_doc": texts[doc[open_]], "open_n": n[open_],
        })
        held += len(texts)
        if held >= BATCH_SUMS or i == len(ends) - 1:
            batches.append(_sums_batch(done, [c[first : i + 1] for c in head]))
            done, first, held = [], i + 1, 0
    spread = np.flatnonzero(bucket.is_spread)
    whole = {
        "counts_of": np.bincount(np.minimum(bucket.count, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2], "spread_v": bucket.v[spread], "spread_large": bucket.large[spread],
        "spread_small": bucket.small[spread].ravel(), "spread_lower": bucket.lower_mass[spread],
    }
    return pa.Table.from_batches([*batches, _sums_batch([whole], [pa.nulls(1, c.type) for c in head])])


def _added_up(batches):
    """_bucket_sums of several buckets: a row a chunk with the sums of its texts, and what was found of contexts and buckets as it is."""
    held: dict[int, list[np.ndarray]] = {}
    texts = 0

    def out():
        rows, chunks, n = [], [], 0
        for chunk, (n_seen, n_known, base, score, small) in held.items():
            doc = np.flatnonzero(n_seen)
            rows.append({"doc": doc, "n_known": n_known[doc], "base": base[doc], "score": score[doc], "small": small[doc].ravel()})
            chunks.append((chunk, len(n_seen)))
            n += len(doc)
            if n >= BATCH_SUMS:
                yield batch_of(rows, chunks)
                rows, chunks, n = [], [], 0
        if rows:
            yield batch_of(rows, chunks)
        held.clear()

    def batch_of(rows, chunks):
        return _sums_batch(rows, [pa.array([c for c, _ in chunks], pa.int64()), pa.array([n for _, n in chunks], pa.int32()), pa.nulls(len(rows), ids_type), pa.nulls(len(rows), pa.list_(pa.int32()))])

    for batch in batches:
        ids_type = batch.schema.field("ids").type
        own = [(batch.column(c).offsets.to_numpy(), batch.column(c).values.to_numpy()) for c in _SUMS]
        chunks, sizes = batch.column("chunk"), batch.column("texts")
        for i in range(batch.num_rows):
            if not chunks[i].is_valid:
                continue
            if texts > MOST_HELD:
                yield from out()
                texts = 0
            chunk, n = chunks[i].as_py(), sizes[i].as_py()
            if chunk not in held:
                held[chunk] = [np.zeros(n, bool), np.zeros(n, np.int32), np.zeros(n), np.zeros(n), np.zeros((n, DISCOUNTED), np.int32)]
                texts += n
            doc, *sums = [values[offsets[i] : offsets[i + 1]] for offsets, values in own]
            held[chunk][0][doc] = True
            for mine, x in zip(held[chunk][1:], sums, strict=True):
                mine[doc] += x.reshape(len(doc), *mine.shape[1:])
        keep = np.flatnonzero(~np.array(chunks.is_valid()) | np.array(batch.column("ids").is_valid()) | (np.diff(batch.column("open_v").offsets.to_numpy()) > 0))
        if len(keep):
            rest = batch.take(pa.array(keep))
            none = {c: _list(np.zeros(len(keep), np.int64), np.zeros(0), None).cast(pa.list_(_kinds()[c])) for c in _SUMS}
            yield pa.record_batch([none.get(c, rest.column(c)) for c in rest.schema.names], rest.schema.names)
    yield from out()


class Counted:
    """The counts of docs (doc_id, text, learn): a table of words, the model of single tokens, and pairs by bucket."""

    def __init__(self, docs: DataFrame, bucket_tokens: int, spread_tokens: int):
        self.words = materialise(word_counts(docs), "word-counts")
        tokens = self.words.where(F.col("w") != ALL)
        several = [F.count_if(F.col("n") == r).alias(f"n{r}") for r in range(1, DISCOUNTED + 2)]
        found = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct"), *several).first()
        self.model = WordModel(found.total, found.distinct, list(found[2:]))
        every = self.words.where(F.col("w") == ALL).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
        self.buckets = max(1, -(-every // bucket_tokens))
        often = tokens.where(F.col("n") > max(spread_tokens, found.total // MOST_SPREAD)).toArrow()  # a million at most
        name, n = often["w"].to_numpy(), often["n"].to_numpy()
        begun, keep = n[name == END], name != END  # as many texts begin as end; nothing follows an end
        name, n = np.append(name[keep], np.full(len(begun), BEGIN)), np.append(n[keep], begun)
        order = np.argsort(name)
        self.spread, self.spread_counts = name[order].astype(np.int64), n[order].astype(np.int64)
        # contexts with a good part of a bucket, which could meet in one; those that are spread are among them, but have no place
        large = tokens.where(F.col("n") > max(bucket_tokens // PLACED_PART, found.total // MOST_SPREAD)).toArrow()  # a million at most
        name, n = large["w"].to_numpy(), large["n"].to_numpy()
        name = np.where(name == END, BEGIN, name)
        order = np.argsort(name)
        name, n = name[order].astype(np.int64), n[order].astype(np.int64)
        single = ~np.isin(name, self.spread)
        placed, places = name[single], _placed(name[single], n[single], self.buckets)
        self.groups = min(self.buckets, max(GROUPS, 2 * docs.sparkSession.sparkContext.defaultParallelism))
        # dealt out once: what asks for words' counts and what uses them read the same shuffle
        self.pairs = bucketed_pairs(docs, self.buckets, self.spread, placed, places).repartition(self.groups, "bucket")
        asked = self.pairs.groupBy("bucket").applyInArrow(_asked_words(self.buckets), "part int, bucket int, w array<bigint>")
        counts = tokens.select(F.pmod("w", F.lit(self.buckets)).cast("int").alias("part"), "w", "n")
        self._told = counts.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(_told_counts, "bucket int, w array<bigint>, n array<bigint>")

    def by_bucket(self, use, schema: str, after=iter) -> DataFrame:
        """use(rows, Bucket, WordModel) of every bucket; rows are those of its chunks. after takes the batches of all of a task's buckets, one by one."""
        held = self.pairs.sparkSession.sparkContext.broadcast((self.model, self.spread, self.spread_counts))

        def each(batches):
            parts: list[pa.RecordBatch] = []
            for batch in batches:
                bucket = batch.column("bucket").to_numpy()
                starts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist()]
                for lo, hi in zip(starts, [*starts[1:], len(bucket)], strict=True):
                    if parts and parts[-1].column("bucket")[0].as_py() != bucket[lo]:
                        yield from of_one(parts)
                        parts = []
                    parts.append(batch.slice(lo, hi - lo))
            if parts:
                yield from of_one(parts)

        def of_one(parts: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
            table = pa.Table.from_batches(parts)
            parts.clear()
            told = table["chunk"].null_count
            if not told:
                raise ValueError("a bucket without its words: union has not kept the buckets together")
            words, rows = table.slice(0, told).select(["told_w", "told_n"]).rename_columns(["w", "n"]), table.slice(told).drop_columns(["told_w", "told_n"])
            return use(rows, Bucket(rows, words, *held.value), held.value[0]).to_batches()

        # both sides are dealt out by bucket, so a union puts their buckets side by side; a bucket's words come first
        none = lambda name: F.lit(None).cast(self.pairs.schema[name].dataType).alias(name)
        told = self._told.select(*["bucket" if c == "bucket" else none(c) for c in self.pairs.columns], F.col("w").alias("told_w"), F.col("n").alias("told_n"))
        pairs = self.pairs.select("*", *[F.lit(None).cast("array<bigint>").alias(c) for c in ("told_w", "told_n")])
        both = pairs.union(told.repartition(self.groups, "bucket")).sortWithinPartitions(F.asc_nulls_first("bucket"), F.asc_nulls_first("chunk"))
        return both.mapInArrow(lambda batches: after(each(batches)), schema)


def _input(docs: DataFrame, learn: Column, text: str, id: str) -> DataFrame:
    return docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))


def _pair_discounts(sums: DataFrame) -> np.ndarray:
    found = sums.where(F.size("counts_of") > 0).select([F.sum(F.get("counts_of", F.lit(r))).alias(f"n{r}") for r in range(DISCOUNTED + 1)]).first()
    return discounts([n or 0 for n in found])


def _spread_weights(sums: DataFrame, counted: Counted, d: np.ndarray) -> np.ndarray:
    """The weights of the contexts that are spread, in their order, from all buckets' parts."""
    parts = sums.where(F.size("spread_v") > 0).select(F.posexplode("spread_v").alias("at", "v"), "spread_large", "spread_small", "spread_lower")
    small = [F.sum(F.get("spread_small", F.col("at") * DISCOUNTED + r)).alias(f"n{r}") for r in range(DISCOUNTED)]
    found = parts.groupBy("v").agg(F.sum(F.get("spread_large", "at")).alias("large"), F.sum(F.get("spread_lower", "at")).alias("lower"), *small).orderBy("v").toArrow()
    if not found.num_rows:
        return np.zeros(0)
    total = counted.spread_counts[np.searchsorted(counted.spread, found["v"].to_numpy())] + 1
    out = np.ones(len(counted.spread))
    out[np.searchsorted(counted.spread, found["v"].to_numpy())] = weights(total, found["large"].to_numpy(), np.stack([found[f"n{r}"].to_numpy() for r in range(DISCOUNTED)], 1), 1 - found["lower"].to_numpy(), d)
    return out


def katz_scores(docs: DataFrame, learn: Column, text: str = "text", id: str = "doc_id", bucket_tokens: int = BUCKET_TOKENS, spread_tokens: int = SPREAD_TOKENS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row of docs, by what is learned from the rows where `learn` holds.

    A text's tokens are its words, A-Z in lower case, and one end. score is the
    log10 of the text's probability by the model, base_score by single tokens with a constant added; n_known
    counts tokens that were learned. Null texts are empty: their one token is the
    end. Null in learn is false; ids may be null, repeat and be of any type; rows
    are kept apart. Without rows to learn from every token is unknown. Rows must
    come in one order whenever docs is read, as those of files do.
    """
    own = _input(docs, learn, text, id)
    counted = Counted(own, bucket_tokens, spread_tokens)
    kind = own.schema["doc_id"].dataType.simpleString()
    of_sums = f"chunk long, texts int, ids array<{kind}>, sizes array<int>, {_TEXTS}, {_OPEN}, {_WHOLE}"
    sums = materialise(counted.by_bucket(_bucket_sums, of_sums, _added_up), "pair-sums")
    d = _pair_discounts(sums)
    held = docs.sparkSession.sparkContext.broadcast((d, counted.spread, _spread_weights(sums, counted, d), counted.model.total))

    def gather(rows: pa.Table) -> pa.Table:
        d, spread, spread_weights, total = held.value
        ids = next(x for x in rows["ids"] if x.is_valid).values
        tokens = next(x for x in rows["sizes"] if x.is_valid).values
        size = len(ids)
        doc = _flat(rows["doc"])
        by_text = lambda c: np.bincount(doc, _flat(rows[c]), minlength=size)
        score = by_text("score")
        small = np.repeat(doc, DISCOUNTED), _flat(rows["small"]) * np.tile(np.log10(d[1:]), len(doc))
        score += np.bincount(*small, minlength=size)
        name = _flat(rows["open_v"])
        weight = np.ones(len(name))
        plain = name == 0
        parts = [_flat(rows[c])[plain] for c in ("open_total", "open_large", "open_left")]
        weight[plain] = weights(parts[0], parts[1], _flat(rows["open_small"]).reshape(-1, DISCOUNTED)[plain], parts[2], d)
        weight[~plain] = spread_weights[np.searchsorted(spread, name[~plain])]
        first = np.concatenate(([0], np.cumsum(_lengths(rows["open_v"]))))[:-1]
        at = _flat(rows["open_at"]) + np.repeat(first, _lengths(rows["open_at"]))
        score += np.bincount(_flat(rows["open_doc"]), _flat(rows["open_n"]) * np.log10(weight[at]), minlength=size)
        n_known = pa.array(np.rint(by_text("n_known")).astype(np.int64))
        return pa.table([ids, tokens.cast(pa.int64()), n_known, pa.array(np.full(size, total)), pa.array(by_text("base")), pa.array(score)], ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    texts = sums.where(F.col("chunk").isNotNull()).drop(*[c.split()[0] for c in _WHOLE.split(", ")])
    return texts.groupBy("chunk").applyInArrow(gather, f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def katz_tables(docs: DataFrame, learn: Column, text: str = "text", id: str = "doc_id", bucket_tokens: int = BUCKET_TOKENS, spread_tokens: int = SPREAD_TOKENS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The model as tables: words (w, n, log10_p), pairs (bucket, v, w, n, log10_p), contexts (bucket, v, log10_weight).

    v and w are names of tokens (words.names; END, BEGIN). A pair that is not in
    its table has its context's weight, 1 for one that is not there, times its
    token's probability; that of a token not in words is under a null w.
    """
    own = _input(docs, learn, text, id)
    counted = Counted(own, bucket_tokens, spread_tokens)
    model, spark = counted.model, docs.sparkSession
    of_pairs, of_contexts = "v array<bigint>, w array<bigint>, n array<bigint>, total array<bigint>", "context array<bigint>, open_total array<bigint>, large array<bigint>, small array<bigint>, left array<double>"

    def tables(rows: pa.Table, bucket: Bucket, _) -> pa.Table:
        seen = np.flatnonzero(bucket.count)
        plain = np.flatnonzero(~bucket.is_spread & (bucket.small.sum(1) + bucket.large > 0))
        spread = np.flatnonzero(bucket.is_spread)
        columns = [
            bucket.v[bucket.of_v[seen]], bucket.w[bucket.of_w[seen]], bucket.count[seen], bucket.total[bucket.of_v[seen]], bucket.v[plain], bucket.total[plain], bucket.large[plain], bucket.small[plain].ravel(), 1 - bucket.lower_mass[plain],
            np.bincount(np.minimum(bucket.count, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2], bucket.v[spread], bucket.large[spread], bucket.small[spread].ravel(), bucket.lower_mass[spread],
        ]
        names_ = [c.split()[0] for c in f"{of_pairs}, {of_contexts}, {_WHOLE}".split(", ")]
        return pa.table([rows["bucket"][:1].combine_chunks(), *[_list(np.array([len(c)]), c) for c in columns]], ["bucket", *names_])

    found = materialise(counted.by_bucket(tables, f"bucket int, {of_pairs}, {of_contexts}, {_WHOLE}"), "pair-tables")
    d = _pair_discounts(found)
    factor = lambda n, d: F.coalesce(F.get(F.array(*[F.lit(float(x)) for x in d]), n.cast("int")), F.lit(1.0))
    few = lambda n, d: F.when(n <= DISCOUNTED, factor(n, d)).otherwise(F.lit(1.0))
    pairs = found.select("bucket", F.inline(F.arrays_zip("v", "w", "n", "total"))).withColumn("log10_p", F.log10(F.col("n") * few(F.col("n"), d) / F.col("total"))).drop("total")
    place = F.posexplode("context").alias("at", "v")
    contexts = found.select("bucket", place, "open_total", "large", "small", "left")
    seen = F.get("large", "at") + sum((F.get("small", F.col("at") * DISCOUNTED + r) * float((r + 1) * d[r + 1]) for r in range(DISCOUNTED)), F.lit(0.0))
    contexts = contexts.select("bucket", "v", F.log10((1 - seen / F.get("open_total", "at")) / F.get("left", "at")).alias("log10_weight"))
    of_spread = _spread_weights(found, counted, d)
    spread = spark.createDataFrame([(None, int(v), float(np.log10(x))) for v, x in zip(counted.spread, of_spread, strict=False)], "bucket int, v long, log10_weight double")
    words = counted.words.where(F.col("w") != ALL).withColumn("log10_p", F.log10(F.col("n") * few(F.col("n"), model.d) / float(max(1, model._of))))
    words = words.unionByName(spark.createDataFrame([(None, 0, float(np.log10(model.unseen)))], "w long, n long, log10_p double"))
    return words, pairs, contexts.unionByName(spread)
