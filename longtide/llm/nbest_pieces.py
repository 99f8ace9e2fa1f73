"""SentencePiece encoding and decoding with N-best segmentations.

A text is normalised as the model's file says for this family (spaces become
U+2581, one is put in front, nothing else changes) and cut where no piece can
lie across: between characters that no piece has side by side. In each part the
pieces form a lattice. A forward Viterbi pass gives the best score from the
part's start to every position; an A-star search goes back from its end, and the
forward scores are its heuristic. They are exact, so segmentations come out best
first and no more than n open paths are ever worth keeping. Characters without a
piece are spelled in byte pieces.

The score of a segmentation is the sum of its pieces' scores in the model. For
a BPE model those are ranks, so the best segmentation need not be the one that
merging gives; every segmentation decodes to the text.

A batch's equal parts are one. Forward and backward scores of all parts that a
worker has not met are found together; from them come each part's best
segmentation and the drop to its second. A text's n best differ from its best in
the n - 1 parts of the smallest drops only, and those are searched.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from bisect import insort
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import PartCache, Parts, no_cycle_search, text_batches, tokenizer_path, worker_cache
from .words import packed

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
N_BEST = 4
SLICE_BYTES = 2 << 20
#: Cells (part, position, piece length) of the lattices that are worked on at once.
CELLS = 2_000_000


class Vocabulary:
    """Pieces with scores and ids, the byte pieces' ids, and the way back from ids to bytes."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        self.pieces = pieces
        self.byte_ids = np.array(byte_ids, np.uint32)
        self.longest = max(map(len, pieces), default=1)
        #: Below every ranked piece's score, so that bytes are a last resort. (Runs of
        #: spaces have a score of -1e9 in the file, which is no rank.)
        self.byte_score = min((s for _, s in pieces.values() if s > -1e8), default=0.0) - 10.0
        self.bytes_of = {i: p.replace(SPACE, " ").encode() for p, (i, _) in pieces.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}

    @cached_property
    def trie(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys (node << 21 | character), the node each leads to, and of each node its piece's id (-1: none) and score."""
        beginnings = {p[:k] for p in self.pieces for k in range(1, len(p) + 1)}
        nodes = {"": 0} | {b: k + 1 for k, b in enumerate(sorted(beginnings))}
        keys = np.array([nodes[b[:-1]] << 21 | ord(b[-1]) for b in beginnings], np.int64)
        children = np.array([nodes[b] for b in beginnings], np.int64)
        ids, scores = np.full(len(nodes), -1, np.int64), np.full(len(nodes), -np.inf)
        for piece, (i, score) in self.pieces.items():
            ids[nodes[piece]], scores[nodes[piece]] = i, score
        order = np.argsort(keys)
        return keys[order], children[order], ids, scores

    @cached_property
    def joins(self) -> np.ndarray:
        """[last byte, first byte] of characters, with spaces for U+2581, that some piece has side by side."""
        out = np.zeros((256, 256), bool)
        for piece in self.pieces:
            spelled = [c.encode() for c in piece.replace(SPACE, " ")]
            for a, b in zip(spelled, spelled[1:], strict=False):
                out[a[-1], b[0]] = True
        return out

    @cached_property
    def spellings(self) -> pa.Array:
        """The bytes of every id in order."""
        return pa.array([self.bytes_of.get(i, b"") for i in range(max(self.bytes_of, default=-1) + 1)], pa.large_binary())

    def edges_into(self, text: str, end: int) -> list[tuple[int, float, tuple[int, ...]]]:
        """(start, score, ids) of the pieces of text that end at end; the bytes of its last character if that has no piece."""
        found = [(start, hit[1], (hit[0],)) for start in range(max(0, end - self.longest), end) if (hit := self.pieces.get(text[start:end]))]
        if not found or found[-1][0] != end - 1:
            data = text[end - 1].encode()
            found.append((end - 1, self.byte_score * len(data), tuple(self.byte_ids[list(data)].tolist())))
        return found

    def decode(self, ids) -> str:
        """The text of ids, without the space put in front."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode().removeprefix(" ")

    def spelled(self, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The bytes of all ids, end to end, and where each id's begin (one more at the end)."""
        taken = self.spellings.take(pa.array(ids))
        _, offsets, data = taken.buffers()
        return memoryview(data) if data else memoryview(b""), np.frombuffer(offsets, np.int64, len(taken) + 1) if len(taken) else np.zeros(1, np.int64)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (i for i in range(len(sp)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)))
    return Vocabulary({sp.id_to_piece(i): (i, sp.get_score(i)) for i in plain}, [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])


def n_best(text: str, words: Vocabulary, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """Up to n segmentations (score, ids) of a part, best first.

    Among equal scores a path that is nearer to the part's start goes first, so
    a path is finished before others like it are opened. Every open path can be
    completed at exactly its estimate, so those beyond as many as are still
    wanted are dropped.
    """
    size = len(text)
    forward = [0.0] * (size + 1)
    for end in range(1, size + 1):
        forward[end] = max([forward[start] + score for start, score, _ in words.edges_into(text, end)])
    found: list[tuple[float, tuple[int, ...]]] = []
    # (estimate, -position, order, score behind, (ids, path behind)), the best last
    queue: list = [(forward[size], -size, 0, 0.0, None)]
    pushed = 0
    while queue and len(found) < n:
        _, at, _, behind, path = queue.pop()
        if not at:
            ids: list[int] = []
            while path:
                ids += path[0]
                path = path[1]
            found.append((behind, tuple(ids)))
            continue
        for start, score, ids in words.edges_into(text, -at):
            pushed -= 1
            insort(queue, (forward[start] + score + behind, -start, pushed, behind + score, (ids, path)))
        del queue[: max(0, len(queue) - (n - len(found)))]
    return found


class Lattices:
    """The edges of parts of up to `most` characters, longest first: of each its part, start, length, score and piece (-1: bytes)."""

    def __init__(self, texts: list[str], words: Vocabulary):
        keys, children, id_of, score_of = words.trie
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        self.sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(self.sizes)
        end_of = np.repeat(ends, self.sizes)
        part_of, start_of = np.repeat(np.arange(len(texts)), self.sizes), np.arange(len(chars)) - np.repeat(ends - self.sizes, self.sizes)
        at, node, length, found = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0, []
        while len(at):
            key = node << 21 | chars[at + length]
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[place] == key
            at, node, length = at[hit], children[place[hit]], length + 1
            piece = id_of[node] >= 0
            found.append((at[piece], np.full(piece.sum(), length), score_of[node[piece]], id_of[node[piece]]))
            on = at + length < end_of[at]
            at, node = at[on], node[on]
        spelled = np.ones(len(chars), bool)
        spelled[found[0][0]] = False
        at = np.flatnonzero(spelled)
        self.n_bytes = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
        found.append((at, np.ones(len(at), np.int64), words.byte_score * self.n_bytes[at], np.full(len(at), -1)))
        at, self.length, self.score, self.piece = (np.concatenate(x) for x in zip(*found, strict=True))
        self.at, self.part, self.start = at, part_of[at], start_of[at]
        self.chars = chars

    def solve(self, words: Vocabulary) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Of every part the best score, the drop to the second best (inf: there is none), and the best one's ids as bytes.

        All parts go one position at a time, forward for the best score of every
        beginning and backward for that of every end; the best path through an
        edge that the best segmentation does not use is the second best.
        """
        sizes, part, start, length = self.sizes, self.part, self.start, self.length
        n, most, longest = len(sizes), int(sizes[0]), int(length.max())
        rows, end = np.arange(n), start + length
        by_end, by_start = np.full((n, most + 1, longest), -np.inf), np.full((n, most + 1, longest), -np.inf)
        by_end[part, end, longest - length] = by_start[part, start, length - 1] = self.score
        number = np.zeros((n, most + 1, longest), np.int32)
        number[part, end, longest - length] = np.arange(len(part))
        # a margin of -inf on the side that windows look to
        forward, backward = np.full((n, longest + most + 1), -np.inf), np.full((n, most + 1 + longest), -np.inf)
        taken = np.zeros((n, most + 1), np.int64)
        forward[:, longest] = backward[rows, sizes] = 0.0
        alive = np.searchsorted(-sizes, -np.arange(most + 2), side="right")  # parts of so many characters or more
        for t in range(1, most + 1):
            k = alive[t]
            reach = forward[:k, t : t + longest] + by_end[:k, t]
            best = reach.argmax(1)
            forward[:k, longest + t] = reach[rows[:k], best]
            taken[:k, t] = longest - best
        for t in range(most - 1, -1, -1):
            k = alive[t + 1]
            backward[:k, t] = (backward[:k, t + 1 : t + 1 + longest] + by_start[:k, t]).max(1)
        used = np.zeros((n, most + 1), np.int64)
        of, to = rows, sizes.copy()
        while len(of):
            used[of, to] = step = taken[of, to]
            to = to - step
            of, to = of[to > 0], to[to > 0]
        best = forward[rows, longest + sizes]
        through = np.where(used[part, end] == length, -np.inf, forward[part, longest + start] + self.score + backward[part, end])
        second = np.full(n, -np.inf)
        np.maximum.at(second, part, through)
        of, to = np.nonzero(used)
        edge = number[of, to, longest - used[of, to]]
        ids = self.piece[edge]
        counts = np.bincount(of, minlength=n)
        if (ids < 0).any():
            # characters in bytes
            own = np.where(ids < 0, self.n_bytes[self.at[edge]], 1)
            spread = np.repeat(ids, own)
            data = np.frombuffer("".join(map(chr, self.chars[self.at[edge[ids < 0]]].tolist())).encode(), np.uint8)
            spread[spread < 0] = words.byte_ids[data]
            ids, counts = spread, np.bincount(of, own, n).astype(np.int64)
        ids, cuts = ids.astype("<u4").tobytes(), np.concatenate(([0], np.cumsum(counts))) * 4
        return best, best - second, [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def best_and_drop(parts: list[str], words: Vocabulary) -> list[tuple[float, float, bytes]]:
    """For each part (best score, drop to the second best, ids of the best as bytes), parts of like length together."""
    order = sorted(range(len(parts)), key=lambda i: -len(parts[i]))
    out: list = [None] * len(parts)
    first = 0
    while first < len(order):
        last = first + max(1, CELLS // ((len(parts[order[first]]) + 1) * words.longest))
        some = order[first:last]
        for i, *x in zip(some, *Lattices([parts[i] for i in some], words).solve(words), strict=True):
            out[i] = tuple(x)
        first = last
    return out


_HEAD = np.dtype([("best", "<f8"), ("drop", "<f8")])


def _solved(words: Vocabulary) -> PartCache:
    """part -> best score and drop, 16 bytes, then its best ids."""

    def make(parts: list[bytes]) -> list[bytes]:
        found = best_and_drop([p.decode().replace(" ", SPACE) for p in parts], words)
        heads = np.array([x[:2] for x in found], np.float64).tobytes()
        return [heads[16 * k : 16 * k + 16] + x[2] for k, x in enumerate(found)]

    return PartCache(make)


def _searched(words: Vocabulary, n: int) -> PartCache:
    """part -> its n best (score, ids as bytes)."""

    def make(parts: list[bytes]) -> list[list[tuple[float, bytes]]]:
        return [[(s, np.array(ids, "<u4").tobytes()) for s, ids in n_best(p.decode().replace(" ", SPACE), words, n)] for p in parts]

    return PartCache(make, most_bytes=32 << 20, weigh=lambda value: sum(100 + len(ids) for _, ids in value))


def led_parts(texts: pa.Array, words: Vocabulary) -> tuple[Parts, np.ndarray, np.ndarray, list[int]]:
    """The parts of texts with a space in front, the bytes of all and their offsets, and which texts have U+2581, here a space, of their own."""
    data, offsets = packed(texts)
    mark, marked = SPACE.encode(), []
    if mark in data.tobytes():
        every = texts.to_pylist()
        marked = [i for i, t in enumerate(every) if t and SPACE in t]
        data, offsets = packed(pa.array([t and t.replace(SPACE, " ") for t in every], pa.string()))
    held = offsets[:-1] < offsets[1:]
    data = np.insert(data, offsets[:-1][held], 32)
    offsets = offsets + np.concatenate(([0], np.cumsum(held)))
    cut = np.zeros(len(data), bool)
    cut[1:] = ~words.joins[data[:-1], data[1:]] & (data[1:] & 0xC0 != 0x80)
    return Parts(data, offsets, cut), data, offsets, marked


def smallest_drops(parts: Parts, drops: np.ndarray, n: int) -> dict[int, list[int]]:
    """text -> the places of its n parts of the smallest drops, smallest first; parts without a second segmentation are left out."""
    left = drops[parts.codes]
    counts = np.diff(parts.firsts)
    held = np.flatnonzero(counts)
    out: dict[int, list[int]] = {}
    text_of = np.repeat(np.arange(len(counts)), counts)
    for _ in range(n if len(held) else 0):
        least = np.minimum.reduceat(left, parts.firsts[held])
        hit = np.flatnonzero((left == np.repeat(least, counts[held])) & (left < np.inf))
        texts = text_of[hit]
        once = np.concatenate(([True], texts[1:] != texts[:-1])) if len(hit) else np.zeros(0, bool)
        left[hit[once]] = np.inf
        for text, place in zip(texts[once].tolist(), hit[once].tolist(), strict=True):
            out.setdefault(text, []).append(place)
    return out


def text_n_best(searched: list[tuple[int, bytes, list[tuple[float, bytes]]]], n: int) -> list[tuple[float, dict[int, bytes]]]:
    """The n best segmentations of a text, as (drop from the best score, {part's place: its ids}).

    searched has the parts of the n - 1 smallest drops: place, best ids, n best.
    Parts are independent, so no other part differs from its best.
    """
    out: list[tuple[float, dict[int, bytes]]] = [(0.0, {})]
    for place, best, every in searched:
        rest = [(every[0][0] - score, ids) for score, ids in every if ids != best][: n - 1]
        more = [(drop + less, {**chosen, place: ids}) for drop, chosen in out for less, ids in rest]
        out = heapq.nsmallest(n, out + more, key=lambda x: x[0])
    return out


def encode_batch(texts: pa.Array, words: Vocabulary, solved: PartCache, searched: PartCache, n: int) -> dict[str, pa.Array]:
    """The columns of segmentations() but doc_id."""
    parts, led, led_at, marked = led_parts(texts, words)
    distinct = parts.distinct.to_pylist()
    values = solved.values(distinct)
    heads = np.frombuffer(b"".join([v[:16] for v in values]), _HEAD)
    best = [v[16:] for v in values]
    data, at = parts.spread(best)
    data, at, codes, firsts = data.tobytes(), at.tolist(), parts.codes, parts.firsts.tolist()
    totals = parts.sums(heads["best"]).tolist()
    differ = smallest_drops(parts, heads["drop"], n - 1)
    wanted = [codes[p] for places in differ.values() for p in places]
    names = list(set(wanted))
    n_best_of = dict(zip(names, searched.values([distinct[c] for c in names]), strict=True))
    scores, every, sizes = [], [], []
    for k, total in enumerate(totals):
        first, last = firsts[k], firsts[k + 1]
        choices = text_n_best([(p, best[codes[p]], n_best_of[codes[p]]) for p in differ.get(k, ())], n)
        for _, chosen in choices:
            pieces, done = [], at[first]
            for p in sorted(chosen):
                pieces += [data[done : at[p]], chosen[p]]
                done = at[p + 1]
            every.append(b"".join([*pieces, data[done : at[last]]]))
        scores.append([total - drop for drop, _ in choices])
        sizes.append(len(choices))
    ids = np.frombuffer(b"".join(every), "<u4")
    bounds = np.concatenate(([0], np.cumsum([len(x) // 4 for x in every])))
    spelled, spelled_at = words.spelled(ids)
    ends = spelled_at[bounds].tolist()
    spelled, led, led_at, marked = bytes(spelled), led.tobytes(), led_at.tolist(), set(marked)
    hashes, whole, j = [], [], 0
    for k, size in enumerate(sizes):
        said, meant = [spelled[ends[i] : ends[i + 1]] for i in range(j, j + size)], led[led_at[k] : led_at[k + 1]]
        hashes.append(hashlib.sha256(said[0][1:]).hexdigest())
        whole.append(k not in marked and all(x == meant for x in said))
        j += size
    outer = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    lists = lambda values: pa.ListArray.from_arrays(outer, values)
    nested = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))
    first = outer.to_numpy()[:-1]
    return {
        "n_pieces": pa.array(np.diff(bounds)[first]),
        "scores": lists(pa.array([float(s) for x in scores for s in x], pa.float64())),
        "nbest_crc32": lists(pa.array([zlib.crc32(x) for x in every], pa.int64())),
        "decoded_sha256": pa.array(hashes, pa.string()),
        "round_trip": pa.array(whole, pa.bool_()),
        "nbest_ids": lists(nested),
    }


def segmentations(docs: DataFrame, text: str = "text", id: str = "doc_id", model: str = MODEL, n: int = N_BEST, with_ids: bool = True) -> DataFrame:
    """doc_id, n_pieces, scores (array<double>, best first), nbest_ids (array<array<int>>), best_ids, nbest_crc32, decoded_sha256, round_trip.

    Every row and whole text; null counts as empty and has no pieces, one score
    of 0. nbest_ids has the ids of each of the up to n segmentations, in the order
    of scores, and best_ids the first of them; with_ids=False leaves both out.
    The rest is taken from these ids: nbest_crc32 the CRC of each (little-endian,
    32 bits), decoded_sha256 of the text decoded from the best; round_trip says
    whether every one decodes to the text that came in. U+2581 in a text decodes
    to a space, as with the library. Ids may be null, repeat, and be of any type.
    """
    path = tokenizer_path(model)
    kind = docs.select(id).schema[0].dataType.simpleString()

    def encode(batches):
        words = vocabulary(path)
        solved, searched = worker_cache("solved", path, lambda: _solved(words)), worker_cache(f"searched{n}", path, lambda: _searched(words, n))
        for batch in text_batches(batches, "text", SLICE_BYTES):
            with no_cycle_search():
                columns = encode_batch(batch.column("text"), words, solved, searched, n)
            if not with_ids:
                del columns["nbest_ids"]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | columns)

    schema = f"doc_id {kind}, n_pieces long, scores array<double>, nbest_crc32 array<bigint>, decoded_sha256 string, round_trip boolean"
    out = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(encode, schema + ", nbest_ids array<array<int>>" if with_ids else schema)
    return out.withColumn("best_ids", F.get("nbest_ids", F.lit(0))) if with_ids else out


def decode(encoded: DataFrame, ids: str = "best_ids", model: str = MODEL) -> DataFrame:
    """encoded with a column decoded: the text of its ids; null ids decode to null."""
    path = tokenizer_path(model)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema] + ["decoded string"])

    def read(batches):
        words = vocabulary(path)
        for batch in batches:
            texts = [None if x is None else words.decode(x) for x in batch.column(ids).to_pylist()]
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    return encoded.mapInArrow(read, schema)
