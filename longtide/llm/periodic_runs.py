"""Periodic runs of words: Lyndon roots under both orders, extended to runs.

The words of a batch of texts get numbers in a random order, and the Lyndon word
that begins at each position is found as in the first phase of Baier's suffix
sorter: positions are in groups by the Lyndon word known so far, the greatest
group is settled first, and the position before its members takes them up and
moves to a group of its own. What a word takes up until the next word that is
not greater is the same for all words at once and is found on arrays; only
positions that stop at their own word again go through the groups. Members of a
group that follow each other are copies of one Lyndon word. A run of three
periods or more has two such copies side by side in one of the two orders, and
those are extended both ways by comparing words a period apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import no_cycle_search, text_batches
from .words import Words, packed

#: A run's words at least, and its periods at least.
LEAST_WORDS, LEAST_COPIES = 24, 3
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_SEED = 20


def next_not_greater(ranks: np.ndarray) -> np.ndarray:
    """For each place the next one whose rank is not greater. Where rank is 0 the place itself; the last rank must be 0."""
    at = np.arange(1, len(ranks) + 1)
    at[ranks == 0] = np.flatnonzero(ranks == 0)
    open_ = np.flatnonzero(ranks)
    while len(open_ := open_[ranks[at[open_]] > ranks[open_]]):
        # what the place in between has passed is greater than that, and so than this one
        at[open_] = at[at[open_]]
    return at


def lyndon_powers(ranks: np.ndarray, lengths: list[int]) -> list[tuple[int, int, int]]:
    """(place, length, copies) wherever two or more of one Lyndon word follow each other, as Lyndon words beginning there.

    ranks are symbols from 1; 0 separates and is below all. lengths has each symbol's length.
    """
    top = len(lengths)
    order = np.argsort(ranks, kind="stable")
    bounds = np.searchsorted(ranks[order], np.arange(top + 1)).tolist()
    places = order.tolist()
    group = ranks.tolist()
    left, right = list(range(-1, len(group) - 1)), list(range(1, len(group) + 1))
    lengths = list(lengths)
    members = [places[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    #: Groups split from each one, which come right above it, greatest first.
    above: list[list[int]] = [[] for _ in range(top)]
    found = []

    def settle(g: int) -> None:
        joined: dict[tuple[int, int], list[int]] = {}
        for i in members[g]:
            if group[i] != g or group[left[i]] == g:
                continue  # it has moved to a greater group, or is counted with the copy before it
            before, after, copies = left[i], right[i], 1
            while group[after] == g:
                after, copies = right[after], copies + 1
            right[before], left[after] = after, before
            if copies > 1:
                found.append((i, lengths[g], copies))
            if group[before]:
                joined.setdefault((group[before], copies), []).append(before)
        for (low, copies), moved in sorted(joined.items(), reverse=True):
            for i in moved:
                group[i] = len(lengths)
            above[low].append(len(lengths))
            lengths.append(lengths[low] + copies * lengths[g])
            members.append(moved)
            above.append([])

    for g in range(top - 1, 0, -1):
        waiting = [(g, 0)]
        while waiting:
            h, done = waiting.pop()
            if done < len(above[h]):
                waiting += [(h, done + 1), (above[h][done], 0)]
            else:
                settle(h)
    return found


def _ranked(items: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Ranks from 1 of the slices items[start:end] in lexicographic order, equal for equal ones, and each rank's length (0 for rank 0)."""
    raw = memoryview(items.astype(">u4").tobytes())  # byte order is then word order
    slices = [bytes(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    rank = {s: k for k, s in enumerate(sorted(set(slices)), 1)}
    return np.array([rank[s] for s in slices], np.int64), [0, *(len(s) // 4 for s in rank)]


def _powers(ranks: np.ndarray) -> list[tuple[int, int, int]]:
    """lyndon_powers of words (each of length 1) with 0 around every text, in places of ranks."""
    stop = next_not_greater(ranks)
    # chains: places that stop at their own word again, and where each chain ends
    again = (ranks > 0) & (ranks[np.minimum(stop, len(ranks) - 1)] == ranks)
    links = np.flatnonzero(again)
    if not len(links):
        return []
    own = np.union1d(links, stop[links])
    # a chain at a time; no place is in two
    head = np.ones(len(own), bool)
    head[np.searchsorted(own, stop[links])] = False
    chain_of = np.zeros(len(ranks), np.int64)
    # chains of one word do not nest, so in order of word and place a chain is a stretch
    by_word = np.lexsort((own, ranks[own]))
    own, head = own[by_word], head[by_word]
    chain_of = np.cumsum(head)
    symbols, lengths = _ranked(ranks, own, stop[own])
    at = np.arange(len(own)) + chain_of
    string = np.zeros(at[-1] + 2, np.int64)
    string[at] = symbols
    place = np.zeros(len(string), np.int64)
    place[at] = own
    return [(int(place[i]), n, k) for i, n, k in lyndon_powers(string, lengths)]


def _same(items: np.ndarray, i: int, j: int, most: int, step: int = 1) -> int:
    """How many items from i and from j on, going by step, are the same; at most `most`."""
    n, block = 0, 16
    while n < most:
        m = min(block, most - n)
        x, y = (items[a + n : a + n + m] if step > 0 else items[a - n - m + 1 : a - n + 1][::-1] for a in (i, j))
        differ = x != y
        if differ.any():
            return n + int(differ.argmax())
        n, block = n + m, 4 * block
    return n


def runs_of(codes: np.ndarray, firsts: np.ndarray, least: int = LEAST_WORDS, copies: int = LEAST_COPIES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in texts of numbered words, text k from firsts[k] to firsts[k + 1], in order.

    A run is a stretch with smallest period p and a length of at least `least` and copies * p, that can't be extended.
    """
    if copies < 3:
        raise ValueError("two copies of a root side by side are sure from three periods on")
    if not len(codes):
        return []
    firsts = np.asarray(firsts, np.int64)
    top = int(codes.max()) + 1
    ranks = np.random.default_rng(_SEED).permutation(top)[codes] + 1
    texts = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    at = np.arange(len(codes)) + texts + 1
    runs = set()
    for own in (ranks, top + 1 - ranks):
        string = np.zeros(len(codes) + len(firsts), np.int64)
        string[at] = own
        for place, period, k in _powers(string):
            if k * period + 2 * (period - 1) < max(least, copies * period):
                continue
            text = int(np.searchsorted(at, place))
            start, text = text, int(texts[text])
            lo, hi = int(firsts[text]), int(firsts[text + 1])
            end = start + k * period
            end += _same(codes, end, end - period, hi - end)
            start -= _same(codes, start - 1, start - 1 + period, start - lo, -1)
            if end - start >= max(least, copies * period):
                runs.add((start, end - start, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """Of runs by start and period the first of the greatest length / period, compared without rounding."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(docs: DataFrame, text: str = "text", id: str = "doc_id", least: int = LEAST_WORDS, copies: int = LEAST_COPIES) -> DataFrame:
    """doc_id, runs, strongest, collapsed of every row of docs.

    runs are all its runs by start and period, in numbers of words from 0;
    strongest the one of the greatest length / period, ties to the smallest start
    and then period, null without runs; collapsed the text's words joined by
    single spaces, without those that a run has after its first period. Null
    texts are empty and have no words; ids may be null, repeat and be of any
    type; rows are kept apart. Each text is held in memory whole, in about 300
    bytes a word, and texts are dealt with as they are read: nothing is shuffled.
    """
    kind = docs.schema[id].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def structs(rows):
        columns = np.array(rows, np.int64).reshape(-1, 3).T
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(run))

    def search(batches):
        for batch in text_batches(batches, "text"):
            data, offsets = packed(batch.column("text"))
            words = Words(data, offsets, lower=False)
            codes, distinct = words.coded()
            with no_cycle_search():
                found = runs_of(codes, words.firsts, least, copies)
            text_of = np.searchsorted(words.firsts, [r[0] for r in found], "right") - 1
            by_text: list[list] = [[] for _ in range(batch.num_rows)]
            change = np.zeros(len(codes) + 1, np.int64)
            for (start, length, period), t in zip(found, text_of.tolist(), strict=True):
                by_text[t].append((start - int(words.firsts[t]), length, period))
                change[start + period] += 1
                change[start + length] -= 1
            kept = np.cumsum(change[:-1]) == 0
            left = np.concatenate(([0], np.cumsum(kept)))[words.firsts]
            lists = pa.LargeListArray.from_arrays(pa.array(left), distinct.take(pa.array(codes[kept])))
            collapsed = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string()).cast(pa.string())
            counts = np.concatenate(([0], np.cumsum([len(r) for r in by_text]))).astype(np.int32)
            every = pa.ListArray.from_arrays(pa.array(counts), structs([r for own in by_text for r in own]))
            best = pa.array([None if b is None else dict(zip(("start", "length", "period"), b, strict=True)) for b in map(_strongest, by_text)], run)
            yield pa.record_batch([batch.column("doc_id"), every, best, collapsed], ["doc_id", "runs", "strongest", "collapsed"])

    own = docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return own.mapInArrow(search, f"doc_id {kind}, runs {RUNS}, strongest struct<start: bigint, length: bigint, period: bigint>, collapsed string")
