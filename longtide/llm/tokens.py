"""Exact token ids and counts of whole texts, by way of parts that texts repeat.

A byte-level BPE with the usual split pattern ends a pre-token at many places
that can be seen from two or three neighbouring bytes, as before a space that a
non-space follows. The ids of a text are then the ids of the parts between such
places, one after the other. Parts are cut and looked up a batch at a time, and
each distinct one is encoded by the library once. For tokenizers of any other
kind, which is read from their files, a part is a whole text.
"""

from __future__ import annotations

import gc
import json
import os
import string
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import packed

#: Bytes of parts and values that one worker keeps of each kind, in two generations.
CACHE_BYTES = 200 << 20
#: What an entry takes in memory beside its bytes.
ENTRY_BYTES = 150


def tokenizer_path(name: str) -> str:
    """Where a file of a public tokenizer lies; every executor has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def text_batches(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about most_bytes of text, so that few long texts do not meet in one."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        first = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > most_bytes:
                yield batch.slice(first, i - first)
                first = i
                total = 0
            total += n
        yield batch.slice(first)


class Parts:
    """A batch of texts cut into parts. Equal parts have one code, the place of their bytes in distinct.

    data and offsets are the texts' bytes, cut marks the bytes at which a part
    begins; a text always begins one, and an empty text has none.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, cut: np.ndarray):
        cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        starts = np.flatnonzero(cut)
        self.firsts = np.searchsorted(starts, offsets)  # n + 1: the first part of each text
        ends = np.append(starts, len(data)).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        self.codes, self.distinct = coded.indices.to_numpy(), coded.dictionary

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For each text the sum of its parts' values; values has one for each distinct part."""
        run = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values[self.codes])))
        return run[self.firsts[1:]] - run[self.firsts[:-1]]

    def spread(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The values of all parts in order, end to end, and where each begins (one more at the end)."""
        taken = pa.array(values, pa.large_binary()).take(pa.array(self.codes))
        _, offsets, data = taken.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(taken) + 1) if len(taken) else np.zeros(1, np.int64)
        return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


class PartCache:
    """part -> value, by make(parts) -> values for those not known yet.

    The parts of a fixed table are known from the start. Of the others two
    generations are kept: when the younger has half of the bytes it becomes the
    older, from which parts that are met again come back.
    """

    def __init__(self, make: Callable[[list[bytes]], list], fixed: dict | None = None, most_bytes: int = CACHE_BYTES, weigh: Callable[[object], int] = len):
        self._make, self._fixed, self._half, self._weigh = make, fixed or {}, most_bytes // 2, weigh
        self._young: dict = dict(self._fixed)
        self._old: dict = {}
        self._bytes = 0

    def values(self, parts: list[bytes]) -> list:
        """The values of these parts."""
        if self._bytes > self._half:
            self._old, self._young, self._bytes = self._young, dict(self._fixed), 0
        young, old = self._young, self._old
        missing = [p for p in parts if p not in young]
        if missing:
            new = [p for p in missing if p not in old] if old else missing
            if len(new) < len(missing):
                young.update([(p, old[p]) for p in missing if p in old])
            young.update(zip(new, self._make(new), strict=True))
            self._bytes += ENTRY_BYTES * len(missing) + sum(map(len, missing)) + sum(map(self._weigh, map(young.__getitem__, missing)))
        return list(map(young.__getitem__, parts))


@contextmanager
def no_cycle_search():
    """Python's search for reference cycles off: lists are made and dropped by the million, without cycles."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def _table(members) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_LETTERS = _table(map(ord, string.ascii_letters))
_ALNUM = _table(map(ord, string.ascii_letters + string.digits))
_GRAPHIC = _table(range(0x21, 0x7F))
#: First bytes of characters of which some are white space: U+0085, U+00A0; U+1680; U+2000-200A, 2028, 2029, 202F, 205F; U+3000.
_DOUBTFUL = _table((0xC2, 0xE1, 0xE2, 0xE3))


class ByteLevelCuts:
    """Where the split pattern of byte-level BPE always ends a pre-token, from neighbouring bytes.

    Before a space that a non-space follows; around a lone line feed between
    characters that are no white space; between an ASCII letter or digit and ASCII
    punctuation, either way. No cut is made next to an apostrophe, which leads
    contractions, nor where it could part a special string or the white space
    before one.
    """

    def __init__(self, specials: list[str]):
        inside = {ord(c) for s in specials for c in s if ord(c) < 128}
        first = {s.encode()[0] for s in specials}
        self._solid = _GRAPHIC | _table(range(0x80, 0x100)) & ~_DOUBTFUL
        self._solid[list(first)] = False
        self._doubtful = _DOUBTFUL & ~_table(first)
        self._marks = _table({ord(c) for c in string.punctuation} - {ord("'")} - inside)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(data)
        before, after = np.full(n, 32, np.uint8), np.full(n, 32, np.uint8)
        before[1:], after[:-1] = data[:-1], data[1:]
        held = offsets[:-1] < offsets[1:]
        before[offsets[:-1][held]] = 32
        after[offsets[1:][held] - 1] = 32
        space = data == 32
        cut = space & self._solid[after]
        at = np.flatnonzero(space & self._doubtful[after])
        if len(at):
            one, two = data[at + 1], data[at + 2]
            white = ((one == 0xC2) & ((two == 0x85) | (two == 0xA0))) | ((one == 0xE1) & (two == 0x9A)) | ((one == 0xE2) & ((two == 0x80) | (two == 0x81))) | ((one == 0xE3) & (two == 0x80))
            cut[at[~white]] = True
        line = np.flatnonzero((data == 10) & _GRAPHIC[before] & self._solid[after])
        cut[line] = cut[line + 1] = True
        cut |= (self._marks[data] & _ALNUM[before]) | (_ALNUM[data] & self._marks[before])
        return cut


class Encoder:
    """A tokenizer's file: how texts may be cut, and the library's ids of parts (bytes)."""

    def __init__(self, path: str):
        self.cuts = None
        if not path.endswith(".json"):
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=path)
            self.size = len(processor)
            self.ids = lambda parts: processor.encode([p.decode() for p in parts], num_threads=1)
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        self.size = self._library.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        if self._cuttable(file):
            cuts = ByteLevelCuts([t["content"] for t in file["added_tokens"]])
            whole = [np.frombuffer(t["content"].encode(), np.uint8) for t in file["added_tokens"]]
            if not any(cuts(s, np.array([0, len(s)]))[1:].any() for s in whole):
                self.cuts = cuts
        self.ids = self._parts if self.cuts else self._texts
        # printable bytes stand for themselves in a byte-level alphabet, the others, in order, for the characters from 256 on
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self._letters = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in printable)}

    @staticmethod
    def _cuttable(file: dict) -> bool:
        """Whether the file is of a byte-level BPE that splits by the usual pattern and changes nothing before."""
        pre, model, post = file["pre_tokenizer"] or {}, file["model"], file["post_processor"]
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or any(c.isspace() for c in t["content"]) for t in file["added_tokens"])
        return (
            plain and file["normalizer"] is None and post is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") is True and not pre.get("add_prefix_space")
            and model["type"] == "BPE" and not model.get("dropout") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
        )

    def _texts(self, parts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self._library.encode_batch([p.decode() for p in parts], add_special_tokens=False)]

    def _parts(self, parts: list[bytes]) -> list[list[int]]:
        """A word with or without a space before it is one pre-token, which the model alone spells; the rest goes through the whole library."""
        tokenize, letters = self._library.model.tokenize, self._letters
        out: list = [None] * len(parts)
        rest = []
        for i, p in enumerate(parts):
            word = p[1:] if p[0] == 32 else p
            if word.isalpha():
                out[i] = [t.id for t in tokenize((letters[32] if p[0] == 32 else "") + word.decode())]
            # letters before U+0590 are the same in every version of Unicode
            elif word and max(word) < 0xD6 and word.decode().isalpha():
                out[i] = [t.id for t in tokenize(p.decode("latin-1").translate(letters))]
            else:
                rest.append(i)
        for i, ids in zip(rest, self._texts([parts[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def parts(self, texts: pa.Array) -> Parts:
        data, offsets = packed(texts)
        return Parts(data, offsets, self.cuts(data, offsets) if self.cuts else np.zeros(len(data), bool))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One of each file in a Python worker."""
    return Encoder(path)


_kept: dict = {}


def worker_cache(kind: str, path: str, make: Callable[[], PartCache]) -> PartCache:
    """One cache of each kind in a Python worker, for all tasks that it runs."""
    if (kind, path) not in _kept:
        _kept[kind, path] = make()
    return _kept[kind, path]
