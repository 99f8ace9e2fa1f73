"""Token ids of documents in sorted-string-table shards.

A shard file holds documents in ascending order of a key, the doc_id in bytes
that sort like it (null first). It is a run of blocks of entries, where an entry
leaves out the bytes that its key shares with the key before it in the block;
then a sparse index with the last key of each block and the ids before it, a
Bloom filter of the keys, and a footer:

    entry   = shared:u16  unshared:u16  n_ids:u32  unshared key bytes  ids (u16 or u32)
    index   = per block: key length:u16  last key  offset:u64  length:u32  ids before it:u64
    bloom   = bits, 10 to a key, 7 probes
    footer  = index offset:u64  blocks:u32  bloom offset:u64  bloom bytes:u32
              documents:u64  ids:u64  bytes an id:u32  magic:4

All numbers are little-endian. A shard is written block by block and read block
by block, so its size is not bound by memory. A lookup reads the footer, asks
the Bloom filter, searches the index, and scans one block. Shards are numbered
in key order.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import materialise, scratch_path
from .tokens import PartCache, encoder, no_cycle_search, text_batches, tokenizer_path, worker_cache

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
BLOCK_BYTES = 64 << 10
SHARD_BYTES = 256 << 20
SLICE_BYTES = 2 << 20
BITS_A_KEY, PROBES = 10, 7
MAGIC = b"LTS2"
#: What the format has room for; longer ids are an error.
MOST_KEY_BYTES = 65_000
_ENTRY, _INDEX, _FOOTER = struct.Struct("<HHI"), struct.Struct("<QIQ"), struct.Struct("<QIQIQQI4s")


def encode_key(doc_id: int | str | None) -> bytes:
    if doc_id is None:
        return b"\x00"
    if isinstance(doc_id, str) and len(doc_id.encode()) > MOST_KEY_BYTES:
        raise ValueError(f"ids of more than {MOST_KEY_BYTES} bytes can't be keys")
    return b"\x02" + doc_id.encode() if isinstance(doc_id, str) else b"\x01" + (doc_id + (1 << 63)).to_bytes(8, "big")


def decode_key(key: bytes) -> int | str | None:
    return None if key[0] == 0 else int.from_bytes(key[1:], "big") - (1 << 63) if key[0] == 1 else key[1:].decode()


def _hashes(key: bytes) -> tuple[int, int]:
    return zlib.crc32(key), zlib.crc32(key[::-1] + b"b") | 1


class ShardWriter:
    """Writes a shard to an open file: entries in key order, then close."""

    def __init__(self, file, id_bytes: int):
        self._file, self._id_bytes = file, id_bytes
        self._block, self._index, self._hashes = bytearray(), bytearray(), []
        self._last = b""
        self._at = self._before = self._blocks = 0
        self.documents = self.ids = 0

    def add(self, key: bytes, ids) -> None:
        """ids are bytes of id_bytes each."""
        shared = len(os.path.commonprefix([self._last, key])) if self._block else 0
        n = len(ids) // self._id_bytes
        self._block += _ENTRY.pack(shared, len(key) - shared, n) + key[shared:]
        self._block += ids
        self._last = key
        self._hashes.append(_hashes(key))
        self.documents += 1
        self.ids += n
        if len(self._block) >= BLOCK_BYTES:
            self._end_block()

    def _end_block(self) -> None:
        self._index += struct.pack("<H", len(self._last)) + self._last + _INDEX.pack(self._at, len(self._block), self._before)
        self._file.write(bytes(self._block))
        self._at += len(self._block)
        self._blocks += 1
        self._block, self._before = bytearray(), self.ids

    def close(self) -> None:
        if self._block:
            self._end_block()
        bits = max(64, BITS_A_KEY * self.documents)
        a, b = np.array(self._hashes, np.uint64).reshape(-1, 2).T
        bloom = np.zeros(-(-bits // 8) * 8, bool)
        for k in range(PROBES):
            bloom[(a + np.uint64(k) * b) % np.uint64(bits)] = True
        bloom = np.packbits(bloom, bitorder="little").tobytes()
        self._file.write(bytes(self._index))
        self._file.write(bloom)
        self._file.write(_FOOTER.pack(self._at, self._blocks, self._at + len(self._index), len(bloom), self.documents, self.ids, self._id_bytes, MAGIC))


class Shard:
    """A shard in an open seekable file, read block by block or looked up by doc_id."""

    def __init__(self, file):
        self._file = file
        file.seek(0, os.SEEK_END)
        end = file.tell() - _FOOTER.size
        at, blocks, bloom, bloom_bytes, self.documents, self.ids, self.id_bytes, magic = _FOOTER.unpack(self._read(end, _FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self._bloom = self._read(bloom, bloom_bytes)
        index, self._index, at = self._read(at, bloom - at), [], 0
        for _ in range(blocks):
            (size,) = struct.unpack_from("<H", index, at)
            self._index.append((index[at + 2 : at + 2 + size], *_INDEX.unpack_from(index, at + 2 + size)))
            at += 2 + size + _INDEX.size

    def _read(self, at: int, size: int) -> bytes:
        self._file.seek(at)
        return self._file.read(size)

    def _entries(self, offset: int, length: int) -> Iterator[tuple[bytes, np.ndarray]]:
        block, at, key, kind = self._read(offset, length), 0, b"", np.dtype(f"<u{self.id_bytes}")
        while at < length:
            shared, unshared, n = _ENTRY.unpack_from(block, at)
            at += _ENTRY.size
            key = key[:shared] + block[at : at + unshared]
            at += unshared
            yield key, np.frombuffer(block, kind, n, at)
            at += n * self.id_bytes

    def blocks(self) -> Iterator[list[tuple[int | str | None, int, np.ndarray]]]:
        """Block by block its (doc_id, ids before it in this shard, its ids)."""
        for _, offset, length, start in self._index:
            out = []
            for key, ids in self._entries(offset, length):
                out.append((decode_key(key), start, ids))
                start += len(ids)
            yield out

    def get(self, doc_id: int | str | None) -> np.ndarray | None:
        """The ids of the first document of that id, or None."""
        key = encode_key(doc_id)
        bits, (a, b) = max(64, BITS_A_KEY * self.documents), _hashes(key)
        if any(not self._bloom[p >> 3] >> (p & 7) & 1 for p in ((a + k * b) % bits for k in range(PROBES))):
            return None
        low, high = 0, len(self._index)
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if self._index[mid][0] < key else (low, mid)
        return next((ids for k, ids in self._entries(*self._index[low][1:3]) if k == key), None) if low < len(self._index) else None


def _store(path: str):
    """(filesystem, path in it) of a path with a scheme that pyarrow knows; None and a plain path where it is local."""
    if path.startswith("file:") or "://" not in path:
        return None, "/" + path.removeprefix("file:").lstrip("/")
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1).replace("abfss://", "abfs://", 1))


@contextmanager
def _new_file(folder: str, name: str):
    """A file that is there whole under its name or not at all; a task that runs again replaces it."""
    store, folder = _store(folder)
    part, whole = f"{folder}/.{name}.{uuid.uuid4().hex}", f"{folder}/{name}"
    if store is None:
        os.makedirs(folder, exist_ok=True)
        with open(part, "wb") as f:
            yield f
        os.replace(part, whole)
    else:
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(part) as f:
            yield f
        store.move(part, whole)


@contextmanager
def open_shard(path: str) -> Iterator[Shard]:
    """A shard's file, of which only what is asked for is read."""
    store, path = _store(path)
    with open(path, "rb") if store is None else store.open_input_file(path) as f:
        yield Shard(f)


def _key_type(docs: DataFrame, id: str) -> str:
    return "long" if isinstance(docs.schema[id].dataType, T.IntegralType) else "string"


def write_shards(docs: DataFrame, folder: str, text: str = "text", id: str = "doc_id", tokenizer: str = TOKENIZER, end_id: int = END_ID, shards: int | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write all documents as shards into folder; one row per file: part, name, documents, ids.

    The rows are range-partitioned by id, sorted and encoded where they are
    written. Rows of one doc_id stay side by side; null texts are empty and have
    the end id alone; null doc_ids come first; an empty table writes nothing. Ids
    that are no integers are taken as text, of 65,000 bytes at most. Rows of one id are in order of a
    hash of their texts and may lie in several shards. Vocabularies of up to 65,536 ids
    take two bytes an id, others four. Evaluating the result writes the files.
    """
    path = tokenizer_path(tokenizer)
    size = 2 if max(encoder(path).size - 1, end_id) < 1 << 16 else 4
    parts = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.col("doc_id").asc_nulls_first()
    own = docs.select(F.col(id).cast(_key_type(docs, id)).alias("doc_id"), F.col(text).alias("text"))
    # a hash of the text parts the rows of an id that very many rows have, as null may be
    ordered = own.repartitionByRange(parts, first, F.xxhash64("text")).sortWithinPartitions(first, F.xxhash64("text"), "text")

    def documents(batches):
        """(doc_id, bytes of its ids with the end id) in order."""
        tokens, kind = encoder(path), np.dtype(f"<u{size}")
        end = np.array([end_id], kind).tobytes()
        cache = worker_cache(f"ids{size}", path, lambda: PartCache(lambda parts: [np.array(ids, kind).tobytes() for ids in tokens.ids(parts)]))
        for batch in text_batches(batches, "text", SLICE_BYTES):
            with no_cycle_search():
                split = tokens.parts(batch.column("text"))
                data, offsets = split.spread(cache.values(split.distinct.to_pylist()))
            data, offsets = memoryview(data), offsets[split.firsts].tolist()
            for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                yield doc_id, bytes(data[offsets[k] : offsets[k + 1]]) + end

    def write(batches):
        from pyspark import TaskContext

        part, rows, n = TaskContext.get().partitionId(), documents(batches), 0
        row = next(rows, None)
        while row:
            name = f"shard-{part:07d}-{n:05d}.sst"
            with _new_file(folder, name) as f:
                shard = ShardWriter(f, size)
                while row and shard.ids * size < shard_bytes:
                    shard.add(encode_key(row[0]), row[1])
                    row = next(rows, None)
                shard.close()
            n += 1
            yield pa.record_batch([pa.array([x]) for x in (part, name, shard.documents, shard.ids)], ["part", "name", "documents", "ids"])

    return ordered.mapInArrow(write, "part long, name string, documents long, ids long")


def _per_block(spark: SparkSession, folder: str, rows, schema: str) -> DataFrame:
    """rows(shard, block) -> record batch, for every block of the files in folder; only paths go to the tasks."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.sst").load(folder)

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_shard(path) as shard:
                    for block in shard.blocks():
                        yield rows(path.rsplit("/", 1)[1], block)

    return files.select("path").mapInArrow(read, schema)


def _kind(ids: str) -> pa.DataType:
    return pa.int64() if ids == "long" else pa.string()


def read_shards(spark: SparkSession, folder: str, id_type: str = "long") -> DataFrame:
    """shard, doc_id, start (ids before it in its shard), ids (array<int>) of all files."""

    def rows(name, block):
        ids = pa.array([x.astype(np.int32) for _, _, x in block], pa.list_(pa.int32()))
        return pa.record_batch([pa.array([name] * len(block)), pa.array([d for d, _, _ in block], _kind(id_type)), pa.array([s for _, s, _ in block], pa.int64()), ids], ["shard", "doc_id", "start", "ids"])

    return _per_block(spark, folder, rows, f"shard string, doc_id {id_type}, start long, ids array<int>")


def read_digests(spark: SparkSession, folder: str, id_type: str = "long") -> DataFrame:
    """shard, doc_id, start (in its shard), n_tokens, ids_crc32 of all documents in the files."""

    def rows(name, block):
        columns = zip(*[(name, d, s, len(ids), zlib.crc32(ids.astype("<u4"))) for d, s, ids in block], strict=True)
        kinds = (pa.string(), _kind(id_type), pa.int64(), pa.int64(), pa.int64())
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    return _per_block(spark, folder, rows, f"shard string, doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def shard_starts(files: DataFrame) -> DataFrame:
    """shard, before: the ids of all shards before it, from the rows of write_shards.

    Sums of the parts are added up, then of the files inside each part.
    """
    earlier = lambda w: F.coalesce(F.sum("ids").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    by_part = files.groupBy("part").agg(F.sum("ids").alias("ids"))
    parts = by_part.select("part", earlier(W.orderBy("part")).alias("parts_before"))  # a row a range partition
    inside = files.select("part", F.col("name").alias("shard"), earlier(W.partitionBy("part").orderBy("name")).alias("files_before"))
    return inside.join(parts, "part").select("shard", (F.col("parts_before") + F.col("files_before")).alias("before"))


def round_trip(docs: DataFrame, text: str = "text", id: str = "doc_id", tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Write the shards to the shared folder and read them back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    spark, kind = docs.sparkSession, _key_type(docs, id)
    folder = scratch_path(spark, "shards")
    files = materialise(write_shards(docs, folder, text, id, tokenizer, end_id), "shard-list")
    if files.isEmpty():
        return spark.createDataFrame([], f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
    found = read_digests(spark, folder, kind).join(shard_starts(files), "shard")
    return found.select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
