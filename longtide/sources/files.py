"""Files as rows: listings, Parquet footers, checksums. Contents stay where they are; paths travel."""

from __future__ import annotations

import hashlib
import uuid
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import MULTIHASH_SHA256, path_period

FOOTERS = (
    "path string, file_bytes bigint, row_group int, rows bigint, column string, type string, encodings string, "
    "min_int bigint, max_int bigint, min_time timestamp_ntz, max_time timestamp_ntz"
)
CHUNK_BYTES = 4 << 20


@contextmanager
def opened(path: str):
    """A seekable file of a local path, or of any store that pyarrow knows."""
    if path.startswith("file:") or "://" not in path:
        with pa.OSFile("/" + path.removeprefix("file:").lstrip("/")) as f:
            yield f
        return
    store, inner = _store(path)
    with store.open_input_file(inner) as f:
        yield f


@contextmanager
def created(path: str):
    """A new file to write to, in a folder that is there."""
    if path.startswith("file:") or "://" not in path:
        with pa.OSFile("/" + path.removeprefix("file:").lstrip("/"), "w") as f:
            yield f
        return
    store, inner = _store(path)
    with store.open_output_stream(inner) as f:
        yield f


def _store(path: str):
    """The filesystem of a path, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1).replace("abfss://", "abfs://", 1))


def make_folder(path: str) -> None:
    store, inner = _store(path)
    store.create_dir(inner, recursive=True)


def put(path: str, content: bytes) -> None:
    """A file that appears whole: written beside under a hidden name and renamed."""
    store, inner = _store(path)
    folder = inner.rpartition("/")[0]
    store.create_dir(folder, recursive=True)
    beside = f"{folder}/.{uuid.uuid4().hex}"
    with store.open_output_stream(beside) as f:
        f.write(content)
    store.move(beside, inner)


def listed(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """path, length of the files below root, dealt out by name: the reader of a whole file is not asked for its content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length")


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """path, file_bytes, period of every file below root; contents are not read."""
    return listed(spark, root, pattern).select("path", F.col("length").alias("file_bytes"), path_period(F.col("path")).alias("period"))


def sha256_of(file) -> str:
    """The digest of an open file, a bounded chunk at a time."""
    digest = hashlib.sha256()
    while chunk := file.read(CHUNK_BYTES):
        digest.update(chunk)
    return digest.hexdigest()


def checksums(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, file_bytes, multihash of every file below root; a file is read in chunks, so its size does not matter."""

    def read(batches):
        for batch in batches:
            hashes = []
            for path in batch.column("path").to_pylist():
                with opened(path) as f:
                    hashes.append(MULTIHASH_SHA256 + sha256_of(f))
            yield pa.record_batch([batch.column("path"), batch.column("length"), pa.array(hashes, pa.string())], ["path", "file_bytes", "multihash"])

    return listed(spark, root, pattern).mapInArrow(read, "path string, file_bytes bigint, multihash string")


def footer_rows(path: str, size: int, file) -> list[tuple]:
    """A row for each row group and column of an open Parquet file; only its tail is read."""
    meta, out = pq.read_metadata(file), []
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        for c in range(group.num_columns):
            column = group.column(c)
            stats = column.statistics
            lo, hi = (stats.min, stats.max) if stats is not None and stats.has_min_max else (None, None)
            whole = isinstance(lo, int) and not isinstance(lo, bool)
            timed = hasattr(lo, "year")
            out.append((path, size, g, group.num_rows, column.path_in_schema, str(column.physical_type), ",".join(sorted(column.encodings)), lo if whole else None, hi if whole else None, lo if timed else None, hi if timed else None))
    return out


def footers(spark: SparkSession, root: str, of: DataFrame | None = None) -> DataFrame:
    """A row for each file, row group and column below root, or of the files given (path, file_bytes), from the files' tails, read on the executors."""
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.timestamp("us"), pa.timestamp("us"))
    names = [x.split()[0] for x in FOOTERS.split(", ")]

    def read(batches):
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                with opened(path) as f:
                    rows = footer_rows(path, size, f)
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    found = listed(spark, root, "*.parquet") if of is None else of.select("path", F.col("file_bytes").alias("length"))
    return found.mapInArrow(read, FOOTERS)
