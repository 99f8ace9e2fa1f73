"""Tables that cut lineage, in the folder that executors and driver share."""

from __future__ import annotations

import tempfile
import threading
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession


class Scope:
    """The folders of tables that some work has written and not yet deleted, in order.

    Each thread works in a scope of its own, or in the one that it has entered.
    Nothing that works in one scope deletes the folders of another. Leaving a
    scope deletes nothing, as results may still read its tables; close does.
    """

    def __init__(self):
        self.folders: list[str] = []

    def __enter__(self) -> Scope:
        _entered().append(self)
        return self

    def __exit__(self, *_) -> None:
        _entered().pop()

    def path(self, spark: SparkSession, name: str) -> str:
        """A new folder."""
        path = f"{shared_dir(spark)}/longtide/{name}-{uuid.uuid4().hex}"
        self.folders.append(path)
        return path

    def delete(self, spark: SparkSession, folder: str) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        self.folders.remove(folder)

    def delete_unread(self, docs: DataFrame) -> None:
        """Delete the folders that docs does not read."""
        read = docs.inputFiles() if self.folders else []
        for folder in [*self.folders]:
            if not any(folder.rsplit("/", 1)[1] in f for f in read):
                self.delete(docs.sparkSession, folder)

    def close(self, spark: SparkSession) -> None:
        """Delete all of them; results that read them can't be used any more."""
        for folder in [*self.folders]:
            self.delete(spark, folder)


_threads = threading.local()
#: The folder that a frame reads.
_folder_of: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _entered() -> list[Scope]:
    if not hasattr(_threads, "scopes"):
        _threads.scopes = [Scope()]
    return _threads.scopes


def scope() -> Scope:
    """The one that this thread works in."""
    return _entered()[-1]


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Where that is unset, a temporary one if all executors are on this machine, as
    in tests; on a cluster that would be another folder on every executor, so it
    is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="longtide-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return scope().path(spark, name)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read again.

    Every later use reads the files: a lost executor costs a re-read, not the
    work above, and ids that were given out stay the same.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _folder_of[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that this scope has materialised and nothing reads any more."""
    own = scope()
    for df in tables:
        if (folder := _folder_of.get(df)) in own.folders:
            own.delete(df.sparkSession, folder)


def mark() -> frozenset[str]:
    """The scope's folders that are there now, for discard_since."""
    return frozenset(scope().folders)


def discard_since(spark: SparkSession, point: frozenset[str], *keep: DataFrame) -> None:
    """Delete all tables that the scope has written since that point but those to keep."""
    own, kept = scope(), {_folder_of.get(df) for df in keep}
    for folder in [f for f in own.folders if f not in point]:
        if folder not in kept:
            own.delete(spark, folder)
