"""Landed payloads: wide CSV files of stations, and metadata documents."""

from __future__ import annotations

from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import NULL_TOKENS
from ..functions.times import strict_time
from ..operators.analytics import small
from . import files

#: Fixed value: the first line of a payload.
SEQUENCE = "station_observations"
#: Bytes of a payload that one task reads at a time.
RANGE_BYTES = 64 << 20
#: Bytes that are read at first where the end of a line is looked for.
LINE_BYTES = 1 << 10
#: Lines that go on in one batch.
BATCH_LINES = 10_000


def land(contents: DataFrame, path: str) -> None:
    """network_name, native_id, content as files <network>/<native_id>.txt below path, a row a file; each appears whole."""
    files.make_folder(path)

    def write(rows):
        for r in rows:
            files.put(f"{path}/{r.network_name}/{r.native_id}.txt", (r.content or "").encode())

    contents.select("network_name", "native_id", "content").foreachPartition(write)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """path, network_name, native_id, content of files <network>/<native_id>.csv, a row a file."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path, wholetext=True)
    where = F.col("_metadata.file_path")
    return files.select(where.alias("path"), F.regexp_extract(where, r"([^/]+)/[^/]+$", 1).alias("network_name"), F.regexp_extract(where, r"([^/]+)\.csv$", 1).alias("native_id"), F.col("value").alias("content"))


def triage(payloads: DataFrame) -> DataFrame:
    """payloads with status ('ok', 'empty', 'error'), error, header (array) and body (array of cell arrays).

    No bytes, or a header without rows, is empty. A first line other than the
    sequence name, or a header without time, is an error. Cells are trimmed and
    blank lines skipped.
    """
    lines = F.filter(F.split(F.regexp_replace(F.coalesce("content", F.lit("")), "\r", ""), "\n"), lambda x: F.trim(x) != "")
    cells = lambda line: F.transform(F.split(line, ","), lambda c: F.trim(c))
    found = payloads.withColumn("__lines", lines).withColumn("header", F.when(F.size("__lines") > 1, cells(F.col("__lines")[1])))
    found = found.withColumn(
        "error",
        F.when(F.size("__lines") == 0, F.lit(None).cast("string"))
        .when(F.trim(F.col("__lines")[0]) != SEQUENCE, F.concat(F.lit("not a sequence: "), F.substring(F.col("__lines")[0], 1, 200)))
        .when(F.col("header").isNotNull() & ~F.array_contains("header", "time"), F.lit("no time column")),
    )
    status = F.when(F.col("error").isNotNull(), "error").when(F.size("__lines") <= 2, "empty").otherwise("ok")
    body = F.transform(F.slice("__lines", F.lit(3), F.greatest(F.size("__lines") - 2, F.lit(0))), cells)
    return found.withColumn("status", status).withColumn("body", F.when(status == "ok", body)).drop("__lines")


def read_payload_lines(spark: SparkSession, path: str, pattern: str = "*.csv", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, network_name, native_id, status, error, header, at, line of payload files, read in ranges of bytes.

    A file may have any size: its ranges are dealt out, each reads the file's
    first two lines for the header and then the lines that begin in it, wherever they
    end. at is where a line begins. Each file has one row without a line that
    says its status, as triage does ('ok', 'empty', 'error'); only files that are
    ok have lines. Names come from folder and file, or from network_name= and
    native_id= in the path. Blank lines are skipped; bytes that are no UTF-8 are replaced.
    """
    listed = files.listed(spark, path, pattern)
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
    ranges = listed.select("path", "length", F.explode(starts).alias("start"))  # rows of a few numbers
    # a number of tasks is given, as by the size of these rows they would be one; ranges side by side go to one task
    tasks, stripe = 4 * spark.sparkContext.defaultParallelism, F.floor(F.col("start") / max(range_bytes, RANGE_BYTES))
    ranges = ranges.repartition(tasks, "path", stripe).sortWithinPartitions("path", "start")

    def blocks(batches):
        wanted = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "start")), strict=True))
        for name, own in groupby(wanted, itemgetter(0)):
            with files.opened(name) as f:
                head = None
                for _, length, start in own:
                    status, error, header, body = head = head or _head(f, length)
                    found = _lines(f, max(start, body), start > body, min(start + range_bytes, length)) if status == "ok" else iter(())
                    if start == 0:
                        block = next(found, [])
                        if status == "ok" and not block and range_bytes >= length:
                            status = "empty"
                        yield name, status, error, header, [(None, None), *block]
                    for block in found:
                        yield name, status, error, header, block

    def read(batches):
        held, lines, size = [], 0, 0
        for part in blocks(batches):
            held.append(part)
            lines, size = lines + len(part[-1]), size + sum(len(x or "") for _, x in part[-1])
            if lines >= BATCH_LINES or size >= files.CHUNK_BYTES:
                yield _line_batch(held)
                held, lines, size = [], 0, 0
        if held:
            yield _line_batch(held)

    found = ranges.mapInArrow(read, "path string, status string, error string, header array<string>, at long, line string")
    named = lambda key, last: F.coalesce(F.nullif(F.regexp_extract("path", f"{key}=([^/]+)", 1), F.lit("")), F.regexp_extract("path", last, 1))
    return found.select("path", named("network_name", r"([^/]+)/[^/]+$").alias("network_name"), named("native_id", r"([^/]+)\.[^./]+$").alias("native_id"), "status", "error", "header", "at", "line")


def _head(f, length: int) -> tuple[str, str | None, list[str] | None, int]:
    """status, error, header of an open payload, and where its rows begin."""
    held, at, seen = b"", 0, []
    while len(seen) < 2:
        end = held.find(b"\n", at)
        if end < 0 and len(held) < length:
            f.seek(len(held))
            held += f.read(min(files.CHUNK_BYTES, max(LINE_BYTES, len(held))))
            continue
        line = held[at : end if end >= 0 else len(held)].decode("utf-8", "replace").replace("\r", "").strip(" ")
        at = end + 1 if end >= 0 else len(held)
        if line:
            seen.append(line)
        if seen and seen[0] != SEQUENCE:
            return "error", f"not a sequence: {seen[0][:200]}", None, at
        if end < 0:
            break
    if len(seen) < 2:
        return "empty", None, None, at
    header = [c.strip(" ") for c in seen[1].split(",")]
    return ("ok", None, header, at) if "time" in header else ("error", "no time column", header, at)


def _lines(f, start: int, inside: bool, end: int):
    """Blocks of (place, line) of the lines that begin in [start, end); inside: start may be in the middle of a line."""
    at = start - 1 if inside else start
    f.seek(at)
    left, skip = b"", inside
    while at < end:
        # up to the end, and then by little more until the last line's
        chunk = f.read(min(files.CHUNK_BYTES, max(end - at - len(left), LINE_BYTES, len(left))))
        pieces = (left + chunk).split(b"\n")
        left = pieces.pop() if chunk else b""
        block = []
        for line in pieces:
            if at >= end:
                break
            if not skip and line.strip(b" \r"):
                block.append((at, line.decode("utf-8", "replace").replace("\r", "")))
            skip, at = False, at + len(line) + 1
        if block:
            yield block
        if not chunk:
            return


def _line_batch(parts: list[tuple]) -> pa.RecordBatch:
    """One batch of (name, status, error, header, block)."""
    same = lambda x, n, kind: pa.nulls(n, kind) if x is None else pa.repeat(pa.scalar(x, kind), n)
    whole = [pa.concat_arrays([same(p[i], len(p[-1]), kind) for p in parts]) for i, kind in enumerate((pa.string(), pa.string(), pa.string(), pa.list_(pa.string())))]
    lines = [x for p in parts for x in p[-1]]
    return pa.record_batch([*whole, pa.array([a for a, _ in lines], pa.int64()), pa.array([x for _, x in lines], pa.string())], ["path", "status", "error", "header", "at", "line"])


def cells_of_lines(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells, rejects) of read_payload_lines, as long_cells gives them; line is where a rejected line begins."""
    trimmed = F.transform(F.split("line", ","), lambda c: F.trim(c))
    return _cells_and_rejects(found.where("line is not null").select("path", "network_name", "native_id", "header", F.col("at").alias("line"), trimmed.alias("cells")))


def long_cells(triaged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells, rejects) of payloads that are ok.

    cells: network_name, native_id, name, obs_time, raw, value with nulls left out.
    rejects: path, line, reason of lines with another number of cells than the
    header, without a time, or with a cell that is no number.
    """
    return _cells_and_rejects(triaged.where("status = 'ok'").select("path", "network_name", "native_id", "header", F.posexplode("body").alias("line", "cells")))


def _cells_and_rejects(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    fits = F.size("cells") == F.size("header")
    lines = lines.withColumn("time_cell", F.when(fits, F.try_element_at("cells", F.array_position("header", "time").cast("int"))))
    lines = lines.withColumn("obs_time", strict_time(F.col("time_cell")))
    bad = lines.where(~fits | F.col("obs_time").isNull()).select("path", "line", F.when(~fits, "cells do not match the header").otherwise("no time").alias("reason"))
    good = lines.where(fits & F.col("obs_time").isNotNull()).select("path", "line", "network_name", "native_id", "obs_time", F.explode(F.arrays_zip(F.col("header").alias("name"), F.col("cells").alias("raw"))).alias("c"))
    values = good.select("path", "line", "network_name", "native_id", "obs_time", "c.name", "c.raw").where("name <> 'time'")
    values = values.withColumn("missing", F.col("raw").isin(NULL_TOKENS)).withColumn("value", F.when(~F.col("missing"), F.col("raw").try_cast("double")))
    wrong = values.where(~F.col("missing") & F.col("value").isNull()).select("path", "line", F.concat(F.lit("no number in "), "name").alias("reason"))
    return values.select("network_name", "native_id", "name", "obs_time", "raw", "value"), bad.unionByName(wrong)


def unmapped_columns(cells: DataFrame, variables: DataFrame, networks: DataFrame) -> DataFrame:
    """network_name, name of columns that no variable of the network has, also where all their cells are missing."""
    known = variables.join(small(networks.select("network_id", "network_name")), "network_id").select("network_name", "name").distinct()
    return cells.select("network_name", "name").distinct().join(known, ["network_name", "name"], "left_anti")


def observations_of(cells: DataFrame, stations: DataFrame, variables: DataFrame, networks: DataFrame) -> DataFrame:
    """Long observations: cells with a value, their station and variable by natural key.

    Of variables that share (network, name) the largest id is taken.
    """
    lookup = variables.join(small(networks.select("network_id", "network_name")), "network_id").groupBy("network_name", "name").agg(F.max("variable_id").alias("variable_id"))
    own = cells.where(F.col("value").isNotNull()).join(small(stations.select("network_name", "native_id", "station_id")), ["network_name", "native_id"])
    return own.join(small(lookup), ["network_name", "name"]).select("station_id", "variable_id", "obs_time", "value")


def unpivot(wide: DataFrame, ids: list[str], values: list[str]) -> DataFrame:
    """ids, name, value of the wide table's value columns; nulls are left out."""
    return wide.unpivot(ids, values, "name", "value").where(F.col("value").isNotNull())


_HISTORY = (
    "id:int,station_name:string,lon:double,lat:double,elevation:double,province:string,country:string,freq:string,"
    "tz_offset:string,sdate:string,edate:string,min_obs_time:string,max_obs_time:string,variable_ids:array<int>"
)
#: Fixed names and types of the five metadata documents.
DOCUMENTS = {
    "networks": "id int, name string, long_name string, color string, publish boolean, station_count int",
    "variables": "id int, network_uri string, name string, display_name string, short_name string, standard_name string, cell_method string, unit string, precision double, tags array<string>",
    "stations": f"id int, native_id string, network_uri string, histories array<struct<{_HISTORY}>>",
    "histories": _HISTORY.replace(":array<int>", " array<int>").replace(":", " "),
    "frequencies": "freq string",
}


def read_document(spark: SparkSession, path: str, name: str, lines: bool = False) -> DataFrame:
    """One of the landed JSON arrays, with its schema declared; lines: one object a line, which is read in parallel."""
    return spark.read.schema(DOCUMENTS[name]).option("multiLine", not lines).json(path)
