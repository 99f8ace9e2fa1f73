"""Keys held against their neighbours in files, against counting by value."""

import random

import pytest
from pyspark.sql import functions as F

from longtide import schema
from longtide.operators import merge as mg
from longtide.operators import neighbours as nb
from longtide.plans import archive
from longtide.plans import views as v
from longtide.sources import sinks


def written(spark, root, files):
    """Files (period, keys as (station, variable, day)) in the order given."""
    for period, keys in files:
        rows = [(s, v, None if d is None else f"2000-01-{d:02d} 00:00:00", 1.0) for s, v, d in keys]
        df = spark.createDataFrame(rows, "station_id int, variable_id int, t string, value double")
        df = df.select("station_id", F.col("variable_id").cast("smallint").alias("variable_id"), F.col("t").cast("timestamp_ntz").alias("obs_time"), "value")
        df.coalesce(1).write.mode("append").option("parquet.block.row.count.limit", "5").parquet(f"{root}/observations/period={period}")


def counted(spark, root):
    rows = spark.read.schema(schema.observations()).parquet(f"{root}/observations")
    return {r.period: r.extra_rows for r in mg.duplicate_keys(rows, ["period"]).collect()}


def walked(spark, root):
    return {r.period: r.extra_rows for r in nb.duplicate_keys_in_files(spark, root).collect()}


def test_sorted_files_with_repeats_inside_and_across(spark, tmp_path):
    a, b, c = (1, 1, 1), (1, 1, 2), (2, 1, 1)
    files = [("2000", [a, a, b]), ("2000", [b, b, b]), ("2000", [b, c, c, c]), ("2001", [a, b, c]), ("2002", [a]), ("2002", [a]), ("2002", [a, b]), ("2003", [b, c]), ("2003", [a])]
    written(spark, str(tmp_path), files)
    assert walked(spark, str(tmp_path)) == counted(spark, str(tmp_path)) == {"2000": 7, "2002": 2}
    plan = nb.duplicate_keys_in_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan  # what is exchanged is one row a stretch, read from a table


@pytest.mark.parametrize("seed", range(4))
def test_files_of_any_order(spark, tmp_path, seed):
    """Sorted or not, across each other or not, with nulls and empty files."""
    rng = random.Random(seed)
    files = []
    for period in ("2000", "2001", "2002-2004"):
        at = 0
        for _ in range(rng.randint(1, 5)):
            keys = []
            for _ in range(rng.randint(0, 9)):
                at += rng.randint(0, 2)
                day = None if rng.random() < 0.05 else 1 + at % 28
                keys.append((at // 28, 1, day))
            if rng.random() < 0.3:
                keys = [(rng.randint(0, 1), 1, rng.randint(1, 12)) for _ in range(8)]
            files.append((period, sorted(keys, key=lambda k: (k[0], k[1], k[2] or 0)) if period != "2001" else keys))
    rng.shuffle(files)
    written(spark, str(tmp_path), files)
    assert walked(spark, str(tmp_path)) == counted(spark, str(tmp_path))


def test_bounds(spark, tmp_path):
    written(spark, str(tmp_path), [("2000", [(1, 1, d) for d in range(1, 21)]), ("2001", [(2, 1, 5), (1, 1, 5), (1, 1, 5), (None, 1, 6)])])
    found = {r.path.split("period=")[1][:4]: r for r in nb.key_bounds(nb.key_segments(spark, str(tmp_path))).collect()}
    first, second = found["2000"], found["2001"]
    assert (first.first_key.station_id, first.extra, first.down, first.nulls) == (1, 0, 0, 0) and first.last_key.obs_time - first.first_key.obs_time == 19 * 86_400_000_000
    assert (second.first_key.station_id, second.extra, second.down, second.nulls) == (2, 1, 2, 1)
    assert nb.key_segments(spark, str(tmp_path), []).count() == 0


def test_files_are_walked_once_by_few_tasks(spark, tmp_path):
    written(spark, str(tmp_path), [("2000", [(k, 1, 1)]) for k in range(40)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # what opening a file counts for: a split a file
    try:
        found = nb.key_segments(spark, str(tmp_path))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1
        splits = nb._rows(spark, str(tmp_path), None).rdd.getNumPartitions()
        assert nb._few_tasks(nb._rows(spark, str(tmp_path), None)).rdd.getNumPartitions() <= max(16, splits // 8) < splits
        assert sorted(r.first.station_id for r in found.where("rows > 0").collect()) == list(range(40))
        assert found.where("path is null").isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("seed", range(2))
def test_files_of_a_table(spark, tmp_path, seed, monkeypatch):
    """Files named by a table are opened by the tasks: sorted, unsorted, across each other, empty, with nulls, of several pieces."""
    rng = random.Random(10 + seed)
    files = [(p, sorted((rng.randint(0, 3), 1, rng.randint(1, 28)) for _ in range(rng.randint(0, 12)))) for p in ("2000", "2001") for _ in range(6)]
    files += [("2002", [(2, 1, 5), (1, 1, 5), (1, 1, 5), (None, 1, 6)]), ("2003", [(1, 1, 1)] * 3), ("2003", [(1, 1, 1)] * 2), ("2003", [(1, 1, 1), (1, 1, 2)])]
    written(spark, str(tmp_path), files)
    named = nb.fl.list_files(spark, f"{tmp_path}/observations").select("path")
    assert {r.period: r.extra_rows for r in nb.duplicate_keys_in_files(spark, str(tmp_path), files=named).collect()} == counted(spark, str(tmp_path))
    paths = [r.path for r in named.collect()]
    batch = nb.pa.record_batch([nb.pa.array(paths), nb.pa.array(range(len(paths)), nb.pa.int64())], ["path", "file"])
    whole = [r for b in nb._walked(nb._read(iter([batch]))) for r in b.to_pylist()]
    monkeypatch.setattr(nb, "_BATCH_ROWS", 2)  # large files go on in pieces
    pieces = list(nb._read(iter([batch])))
    assert [r for b in nb._walked(iter(pieces)) for r in b.to_pylist()] == whole and max(b.num_rows for b in pieces) <= 3


def test_files_written_in_order(spark, tmp_path):
    """As many rows a file as asked for, in the order of the rows, without a commit of Spark's for each; only files in the table count."""
    rows = spark.range(1000).selectExpr("cast(id div 7 as int) as station_id", "cast(1 as smallint) as variable_id", "timestamp_ntz'2000-01-01' + make_dt_interval(cast(id as int)) as obs_time", "cast(id as double) as value")
    rows = rows.withColumn("period", F.when(F.col("value") < 990, F.year("obs_time").cast("string")))
    kept = rows.repartitionByRange(3, "period", *schema.KEYS).sortWithinPartitions("period", *schema.KEYS)
    found = sinks.write_in_order(kept, f"{tmp_path}/observations", 9, f"{tmp_path}/written").collect()
    assert sum(r.rows for r in found) == 1000 and max(r.rows for r in found) == 9 and sum(r.rows < 9 for r in found) <= 4 + 3
    back = spark.read.schema(schema.observations()).parquet(*[r.path for r in found])
    assert sorted(back.select(*schema.KEYS, "value").collect()) == sorted(rows.select(*schema.KEYS, "value").collect())
    for r in found:
        values = [x.value for x in spark.read.parquet(r.path).select("value").collect()] if r.rows < 9 else None
        assert values is None or values == sorted(values)
    assert {r.path.split("period=")[1][:4] for r in found} == {"2000", "2001", "2002", "__HI"}


def test_no_writer_of_spark_for_each_file(spark, monkeypatch):
    """The query's files are opened and written by tasks: 97 rows each, by no writer with a limit of rows."""
    seen = []
    write = sinks.write_in_order
    monkeypatch.setattr(sinks, "write_in_order", lambda rows, path, most, listed: seen.append(write(rows, path, most, listed)) or seen[-1])
    got = {r.period: r.extra_rows for r in archive.duplicate_keys_in_files(spark, "/root/testdata/sf0.001").collect()}
    rows = v.observations(spark, "/root/testdata/sf0.001").withColumn("period", F.year("obs_time").cast("string"))
    assert got == {r.period: r.extra_rows for r in mg.duplicate_keys(rows, ["period"]).collect()}
    sizes = [r.rows for r in seen[0].collect()]
    assert sum(sizes) == rows.count() and max(sizes) == 97
