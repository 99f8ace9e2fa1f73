"""Work a row and a file that does not grow with the number of files."""

import datetime as dt
import random

from pyspark.sql import functions as F

from longtide import schema
from longtide.operators import compaction as cp
from longtide.operators import merge as mg
from longtide.sources import sinks, versions

T = dt.datetime
KEY = "struct<station_id: int, variable_id: smallint, obs_time: timestamp_ntz>"


def _key(r):
    """Null first, as structs are ordered."""
    return tuple((x is not None, x) for x in r)


def test_cuts_by_buckets_of_stations(spark):
    dice = random.Random(7)
    some = lambda: (dice.choice([None, -5, 3, 3, dice.randrange(-10, 4000)]), dice.choice([None, 1, 2]), T(2020, 1, 1) + dt.timedelta(hours=dice.randrange(50)))
    cuts = {"a": [some() for _ in range(300)], "b": [(3, 1, T(2020, 1, 1, h)) for h in range(20)], "c": [], "d": [(None, 1, T(2020, 1, 1))]}
    cuts = {p: sorted(set(c), key=_key) for p, c in cuts.items()}
    rows = [(*some(), float(k), dice.choice([*"abcde", None])) for k in range(2000)]
    given = spark.createDataFrame(rows, schema.observations())
    got = sinks.with_cuts_up_to(given, cuts, KEY, F.struct(*schema.KEYS), "n")
    assert got.columns == [*given.columns, "n"]
    want = sorted((r[3], sum(_key(c) <= _key(r[:3]) for c in cuts.get(r[4], []))) for r in rows)
    assert sorted((r.value, r.n) for r in got.collect()) == want
    # of 1,000 files no row meets more than a few bounds
    wide = [(s, 1, T(2020, 1, 1)) for s in range(0, 100_000, 100)]
    assert max(len(own) for _, _, own in sinks._buckets(wide)[3]) == 1


def test_rows_of_one_stamp_are_merged_by_hash(spark, capsys):
    ddl = "station_id int, variable_id smallint, obs_time timestamp_ntz, value double"
    t = T(2020, 1, 1)
    got = mg.merged(spark.createDataFrame([(1, 1, t, 2.0), (1, 1, t, None), (1, 1, t, 5.0), (2, 1, t, None)], ddl), None)
    assert sorted(map(tuple, got.collect())) == [(1, 1, t, 5.0), (2, 1, t, None)]
    got.explain()
    plan = capsys.readouterr().out
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_a_folder_is_listed_once_by_vacuum(spark, tmp_path, monkeypatch):
    root, small = str(tmp_path), {"target": 1 << 9, "floor": 1 << 8, "ceiling": 1 << 20, "bytes_per_row": 16.0}
    layout = spark.createDataFrame([("2000", 2000, 2000)], schema.LAYOUT)
    rows = [(s, 1, T(2000, 1, 1, h), 1.0, "2000") for s in range(8) for h in range(20)]
    sinks.write_observations(spark.createDataFrame(rows, schema.observations()), f"{root}/observations", **small)
    sinks.write_layout(layout, f"{root}/layout.json")
    looked, own = [], versions.children
    monkeypatch.setattr(versions, "children", lambda s, folder: looked.append(folder) or own(s, folder))
    cp.compact_archive(spark, root, layout, ["2000"], include_deltas=False, **small)
    # several files were replaced and are gone; their folder was looked into once
    assert versions.data_files(spark, root).count() == versions.listed(spark, root).count() > 3
    assert looked.count(f"{root}/observations/period=2000") == 1
