"""stream_late against its SQL where a station has thousands of rows in a batch."""

import duckdb

from longtide.plans import archive, catalogue


def test_stations_of_many_rows(spark, tmp_path):
    duck, file = duckdb.connect(), tmp_path / "lineitem.parquet"
    duck.execute(f"COPY (SELECT * REPLACE (l_orderkey + i * 150001 AS l_orderkey) FROM '/root/testdata/sf0.001/lineitem.parquet', range(60) t(i)) TO '{file}'")
    duck.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{file}'")
    assert archive
    out = str(tmp_path / "got")
    catalogue.QUERIES["stream_late"](spark, str(tmp_path)).write.parquet(out)
    duck.execute(f"CREATE TABLE got AS SELECT station_id, variable_id, obs_time, value, ingested_at, kind FROM '{out}/*.parquet'")
    for _ in range(5):  # a window over ranges of k gave other rows from run to run
        duck.execute(f"CREATE OR REPLACE TABLE want AS {catalogue.ORACLE_SQL['stream_late']}")
        for a, b in (("want", "got"), ("got", "want")):
            assert duck.execute(f"SELECT count(*) FROM (SELECT * FROM {a} EXCEPT ALL SELECT * FROM {b})").fetchall() == [(0,)]
