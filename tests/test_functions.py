import datetime as dt
import random
import struct

from pyspark.sql import functions as F

from longtide.functions import geo, labels, times


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_iso_drops_the_offset(spark):
    at = dt.datetime(2020, 1, 2, 3, 4, 5)
    for text in ("2020-01-02T03:04:05Z", "2020-01-02T03:04:05-08:00", "2020-01-02T03:04:05", "2020-01-02 03:04:05+0530"):
        assert _one(spark, times.iso_naive(F.lit(text))) == at
    assert _one(spark, times.iso_naive(F.lit(""))) is None
    assert _one(spark, times.iso_naive(F.lit(None).cast("string"))) is None


def test_strict_time(spark):
    assert _one(spark, times.strict_time(F.lit("2026-09-08 01:00:00"))) == dt.datetime(2026, 9, 8, 1)
    for text in ("2026-09-08", "2026-09-08T01:00:00", "2026-13-08 01:00:00", "x"):
        assert _one(spark, times.strict_time(F.lit(text))) is None


def test_whole_days_are_of_24_hours(spark):
    a, b = (F.lit(x).cast("timestamp_ntz") for x in ("2020-01-02 01:00:00", "2020-01-01 02:00:00"))
    assert _one(spark, times.whole_days(a, b)) == 0
    assert _one(spark, times.whole_days(b, a)) == -1


def test_windows_cover_and_do_not_overlap(spark):
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in ("2018-06-01", "2026-09-11"))
    w = _one(spark, times.chunk_windows(lo, hi, 5))
    assert [x.lo.year for x in w] == [2018, 2020, 2025] and w[0].lo == dt.datetime(2018, 6, 1) and w[-1].hi == dt.datetime(2026, 9, 11)
    assert all(a.hi == b.lo for a, b in zip(w, w[1:], strict=False))
    assert len(_one(spark, times.chunk_windows(lo, hi, 0))) == 1
    assert not _one(spark, times.chunk_windows(hi, lo, 5))


def test_clip(spark):
    t = lambda x: F.lit(x).cast("timestamp_ntz")
    none = F.lit(None).cast("timestamp_ntz")
    assert _one(spark, times.clip_window(t("1990-01-01"), t("2000-01-01"), none, none)).lo == dt.datetime(1990, 1, 1)
    assert _one(spark, times.clip_window(t("1990-01-01"), t("2000-01-01"), t("1995-01-01"), t("1996-01-01"))).hi == dt.datetime(1996, 1, 1, 0, 0, 1)
    assert _one(spark, times.clip_window(t("1990-01-01"), t("2000-01-01"), t("2005-01-01"), t("2006-01-01"))) is None


def test_labels(spark):
    assert _one(spark, labels.period_label(F.lit(2024), F.lit(2024))) == "2024"
    assert _one(spark, labels.period_label(F.lit(1872), F.lit(1903))) == "1872-1903"
    assert tuple(_one(spark, labels.period_years(F.lit("1872-1903")))) == (1872, 1903)
    assert tuple(_one(spark, labels.period_years(F.lit("2024")))) == (2024, 2024)
    assert _one(spark, labels.path_period(F.lit("s3://x/period=1872-1903/a.parquet"))) == "1872-1903"
    assert _one(spark, labels.uri_id(F.lit("http://x/networks/17/"))) == 17
    assert _one(spark, labels.per_day(F.lit(None).cast("string"))) == 24 and _one(spark, labels.per_day(F.lit("daily"))) == 1
    assert _one(spark, labels.number_or_null(F.lit("-9999.00"))) == -9999 and _one(spark, labels.number_or_null(F.lit("-9999.0"))) is None


def _by_quarters(x, y, order):
    """The curve by its definition: which quarter comes when, and how that is turned."""
    if not order:
        return 0
    half = 1 << (order - 1)
    quarter = {(0, 0): 0, (0, 1): 1, (1, 1): 2, (1, 0): 3}[(x >= half, y >= half)]
    u, w = x % half, y % half
    if quarter == 0:
        u, w = w, u
    if quarter == 3:
        u, w = half - 1 - w, half - 1 - u
    return quarter * half * half + _by_quarters(u, w, order - 1)


def test_hilbert(spark):
    cells = [(x, y) for x in range(16) for y in range(16)]
    got = spark.createDataFrame(cells, "x long, y long").select("x", "y", geo.hilbert_index(F.col("x"), F.col("y"), 4).alias("d")).collect()
    assert sorted(r.d for r in got) == list(range(256)) and all(r.d == _by_quarters(r.x, r.y, 4) for r in got)
    path = sorted(got, key=lambda r: r.d)
    assert all(abs(a.x - b.x) + abs(a.y - b.y) == 1 for a, b in zip(path, path[1:], strict=False))
    rng = random.Random(3)
    cells = [(rng.randrange(1 << 16), rng.randrange(1 << 16)) for _ in range(200)]
    got = spark.createDataFrame(cells, "x long, y long").select("x", "y", geo.hilbert_index(F.col("x"), F.col("y")).alias("d")).collect()
    assert all(r.d == _by_quarters(r.x, r.y, 16) for r in got)


def test_points(spark):
    rows = [(1, -117.305, 49.4914), (2, None, 49.0), (3, -63.57, 44.65), (4, 999.0, -999.0)]
    out = spark.createDataFrame(rows, "id int, lon double, lat double").select("id", geo.wkb_point("lon", "lat").alias("g"), geo.hilbert_key(F.col("lon"), F.col("lat")).alias("k")).collect()
    found = {r.id: r for r in out}
    assert bytes(found[1].g) == b"\x01\x01\x00\x00\x00" + struct.pack("<dd", -117.305, 49.4914) and found[2].g is None and found[2].k is None
    assert found[4].k == (1 << 32) - 1
