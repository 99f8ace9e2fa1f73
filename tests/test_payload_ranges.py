"""What ranges of payload files cost: bytes that are read, and tasks that read them."""

import io

from pyspark.sql import functions as F

from longtide.sources import payloads

LINES = [f"2020-01-{1 + k % 28:02d} 00:00:{k % 60:02d}, {k}" for k in range(100_000)]
TEXT = "\n".join(["station_observations", "time, a", *LINES])


class Counted(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        got = super().read(n)
        self.taken += len(got)
        return got


def test_a_range_reads_little_more_than_itself():
    f = Counted(TEXT.encode())
    status, _, header, body = payloads._head(f, len(TEXT))
    assert (status, header) == ("ok", ["time", "a"]) and f.taken <= 2 * payloads.LINE_BYTES
    f.taken = 0
    found = [x for block in payloads._lines(f, 1_000_000, True, 1_001_000) for x in block]
    assert found and all(TEXT[at : at + len(x)] == x and 1_000_000 <= at < 1_001_000 for at, x in found)
    assert f.taken <= 3 * payloads.LINE_BYTES


def test_ranges_together_give_every_line_once():
    f, body = io.BytesIO(TEXT.encode()), TEXT.index(LINES[0])
    found = [x for start in range(0, len(TEXT), 70_000) for block in payloads._lines(f, max(start, body), start > body, min(start + 70_000, len(TEXT))) for _, x in block]
    assert found == LINES


def test_lines_longer_than_what_is_read_at_first():
    long = "2020-01-01 00:00:00, " + "1" * 50_000
    text = f"station_observations\ntime, {'a' * 9_000}\n{long}\n{long}"
    f = Counted(text.encode())
    status, _, header, body = payloads._head(f, len(text))
    assert status == "ok" and len(header[1]) == 9_000
    assert [x for block in payloads._lines(f, body, False, body + 10) for _, x in block] == [long]


def test_many_small_files_are_read_by_many_tasks(spark, tmp_path):
    landed = spark.range(300).select(F.lit("u").alias("network_name"), F.col("id").cast("string").alias("native_id"), F.concat(F.lit("station_observations\ntime, a\n2020-01-01 00:00:00, "), F.col("id").cast("string")).alias("content"))
    payloads.land(landed, str(tmp_path / "in"))
    payloads.land(landed, str(tmp_path / "in"))  # again, as a task that is run twice
    found = payloads.read_payload_lines(spark, str(tmp_path / "in"), "*.txt", range_bytes=30)
    assert found.where("line is not null").select(F.spark_partition_id()).distinct().count() > 4
    cells = payloads.cells_of_lines(found)[0].collect()
    assert sorted((c.network_name, int(c.native_id), c.value) for c in cells) == [("u", k, float(k)) for k in range(300)]
    assert len(list((tmp_path / "in" / "u").iterdir())) == 300


def test_nothing_landed(spark, tmp_path):
    payloads.land(spark.createDataFrame([], "network_name string, native_id string, content string"), str(tmp_path / "in"))
    assert payloads.read_payload_lines(spark, str(tmp_path / "in"), "*.txt").count() == 0
