"""Payload files read in ranges of bytes, against the same files read whole."""

import pytest

from longtide.sources import payloads

BODY = "time , a, b\r\n2020-01-01 00:00:00, 1, None\n\n 2020-01-01 01:00:00,2.5,-9999\nnever, 1, 2\n2020-01-01 02:00:00, 3\n2020-01-01 03:00:00, x, 4é\n2020-01-01 04:00:00, 7, 8"
FILES = {
    "EC/one": f"station_observations\n{BODY}", "EC/two": f"\n  station_observations \r\n{BODY}\n\n", "EC/none": "", "EC/head": "station_observations\ntime, a\n\n", "EC/short": "station_observations",
    "FL/error": "Error {code}\nmore", "FL/untimed": "station_observations\na, b\n1, 2\n", "FL/long": "station_observations\ntime, a\n" + "".join(f"2020-01-{1 + k % 28:02d} 00:00:{k % 60:02d}, {k}\n" for k in range(500)),
}


@pytest.fixture
def landed(tmp_path):
    for name, text in FILES.items():
        f = tmp_path / f"{name}.csv"
        f.parent.mkdir(exist_ok=True)
        f.write_bytes(text.encode())
    return str(tmp_path)


@pytest.mark.parametrize("size", [3, 50, 1 << 20])
def test_ranges_cut_lines_anywhere(spark, landed, size):
    whole = payloads.triage(payloads.read_payloads(spark, landed))
    found = payloads.read_payload_lines(spark, landed, range_bytes=size)
    status = {(r.network_name, r.native_id): (r.status, r.error) for r in whole.collect()}
    got = {(r.network_name, r.native_id): (r.status, r.error) for r in found.where("line is null").collect()}
    # whether a file of several ranges has no rows at all is not known to its first one
    assert {k: v for k, v in got.items() if k != ("EC", "head")} == {k: v for k, v in status.items() if k != ("EC", "head")}
    assert size < 100 or got == status
    cells = [sorted(map(str, payloads.long_cells(whole)[0].collect())), sorted(map(str, payloads.cells_of_lines(found)[0].collect()))]
    assert cells[0] == cells[1] and len(cells[0]) > 500
    rejects = [sorted((r.path.split("/")[-1], r.reason) for r in x[1].collect()) for x in (payloads.long_cells(whole), payloads.cells_of_lines(found))]
    assert rejects[0] == rejects[1] and len(rejects[0]) == 8


def test_no_files(spark, tmp_path):
    assert payloads.read_payload_lines(spark, str(tmp_path)).count() == 0
