"""The two dimension files of the catalogue, read back together."""

from longtide.plans import archive
from longtide.plans import views as v

SF = "/root/testdata/sf0.001"


def test_every_station_has_every_variable(spark):
    got = archive.dimension_files(spark, SF)
    assert got.columns == ["station_id", "network_name", "native_id", "variable_id", "name", "standard_name"]
    assert got.count() == v.stations(spark, SF).count() * v.variables(spark, SF).count()
