"""Falling keys along files."""

from longtide.plans import archive

SF = "/root/testdata/sf0.001"


def test_rows_are_not_sorted_to_be_held_against_each_other(spark):
    found = archive.order_in_files(spark, SF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "row_index" in plan and "lag(" not in plan.split("MapInArrow")[-1]
    assert {r.violations for r in found.collect()} == {0}
