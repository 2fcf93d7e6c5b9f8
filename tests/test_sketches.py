"""Stored daily sketches against exact counts and ranks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from storeglass.plans import sketches
from storeglass.sources.retail import StarTables
from storeglass.sources.versions import VersionedTable

ROOT = "/root/testdata/sf0.01"
YEAR = ("1996-01-01", "1997-01-01")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    t, table = StarTables(spark, ROOT), VersionedTable(spark, str(tmp_path_factory.mktemp("sketches")))
    sketches.load_days(t, table, None, "1997-01-01")
    sketches.load_days(t, table, "1996-06-01")  # half a year again, and the rest
    return t, table


@pytest.mark.parametrize("start,stop,by_month", [(*YEAR, False), (None, None, False), (*YEAR, True), ("1995-03-07", "1995-03-08", False)])
def test_distinct_counts_within_the_error(stored, start, stop, by_month):
    t, table = stored
    keys = ["month", "category_id"] if by_month else ["category_id"]
    found = {tuple(r[k] for k in keys): r for r in sketches.category_totals(table, start, stop, by_month).collect()}
    exact = sketches.exact_totals(t, start, stop, by_month).collect()
    assert len(exact) == len(found) > 0
    for r in exact:
        near = found[tuple(r[k] for k in keys)]
        assert near["lines"] == r["n_lines"]
        for name in sketches.DISTINCT:
            assert abs(near[name] - r[f"n_{name}"]) <= 0.03 * r[f"n_{name}"] + 1


def test_quartiles_within_the_rank_error(stored):
    t, table = stored
    totals = sketches.category_totals(table, *YEAR)
    for r in sketches.rank_errors(t, totals, *YEAR).collect():
        assert max(r["error_p25"], r["error_p50"], r["error_p75"]) < 0.03


def test_no_line_is_read(stored):
    t, table = stored
    plan = sketches.category_totals(table, *YEAR)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "orders.parquet" not in plan and table.path.split("/")[-1] in plan


def test_days_are_replaced(spark, tmp_path, stored):
    t, _ = stored
    table, day = VersionedTable(spark, str(tmp_path / "s")), ("1996-05-01", "1996-05-11")
    sketches.load_days(t, table, *day)
    before = {tuple(r) for r in table.read().select("day", "category_id", "lines").collect()}
    sketches.load_days(t, table, *day)
    assert {tuple(r) for r in table.read().select("day", "category_id", "lines").collect()} == before
    gone = StarTables(spark, ROOT)
    gone.__dict__["orders"] = t.orders.filter(F.to_date("order_date") != F.lit("1996-05-03").cast("date"))
    sketches.load_days(gone, table, "1996-05-03", "1996-05-04")
    after = {tuple(r) for r in table.read().select("day", "category_id", "lines").collect()}
    assert after == {r for r in before if str(r[0]) != "1996-05-03"} != before
