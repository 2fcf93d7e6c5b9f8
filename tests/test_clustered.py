"""Layouts by key ranges: same rows as full scans, from few files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from storeglass.plans import orders
from storeglass.sources.clustered import ClusteredTable
from tests.test_search_index import files_read

FILES = 12


@pytest.fixture(scope="module")
def by_id(spark, star, tmp_path_factory):
    table = ClusteredTable(spark, str(tmp_path_factory.mktemp("by_id")), ["order_id"])
    table.write(star.orders.limit(5), 2)  # replaced by the next
    table.write(star.orders, FILES)
    return table


@pytest.fixture(scope="module")
def by_status(spark, star, tmp_path_factory):
    table = ClusteredTable(spark, str(tmp_path_factory.mktemp("by_status")), ["status", "order_date", "order_id"])
    table.write(star.orders, FILES)
    return table


def same(a, b):
    rows = lambda df: [tuple(r) for r in df.select(*orders.PAGE_COLUMNS).collect()]
    assert rows(a) == rows(b)
    return len(rows(b))


@pytest.mark.parametrize("limit", [1, 20, 300, 10_000])
def test_pages_after_a_key(by_id, star, limit):
    ids = [r[0] for r in star.orders.select("order_id").orderBy("order_id").collect()]
    for last in (-1, ids[0], ids[len(ids) // 2], ids[-2], ids[-1]):
        assert same(by_id.after(last, limit), orders.orders_page_after(star, last, limit)) == min(limit, sum(i > last for i in ids))


def test_a_page_reads_its_files(by_id, star):
    middle = star.orders.select("order_id").orderBy("order_id").offset(700).first()[0]
    assert files_read(by_id.after(middle, 20)) <= 2
    assert files_read(by_id.at(700)) == 1


def test_key_at_position(by_id, star):
    ids = [r[0] for r in star.orders.select("order_id").orderBy("order_id").collect()]
    for position in (1, 2, 399, len(ids)):
        assert [r["order_id"] for r in by_id.at(position).collect()] == [ids[position - 1]]
    assert by_id.at(0).collect() == [] == by_id.at(len(ids) + 1).collect()


@pytest.mark.parametrize("statuses,start,stop", [
    (["shipped"], "1997-01-01", "1997-02-01"), (["pending", "shipped"], None, "1993-01-01"), (["delivered"], "1998-01-01", None),
    (["processing", "cancelled"], None, None), (["none such"], "1997-01-01", None)])
def test_status_and_period(by_status, star, statuses, start, stop):
    from storeglass.functions.exprs import span

    want = star.orders.filter(F.col("status").isin(*statuses))
    want = want.filter(span("order_date", start, stop)) if start or stop else want
    same(by_status.between(statuses, start, stop).orderBy("order_id"), want.orderBy("order_id"))


def test_a_period_reads_its_files(by_status):
    assert 0 < files_read(by_status.between(["shipped"], "1997-01-01", "1997-02-01")) <= 2
    assert files_read(by_status.between(["shipped", "delivered"])) < FILES


def test_many_equal_keys_spread_over_files(spark, tmp_path):
    rows = spark.range(4000).select(F.lit("x").alias("status"), F.lit("1997-01-01").cast("timestamp_ntz").alias("order_date"), F.col("id").alias("order_id"))
    table = ClusteredTable(spark, str(tmp_path / "t"), ["status", "order_date", "order_id"])
    table.write(rows, 8)
    ranges, _ = table._ranges()
    assert ranges.agg(F.max("rows")).first()[0] < 1500 and table.between(["x"], "1997-01-01", "1997-01-02").count() == 4000
