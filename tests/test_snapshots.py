"""Snapshots with expiry: what stays on disk, and versioned sinks of the order ETL."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from storeglass.sources import lake
from storeglass.sources.versions import VersionedTable

NOON = datetime(2024, 1, 1, 12)
ROWS = "k string, v int"


def stored(spark, path):
    return sorted((r["k"], r["v"]) for r in VersionedTable(spark, path).read().collect())


def test_sweep_leaves_what_lives(spark, tmp_path):
    path = str(tmp_path / "s")
    lake.write_snapshot(spark.createDataFrame([(f"old{k}", k) for k in range(40)], ROWS), path, "k", 60, NOON, buckets=4)
    lake.write_snapshot(spark.createDataFrame([("new", 1)], ROWS), path, "k", 6000, NOON, buckets=4)
    assert lake.sweep_snapshot(spark, path, NOON + timedelta(seconds=30)) == 0 and len(stored(spark, path)) == 41
    assert lake.sweep_snapshot(spark, path, NOON + timedelta(seconds=60)) == 4
    assert stored(spark, path) == [("new", 1)]
    assert [r["v"] for r in lake.read_snapshot(spark, path, NOON + timedelta(seconds=99)).collect()] == [1]
    assert lake.sweep_snapshot(spark, path, NOON + timedelta(seconds=99)) == 0
    assert lake.sweep_snapshot(spark, str(tmp_path / "none"), NOON) == 0


def test_size_is_bounded_after_many_writes(spark, tmp_path):
    """Keys that are never written again don't pile up, nor do files of versions long gone."""
    path, sizes = str(tmp_path / "s"), []
    for k in range(6):
        now = NOON + timedelta(minutes=10 * k)
        lake.write_snapshot(spark.range(50).select(F.concat(F.lit(f"{k}-"), F.col("id")).alias("k"), F.col("id").cast("int").alias("v")),
                            path, "k", 900, now, buckets=2)
        lake.sweep_snapshot(spark, path, now, keep=1)
        sizes.append((len(stored(spark, path)), sum(1 for f in (tmp_path / "s").rglob("*.parquet"))))
    assert {n for n, _ in sizes[1:]} == {100} and max(files for _, files in sizes) <= 4


def test_a_write_drops_expired_entries_of_its_buckets(spark, tmp_path):
    path = str(tmp_path / "s")
    lake.write_snapshot(spark.createDataFrame([("a", 1)], ROWS), path, "k", 60, NOON, buckets=1)
    lake.write_snapshot(spark.createDataFrame([("b", 2)], ROWS), path, "k", 60, NOON + timedelta(minutes=5), buckets=1)
    assert stored(spark, path) == [("b", 2)]


def test_reader_of_a_snapshot_keeps_its_version(spark, tmp_path):
    path = str(tmp_path / "s")
    lake.write_snapshot(spark.createDataFrame([("a", 1)], ROWS), path, "k", 600, NOON, buckets=1)
    reader = lake.read_snapshot(spark, path, NOON)
    lake.write_snapshot(spark.createDataFrame([("a", 2)], ROWS), path, "k", 600, NOON, buckets=1)
    assert [r["v"] for r in reader.collect()] == [1]
    assert [r["v"] for r in lake.read_snapshot(spark, path, NOON).collect()] == [2]
