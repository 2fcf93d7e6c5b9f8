"""Versioned tables: what readers see before, during and after writes that fail."""

from __future__ import annotations

import pytest

from storeglass.sources.versions import CommitConflict, VersionedTable

ROWS = "key int, day string, value string, at int"


@pytest.fixture
def table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.upsert(spark.createDataFrame([(1, "a", "old", 1), (2, "a", "old", 1), (3, "b/ä", "old", 1), (4, None, "old", 1)], ROWS),
                 ["key"], "at", ["day"])
    return table


def rows(df):
    return sorted((tuple(r) for r in df.select("key", "day", "value").collect()), key=repr)


def test_upsert_keeps_latest_and_leaves_other_partitions(spark, table):
    before = table.manifest()
    table.upsert(spark.createDataFrame([(1, "a", "new", 2), (2, "a", "late", 0), (5, "a", "new", 1), (4, None, "same", 1)], ROWS),
                 ["key"], "at", ["day"])
    assert rows(table.read()) == sorted([(1, "a", "new"), (2, "a", "old"), (5, "a", "new"), (3, "b/ä", "old"), (4, None, "same")], key=repr)
    after = table.manifest()
    moved = {k for k in after["entries"] if after["entries"][k] != before["entries"].get(k)}
    assert len(moved) == 2 and len(after["entries"]) == 3
    assert rows(table.read(1)) == sorted([(1, "a", "old"), (2, "a", "old"), (3, "b/ä", "old"), (4, None, "old")], key=repr)


def test_repeated_upsert_changes_nothing(spark, table):
    again = spark.createDataFrame([(1, "a", "old", 1)], ROWS)
    before = rows(table.read())
    table.upsert(again, ["key"], "at", ["day"])
    assert rows(table.read()) == before
    assert table.upsert(again.limit(0), ["key"], "at", ["day"]) is None and table.versions() == [1, 2]


def test_reader_during_and_after_an_aborted_write(spark, table, monkeypatch):
    """The writer dies between its files and its commit: readers keep the version before, the next write succeeds."""
    open_reader, before = table.read(), rows(table.read())
    change = spark.createDataFrame([(1, "a", "new", 2), (9, "c", "new", 2)], ROWS)

    def dies(manifest):
        assert rows(table.read()) == before  # all files of the new version are there by now
        raise OSError("killed")

    monkeypatch.setattr(table, "_commit", dies)
    with pytest.raises(OSError):
        table.upsert(change, ["key"], "at", ["day"])
    monkeypatch.undo()
    assert rows(open_reader) == rows(table.read()) == before and table.versions() == [1]
    table.upsert(change, ["key"], "at", ["day"])
    assert (1, "a", "new") in rows(table.read()) and rows(open_reader) == before
    folders = len(table._names("data"))
    table.vacuum(keep=1)
    assert len(table._names("data")) == 2 < folders and (9, "c", "new") in rows(table.read())


def test_a_task_that_fails_leaves_the_table(spark, table):
    from pyspark.sql import functions as F

    before = rows(table.read())
    broken = spark.createDataFrame([(1, "a", "new", 2)], ROWS).withColumn("value", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        table.upsert(broken, ["key"], "at", ["day"])
    assert rows(table.read()) == before


def test_second_writer_is_refused(spark, table, monkeypatch):
    other = VersionedTable(spark, table.path)
    stale = other.versions()
    table.upsert(spark.createDataFrame([(1, "a", "first", 2)], ROWS), ["key"], "at", ["day"])
    monkeypatch.setattr(other, "versions", lambda: stale)
    with pytest.raises(CommitConflict):
        other.upsert(spark.createDataFrame([(1, "a", "second", 3)], ROWS), ["key"], "at", ["day"])
    assert (1, "a", "first") in rows(table.read())


def test_where_reads_named_partitions_only(spark, table):
    chosen = table.read(where={"day": ["b/ä", None]})
    assert rows(chosen) == sorted([(3, "b/ä", "old"), (4, None, "old")], key=repr)
    assert len(chosen.inputFiles()) <= 2
    assert rows(table.read(where={"day": ["none such"]})) == []


def test_replace(spark, table):
    table.replace(spark.createDataFrame([(7, "z", "only", 1)], ROWS))
    assert rows(table.read()) == [(7, "z", "only")]
    table.replace(spark.createDataFrame([], ROWS), ["day"])
    assert rows(table.read()) == []


def test_absent_table(spark, tmp_path):
    assert VersionedTable(spark, str(tmp_path / "none")).read() is None
