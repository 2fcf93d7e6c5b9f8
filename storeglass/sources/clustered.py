"""Files laid out by key ranges, with a small table of what each file holds: lookups that open a handful of files.

Rows are range-partitioned and sorted by the keys, so every file holds one range of them, and within a file the row
groups' statistics cut further. `ranges` has a row per file: lowest and highest key, number of rows. A page after a
key, the key at a position, or the rows of a status and period are found in that table first; then only the files that
can hold them are read. The last key should be unique, so that many equal leading keys spread over files.

Rows and ranges are versioned tables under one head that is committed last: a reader's ranges fit its files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from storeglass.functions.exprs import span
from storeglass.sources.versions import VersionedTable


class ClusteredTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.keys = spark, keys
        self.rows, self.ranges, self.head = (VersionedTable(spark, f"{path}/{name}") for name in ("rows", "ranges", "head"))

    def write(self, df: DataFrame, files: int) -> None:
        """Replaces the table by these rows in about so many files."""
        version = self.rows.replace(df.repartitionByRange(files, *self.keys).sortWithinPartitions(*self.keys))
        ranges = self.ranges.replace(self.rows.file_ranges(self.keys, version).coalesce(1))
        self.head.replace(self.spark.createDataFrame([(version, ranges)], "rows long, ranges long").coalesce(1))

    def _ranges(self) -> tuple[DataFrame, dict]:
        head = self.head.read().first()
        return self.ranges.read(head["ranges"]), self.rows.manifest(head["rows"])

    def _files(self, manifest: dict, files: list[str]) -> DataFrame:
        schema = self.rows._frame(manifest, []).schema
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def after(self, last, limit: int) -> DataFrame:
        """The first `limit` rows with a first key beyond `last`. Every file but the first gives a row at least, so that
        limit + 1 rows of the table of ranges are looked at, and as many files are read as the page needs."""
        ranges, manifest = self._ranges()
        key = self.keys[0]
        near = ranges.filter(F.col("high")[key] > F.lit(last)).orderBy("low").limit(limit + 1).select(
            "file", "rows", (F.col("low")[key] > F.lit(last)).alias("whole")).collect()
        files, sure = [], 0
        for row in near:
            if sure >= limit:
                break
            files.append(row["file"])
            sure += row["rows"] if row["whole"] else 0
        return self._files(manifest, files).filter(F.col(key) > F.lit(last)).orderBy(*self.keys).limit(limit)

    def at(self, position: int) -> DataFrame:
        """The row at a position (from 1) in the order of the keys, or none. One file is read."""
        ranges, manifest = self._ranges()
        before = F.sum("rows").over(Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1))  # a row per file
        placed = ranges.select("file", "rows", F.coalesce(before, F.lit(0)).alias("before"))
        found = placed.filter((F.col("before") < position) & (F.col("before") + F.col("rows") >= position)).collect()
        rows = self._files(manifest, [row["file"] for row in found]).orderBy(*self.keys)
        return rows.offset(position - found[0]["before"] - 1).limit(1) if found else rows

    def between(self, first: list, start=None, stop=None) -> DataFrame:
        """Rows whose first key is one of `first` and whose second lies in start <= key < stop."""
        ranges, manifest = self._ranges()
        one, two = self.keys[:2]

        def holds(value) -> Column:
            low, high, value = F.col("low"), F.col("high"), F.lit(value)
            hit = (low[one] <= value) & (high[one] >= value)
            # The second key is in order only inside one value of the first.
            if start is not None:
                hit = hit & ((high[one] > value) | span(high[two], start))
            if stop is not None:
                hit = hit & ((low[one] < value) | span(low[two], None, stop))
            return hit

        wanted = F.lit(False)
        for value in first:
            wanted = wanted | holds(value)
        files = [row["file"] for row in ranges.filter(wanted).select("file").collect()]  # those that the result is in
        chosen = F.col(one).isin(*first)
        return self._files(manifest, files).filter(chosen & span(two, start, stop) if start is not None or stop is not None else chosen)
