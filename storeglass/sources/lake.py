"""Incremental extract, keyed upsert into a partitioned lake, snapshots with expiry.

One writer per path is assumed. Every write is idempotent: running it again with the same rows changes nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from storeglass.functions.exprs import at
from storeglass.sources.versions import VersionedTable, keep_last


def extract_since(df: DataFrame, hwm=None, at_mark: bool = False) -> DataFrame:
    """Rows created or changed after the mark; everything without one. No cap: what is not read now is never read.

    `at_mark` reads rows with the very time of the mark as well, since more of them may have arrived after it was taken.
    """
    if hwm is None:
        return df
    mark = at(hwm)
    if at_mark:
        return df.filter((F.col("created_at") >= mark) | (F.col("updated_at") >= mark))
    return df.filter((F.col("created_at") > mark) | (F.col("updated_at") > mark))


def next_mark(df: DataFrame):
    """Mark for the next extract: the latest time in what was read, not the clock (one value comes back)."""
    return df.agg(F.max(F.greatest("created_at", "updated_at")).alias("mark")).first()["mark"]


def write_mark(spark: SparkSession, path: str, mark) -> None:
    spark.range(1).select(F.lit(mark.isoformat(sep=" ")).alias("mark")).coalesce(1).write.mode("overwrite").parquet(path)


def read_mark(spark: SparkSession, path: str):
    existing = read_if_exists(spark, path)
    row = None if existing is None else existing.first()
    return None if row is None else row["mark"]


def read_if_exists(spark: SparkSession, path: str, format: str = "parquet", schema=None) -> DataFrame | None:
    try:
        reader = spark.read.format(format)
        return (reader.schema(schema) if schema is not None else reader).load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def upsert_partitioned(
    df: DataFrame, path: str, keys: list[str], order_col: str, partitions: list[str], format: str = "parquet",
    unique: bool = False,
) -> None:
    """Merge rows into a partitioned table: per key the row with the highest `order_col` stays, a new one on equality.

    A key lives in one partition. Only partitions that get rows are read and rewritten (dynamic overwrite, which puts
    files aside and exchanges folders when all tasks have ended, so that nothing is overwritten while it is still read).
    The touched partitions, one row per folder that is about to be written, come to the driver: the values of each
    partition column prune the scan (a flat IN, whatever their number), the broadcast of the rows leaves exactly those
    partitions. `unique` rows, one per key, are written as they are where those partitions hold none yet. JSON is text
    of many times the size of its parquet, and is compressed as that is.
    """
    spark = df.sparkSession
    existing = read_if_exists(spark, path, format, df.schema)
    marked = df.withColumn("_new", F.lit(1))
    if existing is not None:
        touched = df.select(*partitions).distinct().collect()
        if not touched:
            return
        same = F.lit(True)
        for name in partitions:
            values = {row[name] for row in touched}
            hit = F.col(name).isin(*sorted(values - {None}))
            existing = existing.filter(hit | F.col(name).isNull() if None in values else hit)
            same = same & F.col(name).eqNullSafe(F.col(f"_touched_{name}"))
        schema = StructType([StructField(f"_touched_{f.name}", f.dataType) for f in df.select(*partitions).schema])
        existing = existing.join(F.broadcast(spark.createDataFrame(touched, schema)), same, "left_semi")
        if not unique or not existing.isEmpty():
            marked, unique = existing.select(*df.columns).withColumn("_new", F.lit(0)).unionByName(marked), False
    merged = df if unique else keep_last(marked, keys, [F.col(order_col), F.col("_new")]).drop("_new")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).option(
        "compression", "snappy" if format == "parquet" else "gzip").format(format).save(path)


def upsert_by_day(summary: DataFrame, path: str) -> None:
    """Daily summary rows replace those of their day."""
    upsert_partitioned(summary.withColumn("_at", F.lit(0)), path, ["summary_date"], "_at", ["summary_date"])


def write_snapshot(df: DataFrame, path: str, key: str, ttl_seconds: int, as_of, buckets: int = 64) -> None:
    """Latest payload per key with an expiry, in a versioned table. Keys are hashed to buckets; only buckets with new keys
    are rewritten, and their expired entries go on the occasion."""
    stamped = df.withColumn("updated_at", at(as_of)).withColumn(
        "expires_at", F.col("updated_at") + F.make_dt_interval(secs=F.lit(ttl_seconds)))
    bucketed = stamped.withColumn("bucket", F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int"))
    VersionedTable(df.sparkSession, path).upsert(
        bucketed, [key], "updated_at", ["bucket"], keep=F.col("expires_at") > at(as_of))


def read_snapshot(spark: SparkSession, path: str, as_of) -> DataFrame:
    """Entries that have not expired."""
    table = VersionedTable(spark, path).read()
    if table is None:
        raise ValueError(f"no snapshot at {path}")
    return table.filter(F.col("expires_at") > at(as_of)).drop("bucket")


def sweep_snapshot(spark: SparkSession, path: str, as_of, keep: int = 2) -> int:
    """Rewrites the buckets that hold expired entries without them, as one file each, and removes the files of versions
    before the last `keep`. Returns how many buckets were rewritten; buckets without expired entries are not touched."""
    table = VersionedTable(spark, path)
    rows = table.read()
    if rows is None:
        return 0
    expired = F.col("expires_at") <= at(as_of)
    stale = [row["bucket"] for row in rows.filter(expired).select("bucket").distinct().collect()]  # buckets at most
    if stale:
        left = table.read(where={"bucket": stale}).filter(~expired)
        table.replace_partitions(left.repartition("bucket"), ["bucket"], 1, [(bucket,) for bucket in stale])
    table.vacuum(keep)
    return len(stale)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Table laid out by a join key: orders and lines bucketed by order_id meet in every job without a shuffle."""
    df.repartition(buckets, F.col(key)).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(
        key).saveAsTable(table)
