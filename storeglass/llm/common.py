"""What several operators share: stored intermediate tables, typed inputs, word patterns."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from storeglass.operators.materialize import shared_folder

#: The white space of the word contract, as a Java pattern: words are maximal runs of anything else.
SPACES = "[\\x20\\x09-\\x0D]+"
#: A table of at most so many rows of a few numbers may be broadcast; its count is taken first.
BROADCAST_ROWS = 200_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table into the shared folder (spark.checkpoint.dir) and reads it back: lineage ends there, so a lost
    executor costs no recomputation of what lies before. The file system deletes it when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text only, whatever else the table carries."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def small_or_not(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table with a broadcast hint if it has at most `rows` rows, else as it is (a shuffled join follows)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def tidy(run: Callable) -> Callable:
    """A mapInArrow function that gives Arrow's unused memory back at its end, as workers live on after a task."""

    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return wrapped
