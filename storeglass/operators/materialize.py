"""Cutting the lineage at a place that survives the loss of executors."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which all machines see. Only a local session may name none and gets a
    temporary one, deleted at its end; a cluster's executors would each write to their own disk there."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="storeglass-")
        path = spark._jvm.org.apache.hadoop.fs.Path(f"file://{os.path.abspath(folder)}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later reads see the same rows in the same partitions, whatever is lost meanwhile."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def stored(df: DataFrame) -> Iterator[DataFrame]:
    """The rows in compressed columns in the shared folder, for the length of a block: for rows that are large and read
    more than once. Their files go when the block ends, however it ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
