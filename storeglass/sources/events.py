"""Event stream source and JSON decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from storeglass.sources.schemas import EVENT, LOG_LINE

CORRUPT = "_corrupt"


def read_events(spark: SparkSession, source: str, options: dict[str, str], schema: T.StructType = EVENT) -> DataFrame:
    """Streaming events, decoded. `source` is kafka (where its connector is installed), text (JSON lines) or parquet."""
    if source == "kafka":
        raw = spark.readStream.format("kafka").options(**{"startingOffsets": "latest", **options}).load()
        return decode_json(raw.select(F.col("value").cast("string").alias("value")), schema)[0]
    if source == "text":
        return decode_json(spark.readStream.format("text").options(**options).load(), schema)[0]
    if source == "parquet":
        return spark.readStream.schema(schema).format("parquet").options(**options).load()
    raise ValueError(f"unknown source {source!r}")


def decode_json(raw: DataFrame, schema: T.StructType = EVENT, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(decoded rows, malformed texts). Malformed input is kept aside instead of turning into rows of nulls."""
    wide = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    decoded = raw.select(F.from_json(F.col(value), wide, options).alias("data"), F.col(value).alias("_raw"))
    broken = F.col("data").isNull() | F.col(f"data.{CORRUPT}").isNotNull()
    good = decoded.filter(~broken).select("data.*").drop(CORRUPT)
    return good, decoded.filter(broken).select(F.col("_raw").alias("value"))


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Streaming SQL-log events (JSON lines) of a directory."""
    return decode_json(spark.readStream.format("text").load(path), LOG_LINE)[0]


def with_topics(events: DataFrame, prefix: str = "user-events-") -> DataFrame:
    """Rows for a Kafka sink: every event once for the topic of its type and once for the common one, keyed by user."""
    topics = F.array(F.concat(F.lit(prefix), F.col("event_type")), F.lit(f"{prefix}all"))
    return events.select(F.explode(topics).alias("topic"), F.col("user_id").cast("string").alias("key"),
                         F.to_json(F.struct(*events.columns)).alias("value"))
