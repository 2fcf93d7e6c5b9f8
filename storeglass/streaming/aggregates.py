"""Streaming aggregations; each has a batch twin in plans.behavior or plans.recommend."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from storeglass.functions.exprs import POPULARITY_WEIGHTS, RATING_WEIGHTS, count_if, weight_of
from storeglass.plans.behavior import counter_columns


def once(stream: DataFrame, delay: str = "10 minutes", ts: str = "timestamp") -> DataFrame:
    """Drops re-delivered events; ids are forgotten with the watermark."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["event_id"])


def windowed_counts(
    stream: DataFrame, window: str = "10 minutes", slide: str = "5 minutes", delay: str | None = "10 minutes",
    ts: str = "timestamp",
) -> DataFrame:
    """Events per sliding window, user, product and type. For a batch frame leave out `delay`."""
    timed = stream if delay is None else stream.withWatermark(ts, delay)
    return timed.groupBy(F.window(ts, window, slide).alias("window"), "user_id", "product_id", "event_type").agg(
        F.count("*").alias("count")).select("window.start", "window.end", "user_id", "product_id", "event_type", "count")


def counters_stream(stream: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Running counters per user; state grows with the users, so keep it in RocksDB."""
    return stream.groupBy("user_id").agg(*counter_columns(ts))


def popularity_stream(stream: DataFrame) -> DataFrame:
    """Running weighted popularity per product."""
    return stream.filter(F.col("event_type").isin(*POPULARITY_WEIGHTS)).groupBy("product_id").agg(
        F.sum(weight_of("event_type", POPULARITY_WEIGHTS, 0.0)).alias("popularity_score"))


def interactions_stream(stream: DataFrame) -> DataFrame:
    """Running weight per user and product."""
    return stream.groupBy("user_id", "product_id").agg(
        F.sum(weight_of("event_type", RATING_WEIGHTS, 1.0)).alias("weight"), F.count("*").alias("n"))


def trending_stream(stream: DataFrame, delay: str = "10 minutes", ts: str = "timestamp") -> DataFrame:
    """Trending figures per day; distinct users are approximate, as exact ones are not kept on streams."""
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 day").alias("day"), "product_id").agg(
        F.count("*").alias("total_interactions"), F.approx_count_distinct("user_id").alias("unique_users"),
        count_if(F.col("event_type") == "purchase").alias("purchases"))
