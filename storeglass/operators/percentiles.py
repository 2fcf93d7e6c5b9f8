"""Exact interpolating percentiles per group without holding a group in one buffer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def group_percentiles(
    df: DataFrame, keys: list[str], value: str, probabilities: dict[str, float], weight: str | None = None,
    bucket_width: float = 1.0,
) -> DataFrame:
    """PERCENTILE_CONT per group; `weight` counts a row several times.

    Two levels: rows collapse to counts per distinct value (map-side), these to counts per value bucket. A running sum
    over the few buckets gives each bucket its starting position, and only inside a bucket the distinct values are put
    in order. No task gets more than the buckets of a group or the distinct values of a bucket.
    """
    copies = F.sum(weight) if weight else F.count("*")
    values = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(copies.alias("_n"))
    values = values.withColumn("_bucket", F.floor(F.col(value) / bucket_width))
    buckets = values.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_bn"))
    ordered = Window.partitionBy(*keys).orderBy("_bucket")
    buckets = buckets.select(
        *keys, "_bucket",
        F.coalesce(F.sum("_bn").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
        "_bn",
        F.sum("_bn").over(Window.partitionBy(*keys)).alias("_total"),
    )
    lows = {name: F.floor(F.lit(p) * (F.col("_total") - 1)) for name, p in probabilities.items()}
    highs = {name: F.ceil(F.lit(p) * (F.col("_total") - 1)) for name, p in probabilities.items()}
    # Only the buckets that hold a wanted position go on: at most two per percentile and group.
    wanted = reduce(Column.__or__, (
        (position >= F.col("_start")) & (position < F.col("_start") + F.col("_bn"))
        for position in (*lows.values(), *highs.values())
    ))
    buckets = buckets.filter(wanted).drop("_bn")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(value)
    placed = values.join(buckets, [*keys, "_bucket"]).withColumn("_last", F.col("_start") + F.sum("_n").over(inside))
    first = F.col("_last") - F.col("_n")
    picks, out = [], []
    for name, p in probabilities.items():
        for side, position in (("lo", lows[name]), ("hi", highs[name])):
            picks.append(F.max(F.when((position >= first) & (position < F.col("_last")), F.col(value))).alias(f"_{name}_{side}"))
        rest = F.lit(p) * (F.col("_total") - 1) - F.floor(F.lit(p) * (F.col("_total") - 1))
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((low + (high - low) * rest).alias(name))
    return placed.groupBy(*keys).agg(F.max("_total").alias("_total"), *picks).select(*keys, *out)
