"""Chart aggregations over order documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from storeglass.functions.exprs import at, days_before

# Upper limits of the revenue bands.
REVENUE_BANDS = (50_000_000, 100_000_000, 200_000_000)


def top_terms(df: DataFrame, term: str, metric: Column, name: str, n: int, out: str | None = None) -> DataFrame:
    """The n values of a column with the highest metric; rows without a value do not count."""
    out = out or term
    return df.filter(F.col(term).isNotNull()).groupBy(F.col(term).alias(out)).agg(metric.alias(name)).orderBy(
        F.desc(name), out).limit(n)


def hourly_revenue(documents: DataFrame) -> DataFrame:
    """Revenue per hour; hours without orders have no row."""
    return documents.groupBy(F.window("order_date", "1 hour").alias("_w")).agg(F.sum("total_amount").alias("revenue")).select(
        F.col("_w.start").alias("bucket"), "revenue").orderBy("bucket")


def revenue_by_brand(documents: DataFrame, n: int = 10) -> DataFrame:
    """Revenue of the orders with a brand; an order counts once for each of its brands."""
    exploded = documents.select(F.explode("brands").alias("brand"), "total_amount")
    return top_terms(exploded, "brand", F.sum("total_amount"), "revenue", n)


def orders_by_payment(documents: DataFrame, n: int = 5) -> DataFrame:
    return top_terms(documents, "payment_method", F.count("*"), "n", n)


def orders_by_status(documents: DataFrame, n: int = 6) -> DataFrame:
    return top_terms(documents, "status", F.count("*"), "n", n)


def quantity_by_category(documents: DataFrame, n: int = 8) -> DataFrame:
    """Item quantity of the orders with a category; an order counts in full for each of its categories."""
    exploded = documents.select(F.explode("categories").alias("category"), "total_quantity")
    return top_terms(exploded, "category", F.sum("total_quantity"), "quantity", n)


def revenue_24h(documents: DataFrame, as_of) -> DataFrame:
    """Revenue of the last 24 hours (both ends included) with its band: 0, 1 or 2 and 3 above the last limit."""
    last_day = (F.col("order_date") >= at(days_before(as_of, 1))) & (F.col("order_date") <= at(as_of))
    total = documents.filter(last_day).agg(F.coalesce(F.sum("total_amount"), F.lit(0.0)).alias("total"))
    band = F.lit(0)
    for limit in REVENUE_BANDS:
        band = band + F.when(F.col("total") >= limit, 1).otherwise(0)
    return total.withColumn("band", band)

