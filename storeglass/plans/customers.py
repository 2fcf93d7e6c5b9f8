"""Reports per user: cohorts, value, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from storeglass.functions.exprs import (
    SOLD, SOLD_OR_COMPLETED, at, count_if, days_before, exact_round, month_of, months_before, seconds_between, span,
)
from storeglass.operators.lookup import enrich_rows, lookup_join
from storeglass.operators.materialize import materialize
from storeglass.operators.ranking import probe_ranks
from storeglass.plans.sales import line_value, name_categories, sales_lines, with_category


def cohort_retention(t, as_of, months: int = 18, periods: int = 12) -> DataFrame:
    """Monthly cohorts by first order: retention, orders and revenue per period.

    The cohort comes from the whole history, the orders from the last `months`; orders without lines do not count.
    """
    first = t.orders.filter(span("created_at", None, as_of)).groupBy("user_id").agg(
        month_of(F.min("created_at")).alias("cohort_month"))
    orders = sales_lines(t, months_before(as_of, months), as_of).groupBy("order_id", "user_id", "ordered_at").agg(
        F.sum(line_value()).alias("order_value"))
    period = F.months_between(month_of("ordered_at"), F.col("cohort_month")).cast("int")
    cells = (
        lookup_join(orders, first, "user_id", spread_by="order_id").withColumn("period_number", period)
        .filter(F.col("period_number").between(0, periods))
        .groupBy("cohort_month", "period_number")
        .agg(F.countDistinct("user_id").alias("customers"), F.count("*").alias("orders"),
             F.sum("order_value").alias("revenue"), F.avg("order_value").alias("avg_order_value"),
             F.min("order_value").alias("min_order_value"), F.max("order_value").alias("max_order_value"))
    )
    sizes = first.groupBy("cohort_month").agg(F.count("*").alias("cohort_size"))
    # One row per cohort and period from here on.
    previous = F.lag("customers").over(Window.partitionBy("cohort_month").orderBy("period_number"))
    out = cells.join(sizes, "cohort_month").withColumn("prev_period_customers", previous)
    customers, before = F.col("customers"), F.col("prev_period_customers")
    return out.select(
        "cohort_month", "period_number", "customers", "cohort_size",
        exact_round(customers / F.col("cohort_size") * 100, 2).alias("retention_rate"),
        "orders", "revenue", "avg_order_value", "min_order_value", "max_order_value",
        exact_round(F.col("revenue") / customers, 2).alias("revenue_per_customer"),
        exact_round(F.col("orders") / customers, 2).alias("orders_per_customer"),
        "prev_period_customers",
        F.when(before > 0, exact_round((customers - before) / before * 100, 2)).otherwise(F.lit(0.0)).alias("period_growth_rate"),
    ).orderBy(F.desc("cohort_month"), "period_number")


def top_customers(t, as_of, days: int = 90, limit: int = 20, dedup_fanout: bool = False) -> DataFrame:
    """Customers by value score.

    Amounts are summed over item rows as the report does, or once per order with `dedup_fanout`. The metrics of all
    customers are written once; the spending rank of the few shown ones is then counted in one pass over them.
    """
    lines = sales_lines(t, days_before(as_of, days), as_of, SOLD_OR_COMPLETED, "order_date")
    # Distinct months as a bit set: twelve bits that combine map-side, no third distinct count.
    months = F.expr("bit_count(bit_or(shiftleft(1, month(order_date))))")
    metrics = lines.groupBy("user_id").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("total_amount").alias("total_spent"),
        F.avg("total_amount").alias("avg_order_value"),
        F.max("order_date").alias("last_order_date"),
        F.min("order_date").alias("first_order_date"),
        F.countDistinct("product_id").alias("unique_products_purchased"),
        months.alias("active_months"),
        F.sum("quantity").alias("total_items_purchased"),
    )
    if dedup_fanout:
        orders = t.orders.filter(
            span("order_date", days_before(as_of, days), as_of) & F.col("status").isin(*SOLD_OR_COMPLETED))
        once = orders.join(t.order_items.select("order_id"), "order_id", "left_semi").groupBy("user_id").agg(
            F.sum("total_amount").alias("total_spent"), F.avg("total_amount").alias("avg_order_value"))
        metrics = metrics.drop("total_spent", "avg_order_value").join(once, "user_id")
    score = (
        F.col("total_spent") / 1000 * 0.4 + F.col("total_orders") * 2 * 0.3
        + F.col("unique_products_purchased") * 0.2 + F.col("active_months") * 3 * 0.1
    )
    # Names are fetched for the shown users only; a user without a row in the table does not count.
    scored = materialize(metrics.join(t.users.select("user_id"), "user_id", "left_semi").withColumn(
        "customer_value_score", score))
    best_first = [F.desc("customer_value_score"), F.asc("user_id")]
    shown = enrich_rows(
        scored.orderBy(*best_first).limit(limit), t.users.select("user_id", "name", "email"), "user_id", limit)
    # Rank 1 of all customers is the first shown row, so its score is the maximum.
    over_shown = Window.orderBy(*best_first)
    shown = shown.withColumn("value_rank", F.row_number().over(over_shown)).withColumn(
        "_max", F.first("customer_value_score").over(over_shown))
    # Rank by spending, of those who spent the same the smaller id first, whatever the id's type: one pass.
    spent = F.struct("total_spent", "user_id").alias("_spent")
    below = lambda a, b: (a["total_spent"] < b["total_spent"]) | (
        (a["total_spent"] == b["total_spent"]) & (a["user_id"] > b["user_id"]))
    ranks = probe_ranks(shown.select(spent), scored.select(spent), None, "_spent", "spending_rank", below)
    shown = shown.join(ranks.select(F.col("_spent.user_id").alias("user_id"), "spending_rank"), "user_id", "left")
    seen = F.col("last_order_date")
    recent = lambda n: seen >= at(days_before(as_of, n))
    shown = shown.select(
        "user_id", "name", "email", "total_orders", "total_spent", "avg_order_value", "last_order_date", "first_order_date",
        "unique_products_purchased", "active_months", "total_items_purchased", "customer_value_score",
        exact_round(F.col("total_spent") / F.nullif(
            seconds_between(F.col("first_order_date"), at(as_of)) / 86400, F.lit(0.0)), 2).alias("daily_avg_spend"),
        F.when(recent(7), "highly_active").when(recent(30), "active").when(recent(60), "moderate")
        .otherwise("inactive").alias("activity_status"),
        "value_rank", "spending_rank",
        exact_round(F.col("customer_value_score") * 100.0 / F.col("_max"), 1).alias("score_percentile"),
    )
    joined = enrich_rows(shown, t.signups.select("user_id", F.col("signup_date").alias("join_date")), "user_id", limit)
    return joined.select("user_id", "name", "email", "join_date", *shown.columns[3:]).orderBy("value_rank")


def user_summary(t, limit: int = 500) -> DataFrame:
    """Orders and spending per user; users without any order stay, users with unsold orders only go."""
    kept = F.col("status").isin(*SOLD_OR_COMPLETED) | F.col("status").isNull()
    sums = t.orders.groupBy("user_id").agg(
        count_if(kept).alias("order_count"),
        F.sum(F.when(kept, F.col("total_amount"))).alias("total_spent"),
        F.max(F.when(kept, F.col("order_date"))).alias("last_order_date"),
    )
    return (
        t.users.select("user_id", "name", "email").join(sums, "user_id", "left")
        .filter(F.col("order_count").isNull() | (F.col("order_count") > 0))
        .select("user_id", "name", "email", F.coalesce("order_count", F.lit(0)).alias("order_count"),
                F.coalesce("total_spent", F.lit(0.0)).alias("total_spent"), "last_order_date")
        .orderBy(F.desc("total_spent"), "user_id").limit(limit)
    )


def user_stats(t) -> DataFrame:
    """Every user with sold orders and with views and searches."""
    orders = t.orders.filter(F.col("status").isin(*SOLD)).groupBy("user_id").agg(
        F.count("*").alias("total_orders"), F.sum("total_amount").alias("total_spent"),
        F.avg("total_amount").alias("avg_order_value"))
    actions = t.user_behavior_log.groupBy("user_id").agg(
        count_if(F.col("action_type") == "view").alias("total_views"),
        count_if(F.col("action_type") == "search").alias("total_searches"))
    zero = lambda name, value=0: F.coalesce(name, F.lit(value)).alias(name)
    return (
        t.users.select("user_id", "name", "email").join(t.signups, "user_id", "left")
        .join(orders, "user_id", "left").join(actions, "user_id", "left")
        .select("user_id", "name", "email", "signup_date", zero("total_orders"), zero("total_spent", 0.0),
                zero("avg_order_value", 0.0), zero("total_views"), zero("total_searches"))
    )


def string_profile(t, year_text: str = "2024") -> DataFrame:
    """String measures over all order lines, with keys compared as text.

    Keys of one type have equal text exactly when they are equal, so they are compared as they are; only keys of
    different types are cast.
    """
    # Text work is done where there are fewest rows: names per user, times and ids per order, prices per line.
    # The text of a time holds no letters, so NOT LIKE '%impossible_date%' only rejects missing times.
    orders = t.orders.filter(F.col("created_at").isNotNull()).select(
        "order_id", "user_id",
        F.substring(F.col("order_id").cast("string"), 1, 3).cast("int").alias("id_prefix"),
        F.when(F.col("created_at").cast("string").contains(year_text), 1).otherwise(0).alias("in_year"),
        seconds_between(at("1970-01-01"), F.col("created_at")).alias("seconds"),
    )
    users = t.users.filter(~F.col("email").like("%@nonexistent.com")).select(
        "user_id", F.length("name").alias("name_length"))
    products = t.products.filter(F.col("description").isNotNull()).select(
        "product_id", F.upper(F.substring("name", 1, 5)).alias("prefix"), "category_id")
    price_text = F.col("unit_price").cast("decimal(10,2)").cast("string")
    lines = t.order_items.select(
        "order_id", "product_id", F.when(price_text.rlike(r"^[0-9]+\.[0-9]{2}$"), 1).otherwise(0).alias("exact_price"))
    # Users meet the orders, not the lines, and a hot user or product is spread over tasks.
    placed = lookup_join(*_comparable(orders, users, "user_id"), "user_id", spread_by="order_id")
    lines, placed = _comparable(lines, placed, "order_id")
    joined = lines.join(placed, "order_id")
    joined = lookup_join(*_comparable(joined, products, "product_id"), "product_id", spread_by="order_id")
    # Category names are looked at once per category, not once per line.
    per_category = joined.groupBy("category_id", "prefix").agg(
        F.count("*").alias("n"), F.sum("id_prefix").alias("id_prefix"), F.sum("in_year").alias("year_count"),
        F.max("name_length").alias("name_length"), F.min("seconds").alias("first_seen"),
        F.sum("exact_price").alias("exact_prices"),
    )
    vowel_length = F.when(F.col("category").rlike("[aeiou]"), F.length("category")).otherwise(0)
    return name_categories(t, per_category).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        (F.sum("id_prefix") / F.sum("n")).alias("avg_id_prefix"),
        F.sum("year_count").alias("year_count"),
        F.max("name_length").alias("max_name_length"),
        F.min("first_seen").alias("min_timestamp"),
        F.countDistinct("prefix").alias("unique_product_prefixes"),
        F.sum("exact_prices").alias("exact_price_count"),
        (F.sum(vowel_length * F.col("n")) / F.sum("n")).alias("avg_vowel_category_length"),
    )


def _comparable(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with the key as text if its types differ."""
    if left.schema[key].dataType != right.schema[key].dataType:
        left, right = (df.withColumn(key, F.col(key).cast("string")) for df in (left, right))
    return left, right
