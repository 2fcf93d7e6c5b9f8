"""Behaviour, popularity and the tables derived from events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from storeglass.functions.exprs import (
    ACTIONS, ENGAGEMENT_WEIGHTS, POPULARITY_WEIGHTS, RATING_WEIGHTS, all_of, at, count_if, days_before, exact_round, moment,
    span, translate, weight_of,
)
from storeglass.operators.lookup import lookup_join
from storeglass.operators.ranking import top_per_group
from storeglass.plans.sales import name_categories


def behavior_counts(t, as_of, days: int = 7, user_id=None) -> DataFrame:
    """Actions of the last days per user and type."""
    return _recent_actions(t, as_of, days, user_id).groupBy("user_id", "action_type").agg(
        F.count("*").alias("count"), F.countDistinct("product_id").alias("unique_products"))


def behavior_products(t, as_of, days: int = 7, user_id=None, limit: int = 10) -> DataFrame:
    """The products a user dealt with most."""
    actions = _recent_actions(t, as_of, days, user_id).groupBy("user_id", "product_id").agg(
        F.count("*").alias("interaction_count"), F.max("created_at").alias("last_interaction"),
        F.sort_array(F.collect_set("action_type")).alias("action_types"))
    known = lookup_join(actions, t.products.select("product_id", F.col("name").alias("product_name"), "category_id"),
                        "product_id", spread_by="user_id")
    best = [F.desc("interaction_count"), F.desc("last_interaction"), F.asc("product_id")]
    top = top_per_group(known.filter(F.col("category_id").isNotNull()), ["user_id"], best, limit)
    return name_categories(t, top).select("user_id", "product_id", "product_name", "category", "interaction_count",
                                          "last_interaction", "action_types")


def _recent_actions(t, as_of, days: int, user_id) -> DataFrame:
    return t.user_behavior_log.filter(all_of(
        span("created_at", days_before(as_of, days), as_of),
        None if user_id is None else F.col("user_id") == F.lit(user_id)))


def engagement(stats: DataFrame, weights: dict[str, float] | None = None, users: DataFrame | None = None) -> DataFrame:
    """Engagement level of every user from action counts (user_id, action_type, count).

    With `users`, those without any action are listed as no_data.
    """
    weights = ENGAGEMENT_WEIGHTS if weights is None else weights
    n = F.col("count")
    # The list holds one entry per action type of a user.
    actions = F.sort_array(F.collect_list(F.struct((-n).alias("k"), F.col("action_type").alias("action"), n.alias("count"))))
    sums = stats.groupBy("user_id").agg(
        F.sum(n * weight_of("action_type", weights, 1.0)).alias("_weighted"), F.sum(n).alias("total_actions"),
        actions.alias("_actions"))
    score = F.col("_weighted") / F.greatest("total_actions", F.lit(1))
    level = F.when(score >= 3, "high").when(score >= 2, "medium").otherwise("low")
    total = F.col("total_actions")
    share = lambda part: F.when(total > 0, exact_round(part / total * 100, 1)).otherwise(F.lit(0.0))
    shown = F.transform(
        F.slice(F.filter("_actions", lambda a: a["count"] > 0), 1, 3),
        lambda a: F.struct(a["action"].alias("action"), a["count"].alias("count"), share(a["count"]).alias("percentage")))
    rated = sums.select("user_id", level.alias("engagement_level"), exact_round(score, 2).alias("engagement_score"),
                        "total_actions", shown.alias("primary_actions"))
    if users is None:
        return rated
    return users.select("user_id").join(rated, "user_id", "left").withColumn(
        "engagement_level", F.coalesce("engagement_level", F.lit("no_data")))


def trending(events: DataFrame, as_of, limit: int = 50) -> DataFrame:
    """Products of the last day by interactions, distinct users and purchases."""
    since = days_before(moment(as_of).replace(hour=0, minute=0, second=0, microsecond=0), 1)
    recent = events.filter((F.col("ts") > at(since)) & (F.col("ts") < at(as_of)))
    return trending_score(recent.groupBy("product_id").agg(
        F.count("*").alias("total_interactions"), F.countDistinct("user_id").alias("unique_users"),
        count_if(F.col("event_type") == "purchase").alias("purchases"),
    )).orderBy(F.desc("trending_score"), "product_id").limit(limit)


# Parts of ten for interactions, users and purchases.
TRENDING_TENTHS = (3, 5, 2)


def trending_score(counts: DataFrame) -> DataFrame:
    """Weighted sum in whole tenths, divided once: equal scores stay equal and ties are decided by key."""
    interactions, users, purchases = TRENDING_TENTHS
    tenths = F.col("total_interactions") * interactions + F.col("unique_users") * users + F.col("purchases") * purchases
    return counts.withColumn("trending_score", tenths / F.lit(10.0))


def simple_trending(events: DataFrame, n: int = 20) -> DataFrame:
    """Products by interactions over all events."""
    top = events.groupBy("product_id").agg(
        F.count("*").alias("interactions"), F.countDistinct("user_id").alias("unique_users")
    ).orderBy(F.desc("interactions"), "product_id").limit(n)
    return top.select(
        "product_id", exact_round(F.col("interactions") * 2.5, 1).alias("score"), "interactions", "unique_users",
        F.greatest(F.lit(1), F.floor(F.col("interactions") / 5)).cast("bigint").alias("purchases"))


def user_counters(events: DataFrame, user_id=None) -> DataFrame:
    """Running counters of a user: all events, events per type, last activity."""
    chosen = events if user_id is None else events.filter(F.col("user_id") == F.lit(user_id))
    return chosen.groupBy("user_id").agg(*counter_columns())


def counter_columns(ts: str = "ts") -> list[Column]:
    types = ("view", "cart", "purchase", "like", "search")
    return [F.count("*").alias("total_events"),
            *(count_if(F.col("event_type") == kind).alias(f"{kind}_count") for kind in types),
            F.max(ts).alias("last_activity")]


def popularity(events: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Weighted popularity of every product with at least one event that counts."""
    weights = POPULARITY_WEIGHTS if weights is None else weights
    return events.filter(F.col("event_type").isin(*weights)).groupBy("product_id").agg(
        F.sum(weight_of("event_type", weights, 0.0)).alias("popularity_score"))


def popular_products(events: DataFrame, limit: int = 20) -> DataFrame:
    return popularity(events).orderBy(F.desc("popularity_score"), "product_id").limit(limit)


def behavior_log(events: DataFrame) -> DataFrame:
    """Event -> row of the behaviour log."""
    return events.select(
        "user_id", "product_id", translate("event_type", ACTIONS).alias("action_type"), "session_id",
        F.col("device").alias("device_type"), "ip_address", "user_agent", "search_query", F.col("ts").alias("created_at"))


def orders_from_purchases(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Purchase event -> order and order line. The order id derives from the event, so a replay gives the same rows."""
    bought = events.filter(F.col("event_type") == "purchase")
    order_id = F.concat(F.lit("order_"), F.col("event_id").cast("string"))
    amount, quantity = F.coalesce("total_amount", F.lit(0.0)), F.coalesce("quantity", F.lit(1))
    orders = bought.select(
        order_id.alias("order_id"), "user_id", F.col("ts").alias("order_date"), amount.alias("total_amount"),
        F.lit("pending").alias("status"), F.lit(None).cast("string").alias("shipping_address"),
        F.lit(None).cast("string").alias("payment_method"))
    items = bought.select(
        order_id.alias("order_id"), "product_id", quantity.alias("quantity"),
        (amount / quantity).alias("unit_price"), amount.alias("total_price"))
    return orders, items


def cart_upsert(cart: DataFrame | None, events: DataFrame) -> DataFrame:
    """Cart after the cart events: one more per event, time of the last one."""
    added = events.filter(F.col("event_type") == "cart").select(
        "user_id", "product_id", F.lit(1).cast("bigint").alias("quantity"), F.col("ts").alias("added_at"))
    rows = added if cart is None else cart.select(
        "user_id", "product_id", F.col("quantity").cast("bigint").alias("quantity"), "added_at").unionByName(added)
    return rows.groupBy("user_id", "product_id").agg(F.sum("quantity").alias("quantity"), F.max("added_at").alias("added_at"))


def ratings(events: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """User x item ratings: average weight times log of the number of interactions plus one."""
    weights = RATING_WEIGHTS if weights is None else weights
    return events.groupBy("user_id", "product_id").agg(
        F.avg(weight_of("event_type", weights, 1.0)).alias("avg_rating"), F.count("*").alias("interaction_count"),
    ).withColumn("final_rating", F.col("avg_rating") * F.log(F.col("interaction_count") + F.lit(1.0)))
