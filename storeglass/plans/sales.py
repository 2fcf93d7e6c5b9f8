"""Sales reports over categories, products and months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from storeglass.functions.exprs import (
    SOLD, SOLD_OR_COMPLETED, VOID, all_of, count_if, days_before, distinct_count, exact_round, growth_rate, month_of,
    months_before, span,
)
from storeglass.operators.hierarchy import walk_tree
from storeglass.operators.lookup import enrich_rows, lookup_join
from storeglass.operators.percentiles import group_percentiles
from storeglass.operators.materialize import materialize
from storeglass.operators.ranking import ranks_from_counters


def line_value() -> Column:
    return F.col("quantity") * F.col("unit_price")


def sales_lines(t, since=None, until=None, statuses=None, when: str = "created_at") -> DataFrame:
    """Order lines of the orders of a period (and statuses), with the order's columns."""
    orders = t.orders.filter(all_of(
        span(when, since, until) if since is not None or until is not None else None,
        F.col("status").isin(*statuses) if statuses else None,
    )).select("order_id", "user_id", "order_date", F.col("created_at").alias("ordered_at"), "status", "total_amount")
    lines = t.order_items.select("order_id", "order_item_id", "product_id", "quantity", "unit_price", "total_price")
    return lines.join(orders, "order_id")


def with_category(t, lines: DataFrame, *columns: str) -> DataFrame:
    """Adds category_id (and other product columns) to lines; a hot product is spread over tasks."""
    return lookup_join(lines, t.products.select("product_id", "category_id", *columns), "product_id", spread_by="order_id")


def name_categories(t, df: DataFrame, column: str = "category") -> DataFrame:
    """Category names are joined to aggregated rows, so that no fact is shuffled by one of a handful of keys."""
    return df.join(t.categories.select("category_id", F.col("name").alias(column)), "category_id")


def name_products(t, df: DataFrame, product: str = "product_name", brand: bool = True) -> DataFrame:
    """Product, category and brand names for rows that have one row per product."""
    named = df.join(t.products.select("product_id", F.col("name").alias(product), "category_id", "brand_id"), "product_id")
    named = name_categories(t, named)
    if brand:
        named = named.join(t.brands.select("brand_id", F.col("name").alias("brand")), "brand_id")
    return named


def monthly_category_growth(t, as_of, months: int = 12, limit: int = 100, approx: bool = False) -> DataFrame:
    """Revenue per month and category with growth, spread and ranks; `approx` counts customers and orders by sketch."""
    lines = sales_lines(t, months_before(as_of, months), as_of).select(
        "order_id", "user_id", "product_id", month_of("ordered_at").alias("month"), line_value().alias("value"))
    stats = with_category(t, lines).groupBy("month", "category_id").agg(
        distinct_count("order_id", approx).alias("order_count"),
        distinct_count("user_id", approx).alias("unique_customers"),
        F.sum("value").alias("revenue"),
        F.avg("value").alias("avg_order_value"),
        F.stddev_samp("value").alias("revenue_stddev"),
    )
    history = Window.partitionBy("category").orderBy("month")
    # From here on there is one row per month and category: windows over them stay small.
    grown = name_categories(t, stats).withColumn("_previous", F.lag("revenue").over(history)).withColumn(
        "growth_rate", growth_rate(F.col("revenue"), F.col("_previous")))
    return grown.select(
        "month", "category", "revenue", "growth_rate", "order_count", "unique_customers", "avg_order_value", "revenue_stddev",
        F.rank().over(Window.partitionBy("month").orderBy(F.desc("revenue"))).alias("revenue_rank"),
        F.row_number().over(Window.orderBy(F.desc_nulls_last("growth_rate"), F.desc("month"), "category")).alias("growth_rank"),
    ).orderBy(F.desc("month"), F.desc("revenue"), "category").limit(limit)


def product_sales_profile(t, as_of, months: int = 6, limit: int = 50, dedup_fanout: bool = False) -> DataFrame:
    """Sales profile of the products with the highest revenue.

    The question joins lines and reviews of a product, so every line counts once per review. That product of two facts
    is never built: sums are multiplied by the number of reviews and percentiles weighted with it. With
    `dedup_fanout` every line counts once. Only the first `limit` products get distinct counts and percentiles.
    """
    lines = sales_lines(t, months_before(as_of, months), as_of).select(
        "order_id", "user_id", "product_id", "quantity", "ordered_at", line_value().alias("value"))
    reviews = t.product_reviews.groupBy("product_id").agg(
        F.count("*").alias("_reviews"), F.count("rating").alias("_rated"), F.sum("rating").alias("_stars"))
    copies = F.lit(1) if dedup_fanout else F.greatest(F.coalesce("_reviews", F.lit(0)), F.lit(1))
    totals = lines.groupBy("product_id").agg(
        F.count("*").alias("_lines"), F.countDistinct("order_id").alias("total_orders"),
        F.sum("quantity").alias("_quantity"), F.sum("value").alias("_value"),
        F.min("ordered_at").alias("first_order_date"), F.max("ordered_at").alias("last_order_date"),
    )
    named = name_products(t, totals).join(reviews, "product_id", "left").withColumn("_copies", copies)
    best = materialize(named.withColumn("total_revenue", F.col("_value") * F.col("_copies")).orderBy(
        F.desc_nulls_last("total_revenue"), F.desc("total_orders"), "product_id").limit(limit))
    # The rest only concerns the lines of at most `limit` products: they are filtered before the join with orders.
    few = best.select("product_id", "_copies")
    detail = sales_lines(_only_products(t, few), months_before(as_of, months), as_of).join(
        F.broadcast(few), "product_id").select(
        "product_id", "user_id", month_of("ordered_at").alias("month"), line_value().alias("value"), "_copies")
    distincts = detail.groupBy("product_id").agg(
        F.countDistinct("user_id").alias("unique_customers"), F.countDistinct("month").alias("months_active"))
    middle = group_percentiles(detail, ["product_id"], "value", {"median_order_value": 0.5, "p95_order_value": 0.95}, "_copies")
    lines_seen = F.col("_lines") if not dedup_fanout else F.lit(1)
    return best.join(distincts, "product_id").join(middle, "product_id").select(
        "product_id", "product_name", "category", "brand", "total_orders",
        (F.col("_quantity") * F.col("_copies")).alias("total_quantity_sold"),
        "total_revenue",
        (F.col("_value") / F.col("_lines")).alias("avg_order_item_value"),
        "first_order_date", "last_order_date", "unique_customers", "months_active",
        F.coalesce(F.col("_stars") / F.col("_rated"), F.lit(0.0)).alias("avg_product_rating"),
        (F.coalesce("_reviews", F.lit(0)) * lines_seen).alias("review_count"),
        "median_order_value", "p95_order_value",
    ).orderBy(F.desc_nulls_last("total_revenue"), F.desc("total_orders"), "product_id")


class _only_products:
    """The tables with the order lines cut to a bounded set of products."""

    def __init__(self, t, few: DataFrame):
        self.orders = t.orders
        self.order_items = t.order_items.join(F.broadcast(few.select("product_id")), "product_id", "left_semi")


def category_tree(t, as_of, months: int = 3, max_depth: int | None = 10, method: str = "recursive") -> DataFrame:
    """Statistics per node of the category tree with path, level and ranks in the level. For a tree that is deep, very
    large or may hold cycles, `method` is "fixpoint" (see `walk_tree`).

    A node counts the lines of recent orders and its products that were never ordered; a product with old orders only
    is left out, and a node left with nothing because of that as well.
    """
    nodes = walk_tree(t.category_tree, "category_id", "parent_category_id", "name", max_depth, method)
    # Lines of an order without a date, or of no known order, count as well; the latter have no order and no user.
    orders = t.orders.select(F.col("order_id").alias("_order"), "user_id", "created_at")
    recent = t.order_items.select("order_id", "product_id", "quantity", "unit_price", "total_price").join(
        orders, F.col("order_id") == F.col("_order"), "left").filter(
        F.col("created_at").isNull() | span("created_at", months_before(as_of, months), as_of)).select(
        "product_id", F.col("_order").alias("order_id"), "user_id", line_value().alias("value"))
    never = t.products.select("product_id").join(t.order_items.select("product_id").distinct(), "product_id", "left_anti")
    kept = recent.unionByName(never, allowMissingColumns=True)
    owner = "tree_category_id" if "tree_category_id" in t.products.columns else "category_id"
    products = t.products.select("product_id", F.col(owner).alias("category_id"), "rating", "price")
    stats = lookup_join(kept, products, "product_id", spread_by="order_id").groupBy("category_id").agg(
        F.countDistinct("product_id").alias("product_count"),
        F.countDistinct("order_id").alias("order_count"),
        F.countDistinct("user_id").alias("unique_customers"),
        F.sum("value").alias("_revenue"), F.avg("rating").alias("_rating"), F.avg("price").alias("_price"),
        F.min("price").alias("min_price"), F.max("price").alias("max_price"),
    )
    stocked = products.select("category_id").distinct().withColumn("_stocked", F.lit(True))
    zero = lambda name: F.coalesce(name, F.lit(0))
    full = nodes.join(stats, "category_id", "left").join(stocked, "category_id", "left").filter(
        F.col("product_count").isNotNull() | F.col("_stocked").isNull()
    ).select(
        "category_id", "name", "level", "path", "id_path",
        zero("product_count").alias("product_count"), zero("order_count").alias("order_count"),
        F.coalesce("_revenue", F.lit(0.0)).alias("total_revenue"), zero("unique_customers").alias("unique_customers"),
        F.coalesce("_rating", F.lit(0.0)).alias("avg_rating"), "min_price", "max_price",
        F.coalesce("_price", F.lit(0.0)).alias("avg_price"),
    )
    # Windows over the nodes of a level: one row per category.
    level = Window.partitionBy("level")
    return full.select(
        "*",
        F.rank().over(level.orderBy(F.desc("total_revenue"))).alias("revenue_rank_in_level"),
        F.lag("total_revenue").over(level.orderBy(F.desc("total_revenue"), "category_id")).alias("prev_revenue_in_level"),
        F.when(F.col("product_count") > 0, F.col("total_revenue") / F.col("product_count")).otherwise(F.lit(0.0))
        .alias("revenue_per_product"),
    ).orderBy("level", F.desc("total_revenue"), "category_id")


def category_sales(t, as_of, days: int = 30, approx: bool = False) -> DataFrame:
    """Category sales report: totals, shares of the whole, ranks; `approx` counts orders and customers by sketch."""
    lines = sales_lines(t, days_before(as_of, days), as_of, SOLD_OR_COMPLETED, "order_date")
    stats = with_category(t, lines).groupBy("category_id").agg(
        distinct_count("order_id", approx).alias("total_orders"),
        F.sum("quantity").alias("total_items_sold"),
        F.sum("total_price").alias("total_revenue"),
        distinct_count("user_id", approx).alias("unique_customers"),
        F.avg("unit_price").alias("avg_unit_price"),
        F.min("unit_price").alias("min_price"),
        F.max("unit_price").alias("max_price"),
    )
    everything = Window.partitionBy()  # over one row per category
    share = lambda column: exact_round(F.col(column) * 100.0 / F.sum(column).over(everything), 2)
    return name_categories(t, stats).select(
        "category", "total_orders", "total_items_sold", "total_revenue", "unique_customers", "avg_unit_price",
        "min_price", "max_price",
        share("total_revenue").alias("revenue_percentage"),
        share("total_items_sold").alias("volume_percentage"),
        exact_round(F.col("total_revenue") / F.nullif("total_orders", F.lit(0)), 2).alias("avg_order_value"),
        F.row_number().over(Window.orderBy(F.desc("total_revenue"), "category")).alias("revenue_rank"),
        F.row_number().over(Window.orderBy(F.desc("total_items_sold"), "category")).alias("volume_rank"),
    ).orderBy("revenue_rank")


def dashboard(t, as_of) -> dict[str, DataFrame]:
    """Four sections: overview, categories of 90 days, daily trend and top products of 30 days."""
    sold = F.col("status").isin(*SOLD_OR_COMPLETED)
    overview = t.orders.agg(
        F.count("*").alias("total_orders"),
        F.coalesce(F.sum(F.when(sold, F.col("total_amount"))), F.lit(0.0)).alias("total_revenue"),
    ).select(
        t.users.agg(F.count("*")).scalar().alias("total_users"),
        t.products.filter("is_active").agg(F.count("*")).scalar().alias("total_products"),
        "total_orders", "total_revenue",
    )
    quarter = with_category(t, sales_lines(t, days_before(as_of, 90), as_of, SOLD_OR_COMPLETED, "order_date"))
    categories = name_categories(t, quarter.groupBy("category_id").agg(
        F.count("*").alias("items_sold"), F.sum("total_price").alias("revenue"),
        F.avg("unit_price").alias("avg_unit_price"), F.countDistinct("user_id").alias("unique_customers"),
    )).drop("category_id").select("category", "items_sold", "revenue", "avg_unit_price", "unique_customers").orderBy(
        F.desc("revenue"), "category").limit(10)
    daily = (
        t.orders.filter(span("order_date", days_before(as_of, 30), as_of) & ~F.col("status").isin(*VOID))
        .groupBy(F.to_date("order_date").alias("order_date"))
        .agg(F.count("*").alias("order_count"), F.sum("total_amount").alias("daily_revenue"),
             F.avg("total_amount").alias("avg_order_value"), F.countDistinct("user_id").alias("unique_customers"))
        .orderBy(F.desc("order_date")).limit(30)
    )
    month = sales_lines(t, days_before(as_of, 30), as_of, SOLD_OR_COMPLETED, "order_date").groupBy("product_id").agg(
        F.sum("quantity").alias("total_sold"), F.sum("total_price").alias("product_revenue"),
        F.countDistinct("order_id").alias("order_frequency"))
    products = name_products(t, month, brand=False).select(
        "product_id", "product_name", "category", "total_sold", "product_revenue", "order_frequency"
    ).orderBy(F.desc("total_sold"), "product_id").limit(5)
    return {"overview": overview, "categories": categories, "daily_trends": daily, "top_products": products}


def dashboard_sections(t, as_of) -> DataFrame:
    """The dashboard as (section, JSON text); every list is bounded by the limit of its section."""
    orders = {"categories": "revenue", "daily_trends": "order_date", "top_products": "total_sold"}
    out = None
    for name, frame in dashboard(t, as_of).items():
        row = F.struct(*frame.columns)
        if name == "overview":
            section = frame.select(F.to_json(row).alias("data"))
        else:
            keyed = F.struct(F.col(orders[name]).alias("_key"), row.alias("_row"))
            best_first = F.sort_array(F.collect_list(keyed), asc=False)
            section = frame.agg(F.to_json(F.transform(best_first, lambda x: x["_row"])).alias("data"))
        section = section.select(F.lit(name).alias("section"), "data")
        out = section if out is None else out.unionByName(section)
    return out


def product_sales(t, category: str | None = None, limit: int = 100) -> DataFrame:
    """Sales of active products. A product without any line stays, one with unsold lines only goes."""
    lines = t.order_items.select("order_id", "product_id", "quantity", "unit_price", "total_price").join(
        t.orders.select("order_id", "status"), "order_id", "left")
    kept = F.col("status").isin(*SOLD_OR_COMPLETED) | F.col("status").isNull()
    sums = lines.groupBy("product_id").agg(
        F.sum(F.when(kept, 1).otherwise(0)).alias("times_ordered"),
        F.sum(F.when(kept, F.col("quantity"))).alias("total_quantity_sold"),
        F.sum(F.when(kept, F.col("total_price"))).alias("total_revenue"),
        F.avg(F.when(kept, F.col("unit_price"))).alias("avg_selling_price"),
    )
    shown = t.products.filter("is_active").select("product_id", "name", "category_id", "rating", "stock_quantity")
    out = name_categories(t, shown.join(sums, "product_id", "left").filter(
        F.col("times_ordered").isNull() | (F.col("times_ordered") > 0)))
    if category:
        out = out.filter(F.col("category") == F.lit(category))
    return out.select(
        "product_id", "name", "category", F.coalesce("times_ordered", F.lit(0)).alias("times_ordered"),
        "total_quantity_sold", "total_revenue", "avg_selling_price", "rating", "stock_quantity",
    ).orderBy(F.desc_nulls_last("total_revenue"), "product_id").limit(limit)


def daily_sales(t, since, limit: int = 100) -> DataFrame:
    return (
        t.orders.filter(span("order_date", since)).groupBy(F.to_date("order_date").alias("date"))
        .agg(F.count("*").alias("orders"), F.sum("total_amount").alias("revenue")).orderBy("date").limit(limit)
    )


def analytic_pack(t, as_of, since="2023-01-01", status: str = "delivered") -> dict[str, DataFrame]:
    """Daily sales, products sold most in a status, events of a week."""
    best = sales_lines(t, statuses=[status]).groupBy("product_id").agg(
        F.sum("quantity").alias("total_sold"), F.sum("total_price").alias("total_revenue"),
    ).join(t.products.select("product_id", "name"), "product_id").orderBy(F.desc("total_sold"), "product_id").limit(20)
    week = t.user_behavior_log.filter(span("created_at", days_before(as_of, 7), as_of)).groupBy("action_type").agg(
        F.count("*").alias("event_count"), F.countDistinct("user_id").alias("unique_users"))
    return {"daily_sales": daily_sales(t, since), "top_products": best.select("name", "total_sold", "total_revenue"),
            "user_behavior": week}


def recent_lines(t, as_of, days: int = 30, limit: int = 100) -> DataFrame:
    """Latest order lines with their ranks in the user's lines and in the category.

    Windows over all lines are not needed for a top-k answer: lines of a user that come before a shown line are newer
    and hence shown too; counts, averages and category ranks come from one map-side aggregate over the lines.
    """
    lines = with_category(t, sales_lines(t, days_before(as_of, days), as_of), "brand_id").select(
        "order_id", "user_id", F.col("ordered_at").alias("created_at"), "order_item_id", "product_id", "category_id",
        "brand_id", "quantity", "unit_price", line_value().alias("item_total"))
    newest = [F.desc("created_at"), F.desc("item_total"), F.asc("order_id"), F.asc("order_item_id")]
    shown = materialize(lines.orderBy(*newest).limit(limit).withColumn(
        "user_order_rank", F.row_number().over(Window.partitionBy("user_id").orderBy(*newest))))
    # Second and last pass: lines counted per category, number of shown values they exceed, and shown user.
    cuts = shown.groupBy("category_id").agg(F.sort_array(F.collect_set("item_total")).alias("_cuts"))
    users = shown.select("user_id", F.col("user_id").alias("_shown_user")).distinct()
    exceeded = F.coalesce(F.size(F.filter("_cuts", lambda cut: cut < F.col("item_total"))), F.lit(-1))
    cells = materialize(
        lines.join(F.broadcast(cuts), "category_id", "left").join(F.broadcast(users), "user_id", "left")
        .groupBy("category_id", exceeded.alias("_above"), "_shown_user")
        .agg(F.count("*").alias("_n"), F.sum("unit_price").alias("_price"), F.count("unit_price").alias("_priced")))
    per_user = cells.filter(F.col("_shown_user").isNotNull()).groupBy(F.col("_shown_user").alias("user_id")).agg(
        F.sum("_n").alias("user_total_orders"))
    averages = cells.groupBy("category_id").agg((F.sum("_price") / F.sum("_priced")).alias("category_avg_price"))
    counters = cells.filter("_above > 0").groupBy("category_id", "_above").agg(F.sum("_n").alias("_n"))
    ranks = ranks_from_counters(cuts, counters, ["category_id"], "item_total", "item_value_rank_in_category")
    out = shown.join(per_user, "user_id").join(averages, "category_id").join(ranks, ["category_id", "item_total"])
    out = name_categories(t, out, "category_name").join(
        t.brands.select("brand_id", F.col("name").alias("brand_name")), "brand_id")
    out = enrich_rows(out, t.products.select("product_id", F.col("name").alias("product_name")), "product_id", limit)
    return out.orderBy(*newest).select(
        "order_id", "user_id", "created_at", "product_id", "product_name", "category_name", "brand_name", "quantity",
        "unit_price", "item_total", "user_order_rank", "user_total_orders", "category_avg_price",
        "item_value_rank_in_category")


def hot_products(t, as_of, days: int = 30, min_orders: int = 5, limit: int = 10) -> DataFrame:
    sums = sales_lines(t, days_before(as_of, days), as_of).groupBy("product_id").agg(
        F.countDistinct("order_id").alias("total_orders"), F.sum("quantity").alias("total_sold"),
        F.avg("unit_price").alias("avg_price"), F.max("ordered_at").alias("last_order_date"),
    ).filter(F.col("total_orders") > min_orders)
    return name_products(t, sums).orderBy(F.desc("total_sold"), "product_id").limit(limit).select(
        "product_name", "category", "brand", "total_orders", "total_sold", "avg_price", "last_order_date")


def order_sequence(t, as_of, days: int = 60, limit: int = 50) -> DataFrame:
    """First orders by user and time with their neighbours.

    The answer is a prefix of the sorted rows, so the neighbours lie in the prefix extended by one row; only the
    order counts of the users in it need another pass.
    """
    recent = t.orders.filter(span("created_at", days_before(as_of, days), as_of)).select("user_id", "created_at", "order_id")
    prefix = materialize(recent.orderBy("user_id", "created_at", "order_id").limit(limit + 1))
    per_user = Window.partitionBy("user_id").orderBy("created_at", "order_id")
    sequenced = prefix.select(
        "user_id", "created_at", "order_id",
        F.lag("created_at").over(per_user).alias("prev_order"),
        F.lead("created_at").over(per_user).alias("next_order"),
        F.row_number().over(per_user).alias("order_sequence"),
    ).orderBy("user_id", "created_at", "order_id").limit(limit)
    counts = recent.join(F.broadcast(sequenced.select("user_id").distinct()), "user_id", "left_semi").groupBy(
        "user_id").agg(F.count("*").alias("total_user_orders"))
    return sequenced.join(counts, "user_id").orderBy("user_id", "created_at", "order_id").select(
        "user_id", "created_at", "prev_order", "next_order", "order_sequence", "total_user_orders")


def monthly_growth(t, as_of, months: int = 6) -> DataFrame:
    monthly = sales_lines(t, months_before(as_of, months), as_of).groupBy(month_of("ordered_at").alias("month")).agg(
        F.sum(line_value()).alias("monthly_revenue"), F.countDistinct("order_id").alias("monthly_orders"))
    by_month = Window.orderBy("month")  # over one row per month
    return monthly.withColumn("prev_month_revenue", F.lag("monthly_revenue").over(by_month)).withColumn(
        "growth_rate", growth_rate(F.col("monthly_revenue"), F.col("prev_month_revenue"))
    ).filter(F.col("growth_rate").isNotNull()).select(
        "month", "monthly_revenue", "monthly_orders", "prev_month_revenue", "growth_rate").orderBy(F.desc("month"))


def price_stats(t, min_products: int = 10, approx: bool = False) -> DataFrame:
    """Price distribution per category with more than `min_products` products; `approx` takes percentiles by sketch."""
    products = t.products.select("category_id", "price").filter(F.col("category_id").isNotNull())
    stats = products.groupBy("category_id").agg(
        F.count("*").alias("product_count"), F.avg("price").alias("avg_price"), F.stddev_samp("price").alias("price_stddev"),
        F.min("price").alias("min_price"), F.max("price").alias("max_price"),
    ).filter(F.col("product_count") > min_products)
    wanted = {"median_price": 0.5, "p95_price": 0.95}
    middle = group_percentiles(products, ["category_id"], "price", wanted) if not approx else products.groupBy(
        "category_id").agg(*(F.percentile_approx("price", p).alias(name) for name, p in wanted.items()))
    return name_categories(t, stats.join(middle, "category_id")).select(
        "category", "product_count", "avg_price", "price_stddev", "median_price", "p95_price", "min_price", "max_price",
    ).orderBy(F.desc("avg_price"), "category")


def product_stats(t) -> DataFrame:
    """Every product with the quantity and revenue of its sold lines."""
    sums = sales_lines(t, statuses=SOLD).groupBy("product_id").agg(
        F.sum("quantity").alias("total_sold"), F.sum("total_price").alias("total_revenue"))
    return (
        t.products.join(t.categories.select("category_id", F.col("name").alias("category_name")), "category_id", "left")
        .join(t.brands.select("brand_id", F.col("name").alias("brand_name")), "brand_id", "left")
        .join(sums, "product_id", "left")
        .select("product_id", "name", "category_name", "brand_name", "price", "rating", "rating_count", "stock_quantity",
                F.coalesce("total_sold", F.lit(0)).alias("total_sold"),
                F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"))
    )


def recommendation_score(t, pairs: DataFrame) -> DataFrame:
    """Score of (user, product) pairs: rating 40 %, popularity 40 %, liking of the user's categories 20 %.

    The liking depends on the user alone (average sales of all products in the categories bought from), so it is
    computed once per user from sums per category; each part is kept to four decimals.
    """
    fixed = "decimal(10,4)"
    sold = sales_lines(t, statuses=SOLD).groupBy("product_id").agg(F.sum("quantity").alias("_sold"))
    stats = t.products.select("product_id", "category_id", "rating", "rating_count").join(sold, "product_id", "left").withColumn(
        "_sold", F.coalesce("_sold", F.lit(0)))
    parts = stats.select(
        "product_id",
        F.coalesce(F.col("rating") * F.col("rating_count") / 100.0, F.lit(0.0)).cast(fixed).alias("_rating"),
        (F.log10(F.col("_sold") + 1.0) * 2).cast(fixed).alias("_popularity"),
    )
    per_category = stats.groupBy("category_id").agg(F.sum("_sold").alias("_c_sold"), F.count("*").alias("_c_products"))
    bought = with_category(t, sales_lines(t).select("order_id", "user_id", "product_id")).select(
        "user_id", "category_id").distinct()
    liking = bought.join(per_category, "category_id").groupBy("user_id").agg(
        (F.sum("_c_sold") / F.sum("_c_products") / 10.0).cast(fixed).alias("_liking"))
    total = (
        F.col("_rating") * F.lit(0.4).cast("decimal(2,1)") + F.col("_popularity") * F.lit(0.4).cast("decimal(2,1)")
        + F.coalesce("_liking", F.lit(0).cast(fixed)) * F.lit(0.2).cast("decimal(2,1)")
    ).cast(fixed)
    scored = lookup_join(pairs.select("user_id", "product_id"), parts, "product_id", spread_by="user_id", how="left", sized_by=t.products)
    return lookup_join(scored, liking, "user_id", spread_by="product_id", how="left", sized_by=t.users).select(
        "user_id", "product_id", F.greatest(total, F.lit(0).cast(fixed)).alias("score"))


def daily_summary(t, dates: list | None = None) -> DataFrame:
    """Totals of the sold orders of a day, with the category and the product of the highest quantity in all its orders.

    Days that are asked for by `dates` each have a row; without orders it has zero counts and no sums, so that an upsert
    clears a day whose orders are gone.
    """
    orders = t.orders
    if dates is not None:
        days = [F.lit(str(d)).cast("date") for d in dates]
        orders = orders.filter(F.to_date("order_date").isin(*days))
    orders = orders.select("order_id", "user_id", "status", "total_amount", F.to_date("order_date").alias("summary_date"))
    sold = F.col("status").isin(*SOLD)
    totals = orders.groupBy("summary_date").agg(
        count_if(sold).alias("total_orders"),
        F.sum(F.when(sold, F.col("total_amount"))).alias("total_revenue"),
        F.countDistinct(F.when(sold, F.col("user_id"))).alias("unique_customers"),
        F.avg(F.when(sold, F.col("total_amount"))).alias("avg_order_value"),
    )
    per_product = t.order_items.select("order_id", "product_id", "quantity").join(
        orders.select("order_id", "summary_date"), "order_id").groupBy("summary_date", "product_id").agg(
        F.sum("quantity").alias("_sold"))
    # Most sold first, then the smaller key: the minimum of (-quantity, key), combined map-side.
    best = lambda key: F.min(F.struct((-F.col("_sold")).alias("n"), F.col(key).alias("k")))["k"]
    top_product = per_product.filter(F.col("product_id").isNotNull()).groupBy("summary_date").agg(
        best("product_id").alias("top_product"))
    per_category = per_product.join(t.products.select("product_id", "category_id"), "product_id").groupBy(
        "summary_date", "category_id").agg(F.sum("_sold").alias("_sold"))
    top_category = name_categories(t, per_category).groupBy("summary_date").agg(best("category").alias("top_category"))
    if dates is not None:
        asked = t.orders.sparkSession.createDataFrame([(str(d),) for d in dict.fromkeys(dates)], "d string").select(
            F.col("d").cast("date").alias("summary_date"))
        zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
        totals = asked.join(totals, "summary_date", "left").select(
            "summary_date", zero("total_orders"), "total_revenue", zero("unique_customers"), "avg_order_value")
    return totals.join(top_category, "summary_date", "left").join(top_product, "summary_date", "left").select(
        "summary_date", "total_orders", "total_revenue", "unique_customers", "avg_order_value", "top_category", "top_product")
