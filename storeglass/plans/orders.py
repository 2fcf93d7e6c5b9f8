"""Order jobs: pages, lookups, totals and the equivalent forms of one question."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from storeglass.functions.exprs import SOLD, SOLD_OR_COMPLETED, all_of, at, in_month, in_year, months_before, span
from storeglass.operators.lookup import enrich_rows, is_small, lookup_join
from storeglass.operators.ranking import global_positions, group_positions, top_per_group

ORDER_COLUMNS = ["order_id", "user_id", "order_date", "status", "total_amount", "payment_method", "created_at", "updated_at"]


def status_breakdown(t) -> DataFrame:
    """Orders per status next to the number of all orders."""
    per_status = t.orders.groupBy("status").agg(F.count("*").alias("count"))
    # A window over one row per status: bounded by the allowed statuses.
    return per_status.withColumn("total_orders", F.sum("count").over(Window.partitionBy()))


def _item_lists(t, orders: DataFrame, fields: list[Column]) -> DataFrame:
    """Items of the given orders as one sorted list per order (order_id, items)."""
    lines = t.order_items.join(orders.select("order_id"), "order_id")
    lines = lookup_join(lines, t.products.select("product_id", F.col("name").alias("product_name"), "category_id"),
                        "product_id", spread_by="order_id", how="left")
    item = F.struct(F.col("order_item_id"), *fields)
    return lines.filter(F.col("product_id").isNotNull()).groupBy("order_id").agg(
        F.array_sort(F.collect_list(item)).alias("items")
    ).withColumn("items", F.transform("items", lambda i: i.dropFields("order_item_id")))


def user_orders(t, user_id=None, page: int = 1, size: int = 20, status: str | None = None) -> DataFrame:
    """A page of a user's orders, newest first, each with its item list; without user_id the page of every user."""
    chosen = t.orders.filter(all_of(
        None if user_id is None else F.col("user_id") == F.lit(user_id),
        None if not status else F.col("status") == F.lit(status),
    ))
    newest = [F.desc("order_date"), F.asc("order_id")]
    paged = top_per_group(chosen, ["user_id"], newest, size, skip=(page - 1) * size).drop("rank")
    items = _item_lists(t, paged, [F.col(c) for c in ("product_id", "product_name", "quantity", "unit_price", "total_price")])
    return paged.join(items, "order_id", "left").select(
        "user_id", "order_id", "order_date", "status", "total_amount", "shipping_address", "payment_method",
        F.coalesce("items", F.array().cast(items.schema["items"].dataType)).alias("items"),
    )


def product_page(
    t, page: int = 1, size: int = 20, category: str | None = None, brand: str | None = None,
    min_price: float | None = None, max_price: float | None = None, mode: str = "page_then_filter",
) -> DataFrame:
    """Page of active products, newest first.

    `page_then_filter` cuts the page first and counts within it, `filter_then_page` filters first and counts all hits.
    """
    active = t.products.filter(all_of(
        F.col("is_active"),
        None if min_price is None else F.col("price") >= F.lit(min_price),
        None if max_price is None else F.col("price") <= F.lit(max_price),
    ))
    named = lambda df: df.join(t.categories.withColumnRenamed("name", "category"), "category_id").join(
        t.brands.withColumnRenamed("name", "brand"), "brand_id").filter(all_of(
            None if not category else F.col("category") == F.lit(category),
            None if not brand else F.col("brand") == F.lit(brand)))
    newest = [F.desc("created_at"), F.asc("product_id")]
    cut = lambda df: df.orderBy(*newest).offset((page - 1) * size).limit(size)
    columns = [c for c in t.products.columns if c in (
        "product_id", "name", "description", "price", "rating", "stock_quantity", "category_id", "brand_id", "created_at")]
    if mode == "page_then_filter":
        # At most `size` rows are counted by this window.
        out = named(cut(active.select(*columns))).withColumn("total_count", F.count("*").over(Window.partitionBy()))
    elif mode == "filter_then_page":
        hits = named(active.select(*columns))
        out = cut(hits).withColumn("total_count", hits.agg(F.count("*")).scalar())
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return out.select("product_id", "name", "description", "price", "rating", "stock_quantity", "category", "brand",
                      "created_at", "total_count").orderBy(*newest)


def purchase_history(t, as_of, user_id=None, months: int = 6, details: bool = False, limit: int = 50) -> DataFrame:
    """The latest sold orders of a user (or of each user) with the number of their items, optionally the items."""
    sold = t.orders.filter(all_of(
        span("order_date", months_before(as_of, months), as_of),
        F.col("status").isin(*SOLD_OR_COMPLETED),
        None if user_id is None else F.col("user_id") == F.lit(user_id),
    ))
    latest = top_per_group(sold, ["user_id"], [F.desc("order_date"), F.asc("order_id")], limit)
    latest = latest.select("user_id", "order_id", "order_date", "status", "total_amount")
    if not details:
        sizes = t.order_items.join(latest.select("order_id"), "order_id").groupBy("order_id").agg(
            F.count("*").alias("item_count"))
        return latest.join(sizes, "order_id", "left").withColumn("item_count", F.coalesce("item_count", F.lit(0)))
    lines = t.order_items.join(latest, "order_id")
    lines = lookup_join(lines, t.products.select("product_id", F.col("name").alias("product_name"), "category_id"),
                        "product_id", spread_by="order_id", how="left")
    lines = lines.join(F.broadcast(t.categories.withColumnRenamed("name", "category")) if is_small(t.categories)
                       else t.categories.withColumnRenamed("name", "category"), "category_id", "left")
    item = F.struct("order_item_id", "product_name", "category", "quantity", "unit_price")
    known = F.col("category").isNotNull() & F.col("product_name").isNotNull()
    return (
        lines.groupBy("user_id", "order_id", "order_date", "status", "total_amount")
        .agg(F.count("*").alias("item_count"), F.array_sort(F.collect_list(F.when(known, item))).alias("items"))
        .filter(F.size("items") > 0)
        .withColumn("items", F.transform("items", lambda i: i.dropFields("order_item_id")))
    )


def orders_in_range(t, start, end, statuses=SOLD, limit: int = 1000) -> DataFrame:
    """Latest orders of a period in the given statuses."""
    return (
        t.orders.filter(span("order_date", start, end) & F.col("status").isin(*statuses))
        .orderBy(F.desc("order_date"), F.asc("order_id")).limit(limit)
        .select("user_id", "order_date", "status", "total_amount")
    )


def latest_by_status(t, status: str, limit: int = 1000, since=None) -> DataFrame:
    """Latest orders of a status. With `since`, a month-partitioned layout is read from that month on only."""
    wanted = F.col("status") == F.lit(status)
    if since is not None:
        wanted = wanted & span("created_at", since)
        if "order_month" in t.orders.columns:
            wanted = wanted & (F.col("order_month") >= F.trunc(at(since).cast("date"), "MM"))
    return (
        t.orders.filter(wanted).orderBy(F.desc("created_at"), F.asc("order_id")).limit(limit)
        .select("order_id", "user_id", "status", "total_amount", "created_at")
    )


def write_orders_by_month(orders: DataFrame, path: str) -> None:
    """Month-partitioned layout for date-bounded reads; one shuffle by month, hot months are split by AQE."""
    monthly = orders.withColumn("order_month", F.trunc(F.to_date("created_at"), "MM"))
    monthly.hint("rebalance", "order_month").write.mode("overwrite").partitionBy("order_month").parquet(path)


def month_totals(t, year: int, month: int, form: str = "range") -> DataFrame:
    """Number and average amount of a month's orders; both forms agree, only the range reaches the scan."""
    if form == "range":
        chosen = in_month("order_date", year, month)
    elif form == "date_part":
        chosen = (F.year("order_date") == year) & (F.month("order_date") == month)
    else:
        raise ValueError(f"unknown form {form!r}")
    return t.orders.filter(chosen).agg(F.count("*").alias("count"), F.avg("total_amount").alias("avg_amount"))


PAGE_COLUMNS = ["order_id", "user_id", "order_date", "total_amount", "status"]


def orders_page_offset(t, page: int, limit: int = 20, direct: int = 100_000) -> DataFrame:
    """Orders page by offset. Beyond `direct` skipped rows the page is cut out of distributed positions, as the
    skipped rows of an ordered offset would all pass through one task."""
    skip = (page - 1) * limit
    rows = t.orders.select(*PAGE_COLUMNS)
    if skip + limit <= direct:
        return rows.orderBy("order_id").offset(skip).limit(limit)
    placed = global_positions(t.orders.select("order_id"), [F.asc("order_id")])
    wanted = placed.filter((F.col("position") > skip) & (F.col("position") <= skip + limit)).select("order_id")
    return enrich_rows(wanted, rows, "order_id", limit).select(*PAGE_COLUMNS).orderBy("order_id")


def key_at(t, position: int) -> DataFrame:
    """order_id of the given 1-based position: the start key for paging by key."""
    return t.orders.select("order_id").orderBy("order_id").offset(position - 1).limit(1)


def orders_page_after(t, last_id, limit: int = 20) -> DataFrame:
    """Orders page after a key. `last_id` is a value or a one-row frame such as `key_at`."""
    last = last_id.scalar() if isinstance(last_id, DataFrame) else F.lit(last_id)
    return t.orders.filter(F.col("order_id") > last).select(*PAGE_COLUMNS).orderBy("order_id").limit(limit)


def status_totals(t, year: int) -> DataFrame:
    return (
        t.orders.filter(in_year("order_date", year)).groupBy("status")
        .agg(F.count("*").alias("order_count"), F.avg("total_amount").alias("avg_amount"),
             F.sum("total_amount").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "status")
    )


def frequent_spenders(t, since, min_orders: int = 5, limit: int = 100, form: str = "pre_aggregated") -> DataFrame:
    """Users with at least `min_orders` sold orders since a date, by spending."""
    sold = t.orders.filter(F.col("status").isin(*SOLD) & span("order_date", since))
    measures = [F.count("*").alias("order_count"), F.sum("total_amount").alias("total_spent")]
    users = t.users.select("user_id", F.col("name").alias("user_name"))
    if form == "pre_aggregated":
        spenders = sold.groupBy("user_id").agg(*measures).filter(F.col("order_count") >= min_orders).join(users, "user_id")
    elif form == "join_first":
        spenders = lookup_join(sold, users, "user_id", spread_by="order_id").groupBy("user_id", "user_name").agg(*measures).filter(
            F.col("order_count") >= min_orders)
    else:
        raise ValueError(f"unknown form {form!r}")
    return spenders.select("user_id", "user_name", "order_count", "total_spent").orderBy(
        F.desc("total_spent"), "user_id").limit(limit)


def orders_by_status_since(t, status: str, since, limit: int = 100) -> DataFrame:
    return (
        t.orders.filter((F.col("status") == F.lit(status)) & span("order_date", since))
        .select("order_id", "order_date", "total_amount").orderBy("order_id").limit(limit)
    )


def pending_over(t, amount: float, limit: int = 50) -> DataFrame:
    return (
        t.orders.filter((F.col("status") == "pending") & (F.col("total_amount") > amount))
        .select(*ORDER_COLUMNS).orderBy("order_id").limit(limit)
    )


def orders_per_user(t, year: int, limit: int = 20) -> DataFrame:
    return (
        t.orders.filter(in_year("order_date", year)).groupBy("user_id").agg(F.count("*").alias("order_count"))
        .orderBy("user_id").limit(limit)
    )


JOIN_HINTS = {"hash_join": "shuffle_hash", "merge_join": "merge"}


def order_lines_with_names(t, status: str = "shipped", algorithm: str = "auto", limit: int | None = None) -> DataFrame:
    """Order lines of a status with user and product names by the join algorithm asked for.

    `nested_loop` means one lookup per row: the lookup tables are broadcast if their checked size allows, else the
    planner chooses; an all-pairs product is never planned for an equality.
    """
    users = t.users.select("user_id", "name")
    products = t.products.select("product_id", F.col("name").alias("product_name"))
    orders = t.orders.filter(F.col("status") == F.lit(status)).select("order_id", "user_id", "total_amount")
    if algorithm in JOIN_HINTS:
        users, products, orders = (df.hint(JOIN_HINTS[algorithm]) for df in (users, products, orders))
    elif algorithm == "nested_loop":
        users, products = (F.broadcast(df) if is_small(df) else df for df in (users, products))
    elif algorithm != "auto":
        raise ValueError(f"unknown algorithm {algorithm!r}")
    lines = t.order_items.select("order_id", "product_id")
    if algorithm == "auto":
        named = lookup_join(orders, users, "user_id", spread_by="order_id")
        lines = lookup_join(lines.join(named, "order_id"), products, "product_id", spread_by="order_id")
    else:
        lines = lines.join(orders.join(users, "user_id"), "order_id").join(products, "product_id")
    lines = lines.select("order_id", "name", "product_name", "total_amount")
    return lines if limit is None else lines.orderBy("order_id", "product_name").limit(limit)


def buyers(t, status: str = "shipped", form: str = "exists", limit: int | None = None) -> DataFrame:
    """Users with an order in a status, as EXISTS, as IN subquery or as join with DISTINCT."""
    users = t.users.select("user_id", "name")
    orders = t.orders.filter(F.col("status") == F.lit(status)).select("user_id", "order_id")
    # Keys are made distinct map-side first: a user with very many orders then counts as one row in the shuffle.
    if form == "exists":
        found = users.join(orders.select("user_id").distinct(), "user_id", "left_semi")
    elif form == "in":
        found = users.join(orders.select("user_id").distinct(), "user_id")
    elif form == "join":
        found = lookup_join(orders, users, "user_id", spread_by="order_id").select("user_id", "name").distinct()
    else:
        raise ValueError(f"unknown form {form!r}")
    return found if limit is None else found.orderBy("user_id").limit(limit)


def basic_pack(t, status: str = "shipped") -> dict[str, DataFrame]:
    """Five plain queries; the first k rows are taken by key, so that they are defined."""
    orders = t.orders.select(*ORDER_COLUMNS)
    return {
        "select": orders.orderBy("order_id").limit(1000),
        "where": orders.filter(F.col("status") == F.lit(status)).orderBy("order_id").limit(500),
        "join": lookup_join(orders, t.users.select("user_id", "name"), "user_id", spread_by="order_id").select("order_id", "name", "total_amount")
        .orderBy("order_id").limit(500),
        "group": orders.groupBy("status").agg(F.count("*").alias("count"), F.avg("total_amount").alias("avg_amount")),
        "order": orders.orderBy(F.desc("order_date"), F.asc("order_id")).limit(500),
    }


def complex_pack(t, name_prefix: str = "User") -> dict[str, DataFrame]:
    """IN subquery, rank per status, four-way join, outer join with HAVING."""
    orders = t.orders.select(*ORDER_COLUMNS)
    named = t.users.filter(F.col("name").startswith(name_prefix)).select("user_id")
    # A status may hold a large share of all orders, so its ranks come from distributed positions.
    ranked = group_positions(
        t.orders.select("order_id", "total_amount", "status"), ["status"],
        [F.desc_nulls_first("total_amount"), F.asc("order_id")], "rank",
    )
    owned = lookup_join(orders.select("order_id", "user_id"), t.users.select("user_id", "name"), "user_id", spread_by="order_id")
    lines = t.order_items.select("order_id", "order_item_id", "product_id", "quantity").join(owned, "order_id")
    lines = lookup_join(lines, t.products.select("product_id", F.col("name").alias("product_name")), "product_id",
                        spread_by="order_id")
    spent = t.orders.groupBy("user_id").agg(
        F.count("*").alias("total_orders"), F.sum("total_amount").alias("total_spent"),
        F.avg("total_amount").alias("avg_order"),
    ).filter(F.col("total_orders") > 5)
    return {
        "subquery": orders.join(named, "user_id", "left_semi").select(*ORDER_COLUMNS).orderBy("order_id").limit(100),
        "window": ranked.select("order_id", "total_amount", "rank").orderBy("order_id").limit(1000),
        "joins": lines.orderBy("order_id", "order_item_id").limit(200).select("order_id", "name", "product_name", "quantity"),
        # HAVING count > 5 rejects users without orders, so the outer join is an inner one.
        "aggregation": spent.join(t.users.select("user_id", "name"), "user_id").orderBy("user_id").limit(100)
        .select("name", "total_orders", "total_spent", "avg_order"),
    }
