"""Order documents: one nested row per order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from storeglass.functions.exprs import at
from storeglass.operators.lookup import lookup_join
from storeglass.sources.lake import extract_since


def order_documents(t, hwm=None, as_of=None, lists: bool = True, at_mark: bool = False, without: DataFrame | None = None) -> DataFrame:
    """Documents of the orders created or changed after the mark `hwm`; all orders without a mark.

    Names are joined to the product table before it meets the lines. Lines of unknown products and orders without any
    line or without a known user give no entry, as the inner joins of the extract want it. Without `lists` the item
    lists are left out, which is enough for the charts. Orders whose order_id and latest time (`_time`) are in `without`
    are left out before anything is joined to them.
    """
    orders = extract_since(t.orders, hwm, at_mark)
    if without is not None:
        time = F.greatest("created_at", "updated_at")
        orders = orders.withColumn("_time", time).join(without, ["order_id", "_time"], "left_anti").drop("_time")
    products = t.products.select("product_id", F.col("name").alias("product_name"), "category_id", "brand_id")
    categories = t.categories.select("category_id", F.col("name").alias("category"))
    brands = t.brands.select("brand_id", F.col("name").alias("brand"))
    named = lookup_join(lookup_join(products, categories, "category_id", spread_by="product_id"),
                        brands, "brand_id", spread_by="product_id").select("product_id", "product_name", "category", "brand")
    lines = t.order_items
    if hwm is not None:
        lines = lines.join(orders.select("order_id"), "order_id", "left_semi")
    item = F.struct("order_item_id", "product_id", "product_name", "category", "brand", "quantity", "unit_price", "total_price")
    joined = lookup_join(lines, named, "product_id", spread_by="order_id", sized_by=products)
    sums = [F.count("*").cast("int").alias("items_count"), F.sum("quantity").alias("total_quantity")]
    if lists:
        values = lambda name: F.array_sort(F.array_distinct(F.transform("items", lambda i: i[name])))
        items = joined.groupBy("order_id").agg(F.array_sort(F.collect_list(item)).alias("items"), *sums).withColumns(
            {"categories": values("category"), "brands": values("brand")})
        nested = [F.transform("items", lambda i: i.dropFields("order_item_id")).alias("items")]
    else:
        values = lambda name: F.array_sort(F.collect_set(name))
        items = joined.groupBy("order_id").agg(
            *sums, values("category").alias("categories"), values("brand").alias("brands"))
        nested = []
    users = t.users.select("user_id", F.col("name").alias("user_name"), F.col("email").alias("user_email"))
    loaded = at(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()
    return (
        lookup_join(orders, users, "user_id", spread_by="order_id").join(items, "order_id")
        .select(
            "order_id", "user_id", "user_name", "user_email", "order_date", "status",
            F.col("total_amount").cast("double").alias("total_amount"), "shipping_address", "payment_method",
            "created_at", "updated_at",
            *nested, "items_count", "total_quantity", "categories", "brands",
            loaded.alias("etl_timestamp"), F.lit("postgresql").alias("etl_source"),
        )
    )


def sink_partitions(documents: DataFrame) -> DataFrame:
    """Partition columns of the lake: the hour a document was loaded."""
    loaded = F.col("etl_timestamp")
    return documents.select(
        "*", F.year(loaded).alias("year"), F.month(loaded).alias("month"), F.dayofmonth(loaded).alias("day"),
        F.hour(loaded).alias("hour"))
