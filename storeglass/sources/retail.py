"""The retail tables the jobs work on.

`Tables` is just a bag of named DataFrames. `StarTables` derives the same names from star-schema parquet files with
projections only, so filters and column pruning still reach the files. Frames are built when first asked for.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from storeglass.functions.exprs import at, translate, ACTIONS
from storeglass.sources.schemas import STAR


class Tables:
    """Named DataFrames given by the caller, e.g. Tables(orders=..., users=...)."""

    def __init__(self, **frames: DataFrame):
        self.__dict__.update(frames)


def day_after_last(df: DataFrame, column: str) -> datetime:
    """Date to count back from: the day after its latest timestamp (one row comes back to the driver)."""
    last = df.agg(F.max(column).alias("last")).first()["last"]
    return datetime(last.year, last.month, last.day) + timedelta(days=1)


class LakeTables(Tables):
    """Retail tables stored under their own names in `<root>/<name>`, or as catalog tables where no root is given."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        super().__init__()
        self._spark, self._root = spark, root

    def __getattr__(self, name: str) -> DataFrame:
        # Only called for tables not asked for before.
        if name.startswith("_"):
            raise AttributeError(name)
        if name == "signups":
            frame = self.users.select("user_id", "signup_date")
        elif name == "category_tree":
            frame = self.categories
        else:
            frame = self._spark.table(name) if self._root is None else self._spark.read.parquet(f"{self._root}/{name}")
        self.__dict__[name] = frame
        return frame


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower, upper, parts: int, **options) -> DataFrame:
    """Table of a database, read by `parts` tasks over ranges of a key column."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=options)


class StarTables(Tables):
    """Retail tables over `<root>/<name>.parquet` star-schema files."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__()
        self._spark, self._root = spark, root.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self._spark.read.schema(STAR[name]).parquet(f"{self._root}/{name}.parquet")

    @cached_property
    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        return self._read("customer").select(
            key.alias("user_id"),
            F.col("c_name").alias("name"),
            F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com")).alias("email"),
            (F.lit(18) + key % 53).cast("int").alias("age"),
            F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
            (F.col("c_acctbal") >= 0).alias("is_active"),
            F.col("c_nationkey").alias("nation_id"),
        )

    @cached_property
    def signups(self) -> DataFrame:
        """user_id, signup_date: the first order of a user. Apart from `users`, as it costs an aggregation."""
        return self.orders.groupBy("user_id").agg(F.min("order_date").alias("signup_date"))

    @cached_property
    def locations(self) -> DataFrame:
        return self._read("nation").select(F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("location"))

    # Category names in the order of their ids.
    CATEGORY_NAMES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

    @property
    def _category_id(self):
        return F.array_position(F.array(*map(F.lit, self.CATEGORY_NAMES)), F.col("p_type")).cast("int")

    @property
    def _brand_id(self):
        return F.substring_index("p_brand", "#", -1).cast("int")

    @cached_property
    def categories(self) -> DataFrame:
        return self._read("part").select(self._category_id.alias("category_id"), F.col("p_type").alias("name")).distinct()

    @cached_property
    def brands(self) -> DataFrame:
        return self._read("part").select(self._brand_id.alias("brand_id"), F.col("p_brand").alias("name")).distinct()

    @cached_property
    def category_tree(self) -> DataFrame:
        """Categories as roots, one leaf per (category, brand) below them."""
        part = self._read("part").select(
            self._category_id.alias("root"), self._brand_id.alias("brand"), "p_type", "p_brand"
        )
        roots = part.select(
            F.col("root").alias("category_id"), F.col("p_type").alias("name"), F.lit(None).cast("int").alias("parent_category_id")
        )
        leaves = part.select(
            (F.col("root") * 100 + F.col("brand")).alias("category_id"), F.col("p_brand").alias("name"),
            F.col("root").alias("parent_category_id"),
        )
        return roots.unionByName(leaves).distinct()

    @cached_property
    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        return self._read("part").select(
            key.alias("product_id"),
            F.col("p_name").alias("name"),
            F.concat_ws(" ", "p_type", "p_name").alias("description"),
            F.split("p_name", " ").alias("tags"),
            self._category_id.alias("category_id"),
            self._brand_id.alias("brand_id"),
            (self._category_id * 100 + self._brand_id).alias("tree_category_id"),
            F.col("p_retailprice").alias("price"),
            (F.col("p_size") / 10.0).alias("rating"),
            (key % 100).cast("int").alias("rating_count"),
            (F.col("p_size") * 10).alias("stock_quantity"),
            (key % 20 != 0).alias("is_active"),
            (at("1995-01-01") + F.make_dt_interval((key % 365).cast("int"))).alias("created_at"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        state, urgency = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
        status = (
            F.when(state == "F", "delivered").when(state == "O", "shipped")
            .when(urgency == "1", "processing").when(urgency == "5", "cancelled").otherwise("pending")
        )
        payment = F.when(urgency == "1", "credit_card").when(urgency == "2", "debit_card").when(
            urgency == "3", "paypal").otherwise("bank_transfer")
        return self._read("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("order_date"),
            status.alias("status"),
            F.col("o_totalprice").alias("total_amount"),
            F.lit(None).cast("string").alias("shipping_address"),
            payment.alias("payment_method"),
            F.col("o_orderdate").alias("created_at"),
            (F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 10).cast("int"))).alias("updated_at"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        """order_item_id is the sort key of a line within its order (the files have no single line id)."""
        quantity = F.col("l_quantity").cast("int")
        return self._read("lineitem").select(
            F.struct(
                F.col("l_linenumber").alias("line_no"), F.col("l_partkey").alias("product"),
                F.col("l_suppkey").alias("supplier"), quantity.alias("quantity"), F.col("l_extendedprice").alias("total"),
            ).alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            quantity.alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            F.col("l_extendedprice").alias("total_price"),
        )

    @cached_property
    def events(self) -> DataFrame:
        kinds = {"click": "cart", "signup": "like", "error": "search"}
        raw = self._read("events")
        purchase = F.col("event_type") == "purchase"
        missing = [F.lit(None).cast("string").alias(name) for name in (
            "session_id", "device", "user_agent", "ip_address", "search_query")]
        return raw.select(
            "event_id", "user_id",
            F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
            translate("event_type", kinds).alias("event_type"),
            "ts",
            F.when(purchase, (F.col("event_id") % 5 + 1).cast("int")).alias("quantity"),
            F.when(purchase, F.col("value")).alias("total_amount"),
            *missing,
        )

    @cached_property
    def user_behavior_log(self) -> DataFrame:
        return self.events.select(
            "user_id", "product_id", translate("event_type", ACTIONS).alias("action_type"), F.col("ts").alias("created_at")
        )

    @cached_property
    def product_reviews(self) -> DataFrame:
        return self.events.filter(F.col("event_type") == "like").select(
            F.col("event_id").alias("review_id"), "product_id", "user_id",
            (F.col("product_id") % 5 + 1).cast("int").alias("rating"),
        )

    @cached_property
    def sql_log(self) -> DataFrame:
        """Log lines: message plus the statement that comes along as a field."""
        raw = self._read("events")
        k = F.get_json_object("props", "$.k")
        spent = F.concat(F.lit("[SQL Execution Time] "), F.floor(F.col("value") * 4).cast("string"), F.lit(".00ms"))
        kind = F.col("event_type")
        message = (
            F.when(kind == "view", F.concat(F.lit("[SQL Query] SELECT "), k))
            .when(kind == "click", F.concat(F.lit("[SQL Query] INSERT "), k))
            .when(kind == "error", F.lit("[SQL Error] missing"))
            .otherwise(spent)
        )
        return raw.select(
            message.alias("message"), F.col("ts").alias("timestamp"), F.concat(F.lit("SELECT "), k).alias("sql_query")
        )

    @cached_property
    def search_docs(self) -> DataFrame:
        return self._read("documents").select(
            F.col("doc_id").alias("product_id"),
            F.substring_index("text", "\n", 1).alias("name"),
            F.col("text").alias("description"),
            F.array("lang").alias("tags"),
            F.col("lang").alias("category"),
            F.col("source").alias("brand"),
            F.col("n_chars").cast("double").alias("price"),
        )
