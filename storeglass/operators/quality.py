"""Data-quality operators: the constraints of the tables as DataFrame checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from storeglass.operators.lookup import lookup_join

from storeglass.functions.exprs import at


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once (null keys never collide)."""
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return df.filter(present).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def check_fk(df: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Rows whose key has no parent; a null key is allowed."""
    parents = parent.select(F.col(parent_key or key).alias(key))
    other = next((c for c in df.columns if c != key), key)
    return lookup_join(df.filter(F.col(key).isNotNull()), parents, key, spread_by=other, how="left_anti")


def check_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violations per rule in one pass; a rule that gives null passes, as a CHECK does."""
    counts = df.agg(*(F.sum(F.when(~rule, 1).otherwise(0)).alias(name) for name, rule in rules.items()))
    return _as_rows(counts, list(rules), "rule", "violations")


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per column in one pass."""
    counts = df.agg(*(F.sum(F.col(c).isNull().cast("int")).alias(c) for c in columns))
    return _as_rows(counts, columns, "column_name", "nulls")


def _as_rows(counts: DataFrame, names: list[str], name: str, value: str) -> DataFrame:
    entries = F.array(*(F.struct(F.lit(n).alias(name), F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(value)) for n in names))
    return counts.select(F.inline(entries))


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def stamp_update(df: DataFrame, as_of) -> DataFrame:
    """updated_at as the row trigger sets it."""
    return df.withColumn("updated_at", at(as_of))


def cascade_delete(children: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """Children left when the given parents are removed."""
    return children.join(removed.select(key), key, "left_anti")


def table_rules() -> dict[str, dict[str, Column]]:
    """The CHECK constraints of the tables."""
    c = F.col
    return {
        "users": {"age_range": c("age").between(0, 150), "gender_known": c("gender").isin("M", "F")},
        "products": {"price_positive": c("price") >= 0, "stock_positive": c("stock_quantity") >= 0,
                     "rating_range": c("rating").between(0, 5)},
        "orders": {
            "status_known": c("status").isin("pending", "processing", "shipped", "delivered", "cancelled"),
            "amount_positive": c("total_amount") >= 0,
            "payment_known": c("payment_method").isin("credit_card", "debit_card", "paypal", "bank_transfer")},
        "order_items": {"quantity_above_zero": c("quantity") > 0, "unit_price_positive": c("unit_price") >= 0,
                        "total_price_positive": c("total_price") >= 0},
        "product_reviews": {"stars_range": c("rating").between(1, 5)},
        "user_behavior_log": {"action_known": c("action_type").isin(
            "view", "search", "cart_add", "cart_remove", "purchase", "review")},
    }
