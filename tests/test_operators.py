import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from storeglass.functions.exprs import chance, exact_round, growth_rate, in_month, moment, months_before, percent_of_sum
from storeglass.operators.lookup import lookup_join
from storeglass.operators.percentiles import group_percentiles
from storeglass.operators.quality import cascade_delete, check_fk, check_not_null, check_rules, check_unique, fill_defaults
from storeglass.operators.ranking import global_positions, group_positions, probe_ranks, top_per_group

few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def hot_rows(n=600, seed=1):
    """A third of the rows in one group, another third with one value."""
    rng = random.Random(seed)
    return [(i, "hot" if i % 3 == 0 else f"g{rng.randrange(9)}", 5.0 if i % 3 == 1 else round(rng.random() * 50, 2))
            for i in range(n)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(hot_rows(), "id long, grp string, val double").repartition(6)


@few
@given(values=st.lists(st.integers(-5, 5), min_size=1, max_size=60))
def test_positions_equal_row_number(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id long, val long").repartition(3)
    got = {r.id: r.position for r in global_positions(df, [F.desc("val"), F.asc("id")]).collect()}
    order = sorted(range(len(values)), key=lambda i: (-values[i], i))
    assert got == {i: p + 1 for p, i in enumerate(order)}


def test_group_positions_equal_row_number_with_hot_and_null_groups(spark, rows):
    df = rows.withColumn("grp", F.when(F.col("grp") != "g1", F.col("grp")))
    got = group_positions(df, ["grp"], [F.desc("val"), F.asc("id")])
    want = df.withColumn("position", F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("val"), "id")))
    assert got.select("id", "position").exceptAll(want.select("id", "position")).count() == 0
    assert got.count() == want.count()


def test_probe_ranks_equal_rank(rows):
    ranked = rows.withColumn("r", F.rank().over(Window.partitionBy("grp").orderBy(F.desc("val"))))
    probes = rows.filter("id % 50 < 3").select("grp", "val")
    got = {(r.grp, r.val): r.rank for r in probe_ranks(probes, rows, "grp", "val", "rank").collect()}
    want = {(r.grp, r.val): r.r for r in ranked.join(probes.distinct(), ["grp", "val"]).collect()}
    assert got == want


def test_top_per_group_is_cut_before_the_shuffle(rows):
    top = top_per_group(rows, ["grp"], [F.desc("val"), F.asc("id")], 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("WindowGroupLimit") < plan.rindex("Exchange")
    second = top_per_group(rows, ["grp"], [F.desc("val"), F.asc("id")], 1, skip=1)
    assert {r.id for r in second.collect()} == {r.id for r in top.collect() if r["rank"] == 2}


@pytest.mark.parametrize("weighted", [False, True])
def test_percentiles_equal_interpolation(rows, weighted):
    df = rows.withColumn("w", (F.col("id") % 3 + 1).cast("int"))
    got = {r.grp: (r.p50, r.p95) for r in group_percentiles(
        df, ["grp"], "val", {"p50": 0.5, "p95": 0.95}, "w" if weighted else None).collect()}
    groups: dict = {}
    for r in df.collect():
        groups.setdefault(r.grp, []).extend([r.val] * (r.w if weighted else 1))
    assert got.keys() == groups.keys()
    for grp, values in groups.items():
        assert np.allclose(got[grp], np.percentile(values, [50, 95]))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_equals_broadcast(spark, rows, how):
    lookup = spark.createDataFrame([("hot", 1), ("g1", 2), ("g2", 3)], "grp string, code int")
    plain = lookup_join(rows, lookup, "grp", "id", how)
    salted = lookup_join(rows, lookup, "grp", "id", how, limit=-1)
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert plain.columns == salted.columns
    assert plain.exceptAll(salted).count() == 0 and plain.count() == salted.count()


def test_deep_pages_per_group_use_positions(spark, rows):
    order = [F.desc("val"), F.asc("id")]
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "3")
    try:
        deep = top_per_group(rows, ["grp"], order, 4, skip=2).select("id", "rank")
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert deep.exceptAll(top_per_group(rows, ["grp"], order, 4, skip=2).select("id", "rank")).count() == 0


def test_bucketed_tables_join_without_a_shuffle(spark, star):
    from storeglass.plans.sales import product_stats
    from storeglass.sources.lake import write_bucketed
    from storeglass.sources.retail import LakeTables

    write_bucketed(star.orders, "orders", "order_id", 4)
    write_bucketed(star.order_items, "order_items", "order_id", 4)
    for name in ("products", "categories", "brands"):
        getattr(star, name).write.mode("overwrite").saveAsTable(name)
    t = LakeTables(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = t.order_items.join(t.orders, "order_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    columns = [F.round(c, 4).alias(c) if c == "total_revenue" else F.col(c) for c in product_stats(t).columns]
    assert product_stats(t).select(columns).exceptAll(product_stats(star).select(columns)).count() == 0


def test_sketches_are_close(star):
    from storeglass.plans.sales import category_sales, price_stats

    exact = {r.category: r for r in category_sales(star, "2001-08-02", 400).collect()}
    for r in category_sales(star, "2001-08-02", 400, approx=True).collect():
        assert abs(r.unique_customers - exact[r.category].unique_customers) <= 0.2 * exact[r.category].unique_customers
        assert r.total_items_sold == exact[r.category].total_items_sold
    exact = {r.category: r for r in price_stats(star).collect()}
    for r in price_stats(star, approx=True).collect():
        assert abs(r.median_price - exact[r.category].median_price) < 2


def test_percent_and_chance(spark):
    df = spark.range(1000).select(F.col("id").alias("hit"), (F.col("id") * 3).alias("miss"))
    assert [r[0] for r in df.select(percent_of_sum("hit", "miss")).limit(2).collect()] == [None, 25.0]
    assert 150 < df.filter(chance(0.2, 3)).count() < 250
    assert df.filter(chance(1.0, 3)).count() == 1000


def test_month_arithmetic_and_rounding(spark):
    assert months_before("2024-03-31", 1) == moment("2024-02-29")
    assert months_before("2024-01-15", 13) == moment("2022-12-15")
    row = spark.range(1).select(
        exact_round(F.lit(2.675), 2).alias("half"), exact_round(F.lit(-0.125), 2).alias("minus"),
        growth_rate(F.lit(5.0), F.lit(0.0)).alias("zero"), growth_rate(F.lit(5.0), F.lit(None).cast("double")).alias("none"),
    ).first()
    assert tuple(row) == (2.68, -0.13, 0.0, 0.0)


def test_month_range_is_pushed_to_the_scan(star):
    plan = star.orders.filter(in_month("order_date", 1998, 12))._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderdate,1999-01-01" in plan


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (2, None, None), (None, "c", 3), (None, "c", 3)],
                               "k int, parent string, amount int")
    parents = spark.createDataFrame([("a",), ("c",)], "name string")
    assert [tuple(r) for r in check_unique(df, ["k"]).collect()] == [(1, 2)]
    assert [r.parent for r in check_fk(df, "parent", parents, "name").collect()] == ["b"]
    rules = {"positive": F.col("amount") >= 0, "known": F.col("parent").isin("a", "c")}
    assert {r.rule: r.violations for r in check_rules(df, rules).collect()} == {"positive": 1, "known": 1}
    assert {r.column_name: r.nulls for r in check_not_null(df, ["k", "parent"]).collect()} == {"k": 2, "parent": 1}
    assert fill_defaults(df, {"amount": 0}).filter("amount is null").count() == 0
    left = cascade_delete(df, spark.createDataFrame([(1,)], "k int"), "k")
    assert left.count() == 3
