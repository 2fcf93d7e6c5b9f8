"""Every registered query against its SQL, on whole tables."""

import pytest

from checks import compare, oracles, registry
from tests.conftest import ROOT

SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(ROOT)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, con, name):
    rows, problem = compare.compare(spark, con, name, ROOT, SQL.get(name))
    assert problem is None
    if not name.startswith("d2_event"):
        assert rows > 0


def test_only_the_factorisation_has_no_sql():
    assert set(registry.queries()) - set(SQL) == {"q37_als_recommendations"}
    assert set(SQL) <= set(registry.queries())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 6


@pytest.mark.parametrize("name", [
    "q02_user_orders", "q04_monthly_category_growth", "q06_category_tree", "q08_string_profile", "q09_behavior_products",
    "q12_purchase_history_details", "q13_category_sales", "q24_order_lines_auto", "q27_complex_joins", "q33_recommendation_score",
    "q40_enriched_recommendations", "q47_order_documents"])
def test_nothing_broadcast_gives_the_same(spark, con, name, monkeypatch):
    """The way taken on tables too large to broadcast: salted lookups, shuffled joins."""
    from storeglass.operators import lookup

    monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert compare.compare(spark, con, name, ROOT, SQL[name])[1] is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    """The tables with a third of the lines on one product, of the orders on one user, of the events on one of each."""
    folder, db = tmp_path_factory.mktemp("hot"), compare.connect(ROOT)
    changed = {
        "lineitem": "if(l_orderkey % 3 = 0, 7, l_partkey) AS l_partkey",
        "orders": "if(o_orderkey % 3 = 1, 3, o_custkey) AS o_custkey",
        "events": """if(event_id % 3 = 1, 5, user_id) AS user_id, if(event_id % 3 = 2, '{"k": 9}', props) AS props""",
    }
    for name in compare.TABLES:
        replace = f"REPLACE ({changed[name]})" if name in changed else ""
        db.execute(f"COPY (SELECT * {replace} FROM {name}) TO '{folder}/{name}.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", [
    "q02_user_orders", "q04_monthly_category_growth", "q05_product_sales_profile", "q09_behavior_products", "q14_top_customers",
    "q27_complex_window", "q29_recent_lines", "q34_daily_summary", "q35_trending", "q38_affinity_recommendations"])
def test_hot_keys(spark, hot, name, monkeypatch):
    from storeglass.operators import lookup

    monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    assert compare.compare(spark, compare.connect(hot), name, hot, SQL[name])[1] is None
