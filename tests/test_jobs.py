"""Hand-made frames for nulls, empty sets, ties and fan-out."""

from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from storeglass.plans import behavior, charts, customers, etl, orders, recommend, sales, search, sqllog
from storeglass.sources.retail import Tables

AS_OF = "2024-07-01"
D = dt(2024, 6, 20)


def make(spark, users=(), products=(), orders=(), items=(), reviews=(), **more):
    u = spark.createDataFrame([(i, f"User {i}", f"u{i}@example.com") for i in users], "user_id long, name string, email string")
    p = spark.createDataFrame(list(products), "product_id long, name string, category_id int, brand_id int, price double, "
                              "rating double, rating_count int, stock_quantity int, is_active boolean, created_at timestamp_ntz")
    o = spark.createDataFrame(
        [(i, user, when, status, float(total), None, "paypal", when, when) for i, user, when, status, total in orders],
        "order_id long, user_id long, order_date timestamp_ntz, status string, total_amount double, shipping_address string, "
        "payment_method string, created_at timestamp_ntz, updated_at timestamp_ntz")
    li = spark.createDataFrame(
        [(n, order, product, q, float(price), q * float(price)) for n, (order, product, q, price) in enumerate(items)],
        "order_item_id long, order_id long, product_id long, quantity int, unit_price double, total_price double")
    rv = spark.createDataFrame([(n, product, stars) for n, (product, stars) in enumerate(reviews)],
                               "review_id long, product_id long, rating int")
    c = spark.createDataFrame([(1, "Toys"), (2, "Books")], "category_id int, name string")
    b = spark.createDataFrame([(1, "Acme"), (2, "Zeta")], "brand_id int, name string")
    signups = o.groupBy("user_id").agg(F.min("order_date").alias("signup_date"))
    return Tables(users=u, products=p.withColumn("description", F.col("name")), orders=o, order_items=li, product_reviews=rv,
                  categories=c, brands=b, signups=signups, **more)


def product(i, category=1, brand=1, price=10.0, active=True, day=1, rating=4.0, rated=100):
    return (i, f"Product {i}", category, brand, price, rating, rated, 5, active, dt(2024, 1, day))


def test_orders_without_items_get_an_empty_list(spark):
    t = make(spark, [1], [product(1)], [(1, 1, D, "shipped", 20), (2, 1, D, "pending", 5)], [(1, 1, 2, 10)])
    rows = {r.order_id: r["items"] for r in orders.user_orders(t, 1).collect()}
    assert rows[2] == [] and len(rows[1]) == 1 and rows[1][0].product_name == "Product 1"
    assert [r.order_id for r in orders.user_orders(t, 1, page=2, size=1).collect()] == [2]


def test_user_summary_keeps_users_without_orders_only(spark):
    t = make(spark, [1, 2, 3, 4], [], [(1, 1, D, "shipped", 20), (2, 2, D, "pending", 9), (3, 4, D, None, 7)])
    rows = {r.user_id: (r.order_count, r.total_spent) for r in customers.user_summary(t).collect()}
    assert rows == {1: (1, 20.0), 3: (0, 0.0), 4: (1, 7.0)}


def test_product_sales_keeps_products_without_lines(spark):
    t = make(spark, [1], [product(1), product(2), product(3, active=False), product(4)],
             [(1, 1, D, "shipped", 20), (2, 1, D, "pending", 20)], [(1, 1, 2, 10), (2, 2, 1, 10)])
    rows = [(r.product_id, r.times_ordered, r.total_revenue) for r in sales.product_sales(t).collect()]
    assert rows == [(1, 1, 20.0), (4, 0, None)]


def test_fan_out_of_items_and_reviews(spark):
    t = make(spark, [1], [product(1)], [(1, 1, D, "shipped", 50)], [(1, 1, 2, 10), (1, 1, 1, 30)], [(1, 5), (1, 4), (1, 3)])
    faithful = sales.product_sales_profile(t, AS_OF).first()
    single = sales.product_sales_profile(t, AS_OF, dedup_fanout=True).first()
    assert (faithful.total_quantity_sold, faithful.total_revenue, faithful.review_count) == (9, 150.0, 6)
    assert (single.total_quantity_sold, single.total_revenue, single.review_count) == (3, 50.0, 3)
    assert faithful.avg_product_rating == 4.0 and faithful.median_order_value == 25.0


def test_customer_totals_count_an_order_per_item_or_once(spark):
    t = make(spark, [1], [product(1), product(2), product(3)], [(1, 1, D, "shipped", 100)], [(1, 1, 1, 1), (1, 2, 1, 1), (1, 3, 1, 1)])
    assert customers.top_customers(t, AS_OF).first().total_spent == 300.0
    assert customers.top_customers(t, AS_OF, dedup_fanout=True).first().total_spent == 100.0


def test_customer_ranks_agree_for_both_ways(spark):
    placed = [(i, i, D, "shipped", 100 if i % 3 else 50 + i) for i in range(40)]
    t = make(spark, range(40), [product(1)], placed, [(i, 1, 1 + i % 4, 10) for i in range(40)])
    few = {r.user_id: (r.value_rank, r.spending_rank) for r in customers.top_customers(t, AS_OF, limit=40).collect()}
    many = {r.user_id: (r.value_rank, r.spending_rank) for r in customers.top_customers(t, AS_OF, limit=400).collect()}
    assert few == many and sorted(r[1] for r in few.values()) == list(range(1, 41))


def test_growth_without_positive_previous_value_is_zero(spark):
    t = make(spark, [1], [product(1)], [(1, 1, dt(2024, 4, 1), "shipped", 0), (2, 1, dt(2024, 5, 1), "shipped", 9), (3, 1, dt(2024, 6, 1), "shipped", 9)],
             [(1, 1, 1, 0), (2, 1, 1, 10), (3, 1, 1, 15)])
    assert [r.growth_rate for r in sales.monthly_growth(t, AS_OF).collect()] == [50.0, 0.0, 0.0]


def test_cohort_month_comes_from_all_history(spark):
    t = make(spark, [1], [product(1)], [(1, 1, dt(2021, 1, 5), "shipped", 1), (2, 1, dt(2024, 5, 5), "shipped", 1)], [(1, 1, 1, 1), (2, 1, 1, 1)])
    assert customers.cohort_retention(t, AS_OF).count() == 0  # 40 months after the first order
    t = make(spark, [1, 2], [product(1)], [(1, 1, dt(2024, 1, 5), "shipped", 1), (2, 1, dt(2024, 3, 5), "shipped", 1), (3, 2, dt(2024, 1, 9), "shipped", 1)],
             [(1, 1, 1, 1), (2, 1, 1, 1)])
    rows = {r.period_number: (r.customers, r.cohort_size, r.retention_rate) for r in customers.cohort_retention(t, AS_OF).collect()}
    assert rows == {0: (1, 2, 50.0), 2: (1, 2, 50.0)}  # the order without items does not count, its user is in the cohort


def test_category_tree_levels_and_vanishing_nodes(spark):
    tree = spark.createDataFrame([(1, "A", None), (2, "B", 1), (3, "C", 2), (4, "Old", 1), (5, "Loop", 5)],
                                 "category_id int, name string, parent_category_id int")
    old = dt(2023, 1, 1)
    t = make(spark, [1], [product(1, 3), product(2, 4), product(3, 3)], [(1, 1, D, "shipped", 1), (2, 1, old, "shipped", 1)],
             [(1, 1, 2, 10), (2, 2, 1, 10)], category_tree=tree)
    rows = {r.name: r for r in sales.category_tree(t, AS_OF).collect()}
    assert set(rows) == {"A", "B", "C"}  # Old has old orders only, Loop hangs on no root
    assert rows["C"].path == "A > B > C" and rows["C"].level == 3
    assert (rows["C"].product_count, rows["C"].order_count, rows["C"].total_revenue, rows["C"].revenue_per_product) == (2, 1, 20.0, 10.0)
    assert (rows["A"].product_count, rows["A"].total_revenue, rows["A"].min_price) == (0, 0.0, None)
    assert "C" not in {r.name for r in sales.category_tree(t, AS_OF, max_depth=2).collect()}


def test_page_is_cut_before_or_after_the_filter(spark):
    t = make(spark, products=[product(i, category=1 + i % 2, day=i) for i in range(1, 6)])
    assert orders.product_page(t, size=1, category="Toys").count() == 0  # the page holds product 5, a book
    hit = orders.product_page(t, size=1, category="Toys", mode="filter_then_page").collect()
    assert [(r.product_id, r.total_count) for r in hit] == [(4, 2)]


def test_paging_by_key_sees_every_order_once(spark, star):
    seen, last = [], -1
    while rows := orders.orders_page_after(star, last, 400).collect():
        seen += [r.order_id for r in rows]
        last = seen[-1]
    assert seen == list(range(1500))


def test_recommendation_score_of_unknown_things_is_zero(spark):
    t = make(spark, [1], [product(1), product(2, rated=0)], [(1, 1, D, "shipped", 1)], [(1, 1, 9, 1)])
    pairs = spark.createDataFrame([(1, 1), (None, 1), (1, 99), (7, 2)], "user_id long, product_id long")
    got = {(r.user_id, r.product_id): float(r.score) for r in sales.recommendation_score(t, pairs).collect()}
    # rating 4*100/100, popularity 2*log10(10), liking avg(9, 0)/10
    assert got == {(1, 1): 2.49, (None, 1): 2.4, (1, 99): 0.0, (7, 2): 0.0}


def events(spark, rows):
    return spark.createDataFrame([(n, u, p, kind, D) for n, (u, p, kind) in enumerate(rows)],
                                 "event_id long, user_id long, product_id long, event_type string, ts timestamp_ntz")


def test_affinity_fills_with_popular_unseen_products(spark):
    rows = [(1, p, "view") for p in range(1, 13)] + [(2, 1, "purchase"), (2, 2, "view")] + [(3, 1, "view")] * 3
    users = spark.createDataFrame([(1,), (2,), (3,), (4,)], "user_id long")
    got: dict = {}
    for r in recommend.affinity_recommendations(events(spark, rows), 10, users).orderBy("rank").collect():
        got.setdefault(r.user_id, []).append((r.product_id, r.score))
    assert [len(got[u]) for u in (1, 2, 3, 4)] == [10, 10, 10, 10]
    assert [p for p, _ in got[1]] == list(range(1, 11))  # ties by product
    assert got[2][:3] == [(1, 2.5), (2, 0.5), (3, 0.07)]
    assert got[4][0] == (1, 0.5) and got[3][1] == (2, 0.13)
    assert all(len({p for p, _ in recs}) == len(recs) for recs in got.values())


def test_factorisation_is_repeatable_and_ordered(spark):
    rows = [(u, p, ("view", "cart", "like", "purchase")[(u + p) % 4]) for u in range(12) for p in range(14) if (u * p) % 3]
    ratings = behavior.ratings(events(spark, rows))
    first, second = (recommend.als_recommendations(ratings, 5).orderBy("user_id", "rank").collect() for _ in range(2))
    assert [(r.user_id, r.product_id) for r in first] == [(r.user_id, r.product_id) for r in second]
    assert {r.user_id for r in first} == {r.user_id for r in ratings.collect()}
    for a, b in zip(first, first[1:]):
        assert a.user_id != b.user_id or a.score >= b.score


def test_engagement_thresholds_and_missing_users(spark):
    stats = spark.createDataFrame([(1, "purchase", 1), (1, "view", 1), (2, "like", 2), (3, "cart_add", 4), (4, "cart", 3)],
                                  "user_id long, action_type string, count long")
    users = spark.createDataFrame([(i,) for i in range(1, 6)], "user_id long")
    got = {r.user_id: (r.engagement_level, r.engagement_score) for r in behavior.engagement(stats, users=users).collect()}
    assert got == {1: ("high", 3.0), 2: ("medium", 2.0), 3: ("low", 1.0), 4: ("high", 3.0), 5: ("no_data", None)}


def test_documents_count_an_order_once_per_brand(spark):
    t = make(spark, [1], [product(1), product(2, brand=2), product(3, category=None)],
             [(1, 1, D, "shipped", 100), (2, 1, D, "shipped", 10)], [(1, 1, 1, 5), (1, 2, 2, 5), (1, 3, 1, 1), (2, 3, 1, 1)])
    docs = etl.order_documents(t, as_of=AS_OF)
    doc = docs.first()
    assert docs.count() == 1 and doc.brands == ["Acme", "Zeta"] and (doc.items_count, doc.total_quantity) == (2, 3)
    assert [i.product_id for i in doc["items"]] == [1, 2]
    assert {r.brand: r.revenue for r in charts.revenue_by_brand(docs).collect()} == {"Acme": 100.0, "Zeta": 100.0}
    slim = etl.order_documents(t, as_of=AS_OF, lists=False).first()
    assert slim.brands == doc.brands and slim.total_quantity == 3
    assert etl.order_documents(t, hwm="2024-06-20", as_of=AS_OF).count() == 0


@pytest.mark.parametrize("message,expected", [
    ("[SQL Query] SELECT 1", ("sql_query", "SELECT 1", None, None, "SELECT")),
    ("[SQL Query]  SELECT 1", ("sql_query", " SELECT 1", None, None, "OTHER")),
    ("[SQL Query] WITH a AS (SELECT 1) DELETE", ("sql_query", "WITH a AS (SELECT 1) DELETE", None, None, "OTHER")),
    ("[SQL Execution Time] 500ms", ("sql_performance", None, 500.0, "fast", None)),
    ("[SQL Execution Time] 500.01ms", ("sql_performance", None, 500.01, "medium", None)),
    ("[SQL Execution Time] 1000ms", ("sql_performance", None, 1000.0, "medium", None)),
    ("[SQL Execution Time] 1000.01ms", ("sql_performance", None, 1000.01, "slow", None)),
    ("[SQL Error] no table (took 3.00ms)", ("sql_error", None, None, "error", None)),
    ("[SQL Params] (1, 2)", ("sql_params", None, None, None, None)),
    ("something else", (None, None, None, None, None)),
])
def test_log_lines(spark, message, expected):
    line = spark.createDataFrame([(message, D)], "message string, timestamp timestamp_ntz")
    r = sqllog.parse_sql_log(line).first()
    assert (r.log_type, r.sql_query, r.execution_time_ms, r.performance_category, r.query_type) == expected


def test_log_keyword_with_leading_blanks(spark):
    line = spark.createDataFrame([("[SQL Query]  SELECT 1", D)], "message string, timestamp timestamp_ntz")
    assert sqllog.parse_sql_log(line, trim=True).first().query_type == "SELECT"


def test_search_against_plain_python(spark):
    import math
    import re
    from collections import Counter

    texts = [("red bolt", "A red bolt. Red!", ["red"]), ("blue bolt", "blue", []), ("green nut", "no colour, réd", ["nut", "red"]),
             ("red bolt", "A red bolt. Red!", ["red"])]
    docs = spark.createDataFrame([(i, n, d, g, "c", "b", 1.0) for i, (n, d, g) in enumerate(texts)],
                                 "product_id long, name string, description string, tags array<string>, category string, brand string, price double")
    words = lambda text: re.findall(r"\w+", text.lower())
    fields = [[words(n), words(d), words(" ".join(g))] for n, d, g in texts]
    want = []
    for doc in fields:
        scores = []
        for f, boost in enumerate((2.0, 1.0, 1.0)):
            column = [x[f] for x in fields if x[f]]
            mean, total = sum(map(len, column)) / len(column), 0.0
            for term in ("red", "nut"):
                tf, df = Counter(doc[f])[term], sum(term in c for c in column)
                if tf:
                    total += math.log(1 + (len(column) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(doc[f]) / mean))
            scores.append(boost * total)
        want.append(max(scores))
    got = search.search_products(docs, "Red, nut red").collect()
    assert [r.product_id for r in got] == sorted((i for i in range(4) if want[i] > 0), key=lambda i: (-round(want[i], 9), i))
    assert all(abs(r.relevance_score - want[r.product_id]) < 1e-9 and r.total_count == 3 for r in got)


def test_dashboard_sections_as_json(spark, star):
    import json

    rows = {r.section: json.loads(r.data) for r in sales.dashboard_sections(star, "2001-08-02").collect()}
    assert set(rows) == {"overview", "categories", "daily_trends", "top_products"}
    sold = [p["total_sold"] for p in rows["top_products"]]
    assert sold == sorted(sold, reverse=True) and rows["overview"]["total_orders"] == 1500


@pytest.mark.parametrize("limit", [2, 20, 300])
def test_spending_ties_go_by_id_whatever_its_type(spark, limit):
    t = make(spark, [1, 2, 3, 10], [product(1)], [(n, u, D, "shipped", 50) for n, u in enumerate([1, 2, 3, 10])],
             [(n, 1, 1, 50) for n in range(4)])
    text = lambda df: df.withColumn("user_id", F.concat(F.lit("user_"), "user_id"))
    by_text = Tables(**{**vars(t), "users": text(t.users), "orders": text(t.orders), "signups": text(t.signups)})
    for tables, ids in ((t, [1, 2, 3, 10]), (by_text, ["user_1", "user_10", "user_2", "user_3"])):
        rows = customers.top_customers(tables, AS_OF, limit=limit).collect()
        assert [(r.user_id, r.spending_rank) for r in rows] == [(i, k + 1) for k, i in enumerate(ids)][:limit]


def test_asked_day_without_orders_has_a_zero_row(spark):
    t = make(spark, [1], [product(1)], [(1, 1, D, "shipped", 20)], [(1, 1, 2, 10)])
    rows = {str(r.summary_date): tuple(r)[1:] for r in sales.daily_summary(t, ["2024-06-20", "2024-06-21"]).collect()}
    assert rows["2024-06-20"][:2] == (1, 20.0) and rows["2024-06-21"] == (0, None, 0, None, None, None)


def test_category_tree_keeps_lines_without_a_dated_order(spark):
    tree = spark.createDataFrame([(1, "Toys", None), (2, "Books", None)], "category_id int, name string, parent_category_id int")
    t = make(spark, [1], [product(1), product(2, category=2)], [(1, 1, None, "shipped", 20), (2, 1, dt(2020, 1, 1), "shipped", 9)],
             [(1, 1, 2, 10), (77, 1, 1, 5), (2, 1, 1, 9), (2, 2, 1, 9)], category_tree=tree)
    rows = [(r.name, r.product_count, r.order_count, r.total_revenue) for r in sales.category_tree(t, AS_OF).collect()]
    assert rows == [("Toys", 1, 1, 25.0)]


def test_small_joined_lookup_is_broadcast(spark, star):
    plan = etl.order_documents(star, as_of="2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "_salt" not in plan and plan.count("BroadcastHashJoin") >= 3


def test_time_steps_beyond_a_day(spark):
    log = spark.sql("SELECT timestamp_ntz'2020-01-01' + make_dt_interval(d * 10) AS log_timestamp, 1.0D AS execution_time_ms "
                    "FROM (SELECT explode(sequence(0, 150)) AS d)")
    assert sqllog.log_time_trend(log, buckets=100).count() <= 101
