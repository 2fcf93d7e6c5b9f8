"""SQL of the registered queries for DuckDB, on the same star tables.

The retail tables are derived in common table expressions of short names; `_sql` puts those a statement mentions in
front of it. Fractions are rounded on decimals and times written as text, as the registry does.
"""

from __future__ import annotations

import re

# The retail tables over the star tables.
VIEWS = {
    "u": """SELECT c_custkey AS user_id, c_name AS name, 'c' || c_custkey || '@example.com' AS email,
        CAST(18 + c_custkey % 53 AS INTEGER) AS age, if(c_custkey % 2 = 0, 'M', 'F') AS gender FROM customer""",
    "pt": """SELECT *, CAST(list_position(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'], p_type) AS INTEGER) AS cid,
        CAST(split_part(p_brand, '#', 2) AS INTEGER) AS bid FROM part""",
    "cat": "SELECT DISTINCT cid AS category_id, p_type AS name FROM pt",
    "br": "SELECT DISTINCT bid AS brand_id, p_brand AS name FROM pt",
    "tree": """SELECT DISTINCT cid AS category_id, p_type AS name, CAST(NULL AS INTEGER) AS parent FROM pt
        UNION SELECT DISTINCT cid * 100 + bid, p_brand, cid FROM pt""",
    "p": """SELECT p_partkey AS product_id, p_name AS name, p_type || ' ' || p_name AS description, cid AS category_id,
        bid AS brand_id, cid * 100 + bid AS leaf_id, p_retailprice AS price, p_size / 10.0::DOUBLE AS rating,
        CAST(p_partkey % 100 AS INTEGER) AS rating_count, p_size * 10 AS stock_quantity, p_partkey % 20 <> 0 AS is_active,
        TIMESTAMP '1995-01-01' + to_days(CAST(p_partkey % 365 AS INTEGER)) AS created_at FROM pt""",
    "o": """SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_date, o_orderdate AS created_at,
        o_orderdate + to_days(CAST(o_orderkey % 10 AS INTEGER)) AS updated_at, o_totalprice AS total_amount,
        CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
             WHEN o_orderpriority LIKE '1%' THEN 'processing' WHEN o_orderpriority LIKE '5%' THEN 'cancelled'
             ELSE 'pending' END AS status,
        CASE left(o_orderpriority, 1) WHEN '1' THEN 'credit_card' WHEN '2' THEN 'debit_card' WHEN '3' THEN 'paypal'
             ELSE 'bank_transfer' END AS payment_method FROM orders""",
    "li": """SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
        l_extendedprice / l_quantity AS unit_price, l_extendedprice AS total_price, l_linenumber AS line_no,
        l_suppkey AS supplier, CAST(l_quantity AS INTEGER) * (l_extendedprice / l_quantity) AS val FROM lineitem""",
    "ev": """SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id, ts,
        CASE event_type WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'like' WHEN 'error' THEN 'search' ELSE event_type END AS event_type,
        if(event_type = 'purchase', CAST(event_id % 5 + 1 AS INTEGER), NULL) AS quantity,
        if(event_type = 'purchase', value, NULL) AS total_amount FROM events""",
    "beh": """SELECT user_id, product_id, ts AS created_at, event_id,
        CASE event_type WHEN 'cart' THEN 'cart_add' WHEN 'like' THEN 'review' ELSE event_type END AS action_type FROM ev""",
    "rv": "SELECT event_id AS review_id, user_id, product_id, product_id % 5 + 1 AS rating FROM ev WHERE event_type = 'like'",
    "su": "SELECT user_id, min(order_date) AS signup_date FROM o GROUP BY 1",
    # Lines with their order and product.
    "ln": """SELECT li.*, o.user_id, o.order_date, o.created_at, o.status, o.total_amount, p.category_id, p.brand_id,
        p.name AS product_name FROM li JOIN o USING (order_id) JOIN p USING (product_id)""",
    "aff": "SELECT user_id, product_id, sum(CASE event_type WHEN 'cart' THEN 3 WHEN 'like' THEN 4 WHEN 'purchase' THEN 5 ELSE 1 END) AS w, count(*) AS n FROM ev GROUP BY ALL",
    "pop": "SELECT product_id, sum(n) AS n, row_number() OVER (ORDER BY sum(n) DESC, product_id) AS prank FROM aff GROUP BY 1",
    "rec": """SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY own DESC, pos) AS BIGINT) AS rank, product_id, score
        FROM (SELECT user_id, 1 AS own, row_number() OVER (PARTITION BY user_id ORDER BY w DESC, product_id) AS pos,
                     product_id, least(5.0, w / 2) AS score FROM aff
              UNION ALL
              SELECT q.user_id, 0, prank, pop.product_id, least(4.0, n / 15)
              FROM (SELECT DISTINCT user_id FROM aff) q, pop
              WHERE NOT EXISTS (FROM aff a WHERE a.user_id = q.user_id AND a.product_id = pop.product_id))
        QUALIFY rank <= 10""",
    "lg": """SELECT ts, CASE event_type
            WHEN 'view' THEN '[SQL Query] SELECT ' || k WHEN 'click' THEN '[SQL Query] INSERT ' || k
            WHEN 'error' THEN '[SQL Error] missing'
            ELSE '[SQL Execution Time] ' || CAST(floor(value * 4) AS BIGINT) || '.00ms' END AS message, 'SELECT ' || k AS given
        FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)""",
    "pl": """SELECT message, ts AS log_timestamp,
        CASE WHEN message LIKE '[SQL Query]%' THEN 'sql_query' WHEN message LIKE '[SQL Error]%' THEN 'sql_error' ELSE 'sql_performance' END AS log_type,
        if(message LIKE '[SQL Query]%', message[13:], given) AS sql_query, CAST(NULL AS VARCHAR) AS sql_params,
        if(message LIKE '[SQL Exec%', CAST(regexp_extract(message, '([0-9.]+)ms', 1) AS DOUBLE), NULL) AS execution_time_ms,
        if(message LIKE '[SQL Error]%', message[13:], NULL) AS error_message,
        CASE WHEN log_type = 'sql_error' THEN 'error' WHEN execution_time_ms > 1000 THEN 'slow' WHEN execution_time_ms > 500 THEN 'medium'
             WHEN execution_time_ms IS NOT NULL THEN 'fast' END AS performance_category,
        split_part(sql_query, ' ', 1) AS query_type FROM lg""",
    # Order documents, flat: one row per document.
    "doc": """SELECT o.order_id, any_value(o.user_id) AS user_id, any_value(u.name) AS user_name, any_value(u.email) AS user_email,
        any_value(o.order_date) AS order_date, any_value(o.status) AS status, any_value(o.total_amount) AS total_amount,
        any_value(o.payment_method) AS payment_method, any_value(o.created_at) AS created_at, any_value(o.updated_at) AS updated_at,
        string_agg(concat_ws(':', li.product_id, p.name, cat.name, br.name, li.quantity), '|'
                   ORDER BY line_no, li.product_id, supplier, quantity, total_price) AS items,
        CAST(count(*) AS INTEGER) AS items_count, CAST(sum(li.quantity) AS BIGINT) AS total_quantity,
        list_sort(list(DISTINCT cat.name)) AS categories, list_sort(list(DISTINCT br.name)) AS brands
        FROM o JOIN u USING (user_id) JOIN li USING (order_id) JOIN p USING (product_id) JOIN cat USING (category_id)
        JOIN br USING (brand_id) GROUP BY o.order_id""",
}

SOLD3 = "('shipped', 'delivered', 'completed')"


def _sql(body: str, doubles: str = "", stamps: str = "", dates: str = "", ints: str = "",
         recursive: str = "") -> str:
    """Statement with its common table expressions and the output columns written portably."""
    changes = [f"CAST(round(CAST({c} AS DECIMAL(28, 8)), 4) AS DOUBLE) AS {c}" for c in doubles.split()]
    changes += [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in stamps.split()]
    changes += [f"CAST(CAST({c} AS DATE) AS VARCHAR) AS {c}" for c in dates.split()]
    changes += [f"CAST({c} AS INTEGER) AS {c}" for c in ints.split()]
    wanted, seen = [], re.findall(r"\w+", body + recursive)
    for name in reversed(list(VIEWS)):
        if name in seen:
            wanted.insert(0, name)
            seen += re.findall(r"\w+", VIEWS[name])
    parts = [f"{name} AS ({VIEWS[name]})" for name in wanted]
    if recursive:
        parts.append(recursive)
    replace = f" REPLACE ({', '.join(changes)})" if changes else ""
    head = f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} " if parts else ""
    return f"{head}SELECT *{replace} FROM ({body})"


ORDER_COLS = "order_id, user_id, order_date, status, total_amount, payment_method, created_at, updated_at"
ORDER_KINDS = {"doubles": "total_amount", "stamps": "order_date created_at updated_at"}


def _profile(copies: str, reviews: str) -> str:
    return _sql(f"""
        WITH x AS (SELECT * FROM ln WHERE created_at >= TIMESTAMP '2001-02-02' AND created_at < TIMESTAMP '2001-08-02'),
        r AS (SELECT product_id, count(*) AS reviews, avg(rating) AS stars FROM rv GROUP BY 1),
        many AS (SELECT x.*, unnest(range({copies})) FROM x LEFT JOIN r USING (product_id))
        SELECT m.product_id, any_value(product_name) AS product_name, any_value(cat.name) AS category, any_value(br.name) AS brand,
            count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold, sum(val) AS total_revenue,
            avg(val) AS avg_order_item_value, min(created_at) AS first_order_date, max(created_at) AS last_order_date,
            count(DISTINCT user_id) AS unique_customers, count(DISTINCT date_trunc('month', created_at)) AS months_active,
            coalesce(any_value(r.stars), 0) AS avg_product_rating,
            CAST(coalesce(any_value(r.reviews), 0) * {reviews} AS BIGINT) AS review_count,
            quantile_cont(val, 0.5) AS median_order_value, quantile_cont(val, 0.95) AS p95_order_value
        FROM many m JOIN cat USING (category_id) JOIN br USING (brand_id) LEFT JOIN r USING (product_id)
        GROUP BY m.product_id ORDER BY total_revenue DESC, total_orders DESC, m.product_id LIMIT 50""",
        "total_revenue avg_order_item_value avg_product_rating median_order_value p95_order_value",
        "first_order_date last_order_date")


def _customers(spent: str, mean: str, limit: int) -> str:
    return _sql(f"""
        WITH x AS (SELECT li.product_id, li.quantity, o.*, row_number() OVER (PARTITION BY order_id) AS line
                   FROM o JOIN li USING (order_id)
                   WHERE order_date >= TIMESTAMP '2001-05-04' AND order_date < TIMESTAMP '2001-08-02' AND status IN {SOLD3}),
        m AS (SELECT user_id, count(DISTINCT order_id) AS total_orders, {spent} AS total_spent, {mean} AS avg_order_value,
                max(order_date) AS last_order_date, min(order_date) AS first_order_date,
                count(DISTINCT product_id) AS unique_products_purchased, count(DISTINCT month(order_date)) AS active_months,
                CAST(sum(quantity) AS BIGINT) AS total_items_purchased FROM x GROUP BY 1),
        s AS (SELECT *, total_spent / 1000 * 0.4::DOUBLE + total_orders * 2 * 0.3::DOUBLE + unique_products_purchased * 0.2::DOUBLE
                     + active_months * 3 * 0.1::DOUBLE AS customer_value_score FROM m)
        SELECT s.user_id, u.name, u.email, su.signup_date AS join_date, s.* EXCLUDE (user_id),
            round(CAST(total_spent / (epoch(TIMESTAMP '2001-08-02' - first_order_date) / 86400) AS DECIMAL(28, 8)), 2) AS daily_avg_spend,
            CASE WHEN last_order_date >= TIMESTAMP '2001-07-26' THEN 'highly_active' WHEN last_order_date >= TIMESTAMP '2001-07-03' THEN 'active'
                 WHEN last_order_date >= TIMESTAMP '2001-06-03' THEN 'moderate' ELSE 'inactive' END AS activity_status,
            row_number() OVER (ORDER BY customer_value_score DESC, s.user_id) AS value_rank,
            row_number() OVER (ORDER BY total_spent DESC, s.user_id) AS spending_rank,
            round(CAST(customer_value_score * 100 / max(customer_value_score) OVER () AS DECIMAL(28, 8)), 1) AS score_percentile
        FROM s JOIN u USING (user_id) JOIN su USING (user_id) ORDER BY value_rank LIMIT {limit}""",
        "total_spent avg_order_value customer_value_score daily_avg_spend score_percentile",
        "join_date last_order_date first_order_date", ints="active_months value_rank")


def _search(where: str, offset: int) -> str:
    """BM25 per field with the better field; `tags` holds the language, `name` the first 40 characters."""
    words = lambda text: f"list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    fields = {"name": (words("split_part(text, chr(10), 1)"), 2.0), "descr": (words("text"), 1.0), "tag": (words("lang"), 1.0)}
    terms = ["the", "on", "réa"]
    tf = ", ".join(f"len(list_filter({f}, lambda w: w = '{t}')) AS {f}_{i}" for f in fields for i, t in enumerate(terms))
    n = ", ".join(f"count(*) FILTER (len({f}) > 0) AS {f}_n, avg(len({f})) FILTER (len({f}) > 0) AS {f}_avg" for f in fields)
    df = ", ".join(f"count(*) FILTER ({f}_{i} > 0) AS {f}_df{i}" for f in fields for i in range(len(terms)))
    one = lambda f, i: (
        f"if({f}_{i} > 0, ln(1 + ({f}_n - {f}_df{i} + 0.5::DOUBLE) / ({f}_df{i} + 0.5::DOUBLE)) * {f}_{i} * 2.2::DOUBLE"
        f" / ({f}_{i} + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len({f}) / {f}_avg)), 0)")
    score = ", ".join(f"{boost} * ({' + '.join(one(f, i) for i in range(len(terms)))})" for f, (_, boost) in fields.items())
    return _sql(f"""
        WITH w AS (SELECT *, {', '.join(f'{text} AS {f}' for f, (text, _) in fields.items())} FROM documents),
        c AS (SELECT *, {tf} FROM w), st AS (SELECT {n}, {df} FROM c),
        hit AS (SELECT *, greatest({score}) AS relevance_score FROM c, st WHERE {where})
        SELECT doc_id AS product_id, lang AS category, source AS brand, CAST(n_chars AS DOUBLE) AS price, relevance_score,
            count(*) OVER () AS total_count
        FROM hit WHERE relevance_score > 0 ORDER BY relevance_score DESC, product_id LIMIT 20 OFFSET {offset}""",
        "price relevance_score")


def _rules(table: str, rules: dict[str, str]) -> str:
    return _sql(" UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (NOT ({test})) AS violations FROM {table}" for name, test in rules.items()))


def oracle_sql() -> dict[str, str]:
    out = {}
    out["q01_status_breakdown"] = _sql(
        "SELECT status, count(*) AS count, CAST((SELECT count(*) FROM o) AS BIGINT) AS total_orders FROM o GROUP BY 1")
    out["q02_user_orders"] = _sql("""
        WITH pg AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY order_date DESC, order_id) <= 20)
        SELECT user_id, pg.order_id, order_date, status, pg.total_amount, payment_method, li.product_id, p.name AS product_name,
            quantity, unit_price, total_price
        FROM pg LEFT JOIN li USING (order_id) LEFT JOIN p ON p.product_id = li.product_id""",
        "total_amount unit_price total_price", "order_date")
    out["q02_user_orders_page2_status"] = _sql("""
        WITH pg AS (SELECT * FROM o WHERE status = 'shipped'
                    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY order_date DESC, order_id) BETWEEN 4 AND 6)
        SELECT user_id, order_id, total_amount, (SELECT count(*) FROM li WHERE li.order_id = pg.order_id) AS items_count FROM pg""",
        "total_amount")
    page = """SELECT x.product_id, x.name, x.description, x.price, x.rating, x.stock_quantity, cat.name AS category,
        br.name AS brand, x.created_at"""
    out["q03_product_page"] = _sql(f"""
        WITH x AS (SELECT * FROM p WHERE is_active ORDER BY created_at DESC, product_id LIMIT 20)
        {page}, count(*) OVER () AS total_count FROM x JOIN cat USING (category_id) JOIN br USING (brand_id)
        WHERE cat.name = 'SMALL'""", "price rating", "created_at")
    out["q03_product_page_filtered"] = _sql(f"""
        WITH x AS (SELECT * FROM p WHERE is_active AND price >= 905)
        {page}, count(*) OVER () AS total_count FROM x JOIN cat USING (category_id) JOIN br USING (brand_id)
        WHERE cat.name = 'SMALL' ORDER BY created_at DESC, product_id LIMIT 20 OFFSET 20""", "price rating", "created_at")
    out["q04_monthly_category_growth"] = _sql("""
        WITH m AS (SELECT date_trunc('month', created_at) AS month, cat.name AS category, sum(val) AS revenue,
                     count(DISTINCT order_id) AS order_count, count(DISTINCT user_id) AS unique_customers,
                     avg(val) AS avg_order_value, stddev_samp(val) AS revenue_stddev
                   FROM ln JOIN cat USING (category_id)
                   WHERE created_at >= TIMESTAMP '2000-08-02' AND created_at < TIMESTAMP '2001-08-02' GROUP BY 1, 2),
        g AS (SELECT *, lag(revenue) OVER (PARTITION BY category ORDER BY month) AS before FROM m),
        r AS (SELECT *, if(before > 0, (revenue - before) / before * 100, 0) AS growth_rate FROM g)
        SELECT month, category, revenue, growth_rate, order_count, unique_customers, avg_order_value, revenue_stddev,
            rank() OVER (PARTITION BY month ORDER BY revenue DESC) AS revenue_rank,
            row_number() OVER (ORDER BY growth_rate DESC NULLS LAST, month DESC, category) AS growth_rank
        FROM r ORDER BY month DESC, revenue DESC, category LIMIT 100""",
        "revenue growth_rate avg_order_value revenue_stddev", dates="month", ints="revenue_rank growth_rank")
    out["q05_product_sales_profile"] = _profile("greatest(coalesce(reviews, 0), 1)",
                                                "(count(*) // greatest(coalesce(any_value(r.reviews), 0), 1))")
    out["q05_product_sales_profile_dedup"] = _profile("1", "1")
    out["q06_category_tree"] = _sql("""
        WITH hit AS (SELECT w.category_id, w.name, w.level, w.path, p.product_id, p.rating, p.price, li.val, o.order_id, o.user_id
                     FROM walk w LEFT JOIN p ON p.leaf_id = w.category_id LEFT JOIN li USING (product_id) LEFT JOIN o USING (order_id)
                     WHERE o.created_at IS NULL OR (o.created_at >= TIMESTAMP '2001-05-02' AND o.created_at < TIMESTAMP '2001-08-02')),
        s AS (SELECT category_id, name, level, path, count(DISTINCT product_id) AS product_count, count(DISTINCT order_id) AS order_count,
                coalesce(sum(val), 0) AS total_revenue, count(DISTINCT user_id) AS unique_customers, coalesce(avg(rating), 0) AS avg_rating,
                min(price) AS min_price, max(price) AS max_price, coalesce(avg(price), 0) AS avg_price FROM hit GROUP BY ALL)
        SELECT *, rank() OVER (PARTITION BY level ORDER BY total_revenue DESC) AS revenue_rank_in_level,
            lag(total_revenue) OVER (PARTITION BY level ORDER BY total_revenue DESC, category_id) AS prev_revenue_in_level,
            if(product_count > 0, total_revenue / product_count, 0) AS revenue_per_product FROM s""",
        "total_revenue avg_rating min_price max_price avg_price prev_revenue_in_level revenue_per_product",
        ints="revenue_rank_in_level",
        recursive="""walk AS (SELECT category_id, name, 1 AS level, name AS path FROM tree WHERE parent IS NULL UNION ALL
            SELECT t.category_id, t.name, walk.level + 1, walk.path || ' > ' || t.name FROM tree t JOIN walk ON t.parent = walk.category_id
            WHERE walk.level < 10)""")
    out["q07_cohort_retention"] = _sql("""
        WITH f AS (SELECT user_id, date_trunc('month', min(created_at)) AS cohort_month FROM o WHERE created_at < TIMESTAMP '1996-07-01' GROUP BY 1),
        v AS (SELECT order_id, o.user_id, cohort_month, datediff('month', cohort_month, o.created_at) AS period_number, sum(val) AS value
              FROM o JOIN f USING (user_id) JOIN li USING (order_id)
              WHERE o.created_at >= TIMESTAMP '1995-01-01' AND o.created_at < TIMESTAMP '1996-07-01' GROUP BY ALL),
        d AS (SELECT cohort_month, CAST(period_number AS INTEGER) AS period_number, count(DISTINCT user_id) AS customers, count(*) AS orders,
                sum(value) AS revenue, avg(value) AS avg_order_value, min(value) AS min_order_value, max(value) AS max_order_value
              FROM v WHERE period_number BETWEEN 0 AND 12 GROUP BY 1, 2),
        z AS (SELECT cohort_month, count(*) AS cohort_size FROM f GROUP BY 1),
        q AS (SELECT *, lag(customers) OVER (PARTITION BY cohort_month ORDER BY period_number) AS prev_period_customers
              FROM d JOIN z USING (cohort_month))
        SELECT cohort_month, period_number, customers, cohort_size,
            round(CAST(customers / cohort_size * 100 AS DECIMAL(28, 8)), 2) AS retention_rate, orders, revenue,
            avg_order_value, min_order_value, max_order_value,
            round(CAST(revenue / customers AS DECIMAL(28, 8)), 2) AS revenue_per_customer,
            round(CAST(orders / customers AS DECIMAL(28, 8)), 2) AS orders_per_customer, prev_period_customers,
            if(prev_period_customers > 0, round(CAST((customers - prev_period_customers) / prev_period_customers * 100 AS DECIMAL(28, 8)), 2), 0)
                AS period_growth_rate FROM q""",
        "retention_rate revenue avg_order_value min_order_value max_order_value revenue_per_customer orders_per_customer period_growth_rate",
        dates="cohort_month")
    out["q08_string_profile"] = _sql("""
        SELECT count(*) AS total_records, avg(CAST(substring(CAST(o.order_id AS VARCHAR), 1, 3) AS INTEGER)) AS avg_id_prefix,
            count(*) FILTER (CAST(o.created_at AS VARCHAR) LIKE '%1999%') AS year_count, max(length(u.name)) AS max_name_length,
            min(epoch(o.created_at)) AS min_timestamp, count(DISTINCT upper(left(p.name, 5))) AS unique_product_prefixes,
            count(*) FILTER (regexp_matches(CAST(CAST(unit_price AS DECIMAL(10, 2)) AS VARCHAR), '^[0-9]+\\.[0-9]{2}$')) AS exact_price_count,
            avg(if(regexp_matches(cat.name, '[aeiou]'), length(cat.name), 0)) AS avg_vowel_category_length
        FROM o JOIN u ON CAST(o.user_id AS VARCHAR) = CAST(u.user_id AS VARCHAR)
        JOIN li ON CAST(li.order_id AS VARCHAR) = CAST(o.order_id AS VARCHAR)
        JOIN p ON CAST(li.product_id AS VARCHAR) = CAST(p.product_id AS VARCHAR)
        JOIN cat ON CAST(cat.category_id AS VARCHAR) = CAST(p.category_id AS VARCHAR)
        WHERE CAST(o.created_at AS VARCHAR) NOT LIKE '%impossible_date%' AND u.email NOT LIKE '%@nonexistent.com' AND p.description IS NOT NULL""",
        "avg_id_prefix min_timestamp avg_vowel_category_length", ints="max_name_length")
    week = "created_at >= TIMESTAMP '2024-01-24' AND created_at < TIMESTAMP '2024-01-31'"
    counts = f"SELECT user_id, action_type, count(*) AS count, count(DISTINCT product_id) AS unique_products FROM beh WHERE {week} GROUP BY 1, 2"
    out["q09_behavior_counts"] = _sql(counts)
    out["q09_behavior_products"] = _sql(f"""
        SELECT user_id, b.product_id, p.name AS product_name, cat.name AS category, count(*) AS interaction_count,
            max(b.created_at) AS last_interaction, array_to_string(list_sort(list(DISTINCT action_type)), ',') AS action_types
        FROM beh b JOIN p USING (product_id) JOIN cat USING (category_id)
        WHERE b.created_at >= TIMESTAMP '2024-01-24' AND b.created_at < TIMESTAMP '2024-01-31' GROUP BY 1, 2, 3, 4
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, max(b.created_at) DESC, b.product_id) <= 10""",
        stamps="last_interaction")
    weight = "CASE action_type WHEN 'like' THEN 2 WHEN 'cart' THEN 3 WHEN 'purchase' THEN 5 ELSE 1 END"
    out["q10_engagement"] = _sql(f"""
        WITH c AS ({counts}), e AS (SELECT user_id, sum(count * {weight}) / sum(count) AS score, CAST(sum(count) AS BIGINT) AS total_actions FROM c GROUP BY 1)
        SELECT user_id, CASE WHEN score IS NULL THEN 'no_data' WHEN score >= 3 THEN 'high' WHEN score >= 2 THEN 'medium' ELSE 'low' END AS engagement_level,
            round(CAST(score AS DECIMAL(28, 8)), 2) AS engagement_score, total_actions FROM u LEFT JOIN e USING (user_id)""", "engagement_score")
    out["q10_primary_actions"] = _sql(f"""
        WITH c AS ({counts})
        SELECT user_id, action_type AS action, count, round(CAST(count / sum(count) OVER (PARTITION BY user_id) * 100 AS DECIMAL(28, 8)), 1) AS percentage
        FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count DESC, action_type) <= 3""", "percentage")
    out["q11_dashboard_overview"] = _sql(f"""
        SELECT (SELECT count(*) FROM u) AS total_users, (SELECT count(*) FROM p WHERE is_active) AS total_products,
            (SELECT count(*) FROM o) AS total_orders,
            (SELECT coalesce(sum(total_amount), 0) FROM o WHERE status IN {SOLD3}) AS total_revenue""", "total_revenue")
    out["q11_dashboard_categories"] = _sql(f"""
        SELECT cat.name AS category, count(*) AS items_sold, sum(total_price) AS revenue, avg(unit_price) AS avg_unit_price,
            count(DISTINCT user_id) AS unique_customers FROM ln JOIN cat USING (category_id)
        WHERE status IN {SOLD3} AND order_date >= TIMESTAMP '2001-05-04' AND order_date < TIMESTAMP '2001-08-02'
        GROUP BY 1 ORDER BY revenue DESC, category LIMIT 10""", "revenue avg_unit_price")
    out["q11_dashboard_daily_trends"] = _sql("""
        SELECT CAST(o.order_date AS DATE) AS order_date, count(*) AS order_count, sum(total_amount) AS daily_revenue,
            avg(total_amount) AS avg_order_value, count(DISTINCT user_id) AS unique_customers FROM o
        WHERE o.order_date >= TIMESTAMP '2001-07-03' AND o.order_date < TIMESTAMP '2001-08-02' AND status NOT IN ('cancelled', 'failed')
        GROUP BY 1 ORDER BY 1 DESC LIMIT 30""", "daily_revenue avg_order_value", dates="order_date")
    out["q11_dashboard_top_products"] = _sql(f"""
        SELECT product_id, any_value(product_name) AS product_name, any_value(cat.name) AS category, CAST(sum(quantity) AS BIGINT) AS total_sold,
            sum(total_price) AS product_revenue, count(DISTINCT order_id) AS order_frequency FROM ln JOIN cat USING (category_id)
        WHERE status IN {SOLD3} AND order_date >= TIMESTAMP '2001-07-03' AND order_date < TIMESTAMP '2001-08-02'
        GROUP BY 1 ORDER BY total_sold DESC, product_id LIMIT 5""", "product_revenue")
    history = f"""h AS (SELECT * FROM o WHERE order_date >= TIMESTAMP '2001-02-02' AND order_date < TIMESTAMP '2001-08-02' AND status IN {SOLD3}
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY order_date DESC, order_id) <= 50)"""
    out["q12_purchase_history"] = _sql(f"""
        WITH {history} SELECT user_id, order_id, order_date, status, total_amount,
            (SELECT count(*) FROM li WHERE li.order_id = h.order_id) AS item_count FROM h""", "total_amount", "order_date")
    out["q12_purchase_history_details"] = _sql(f"""
        WITH {history} SELECT user_id, order_id, total_amount, count(*) OVER (PARTITION BY order_id) AS item_count,
            p.name AS product_name, cat.name AS category, quantity, unit_price
        FROM h JOIN li USING (order_id) JOIN p USING (product_id) JOIN cat USING (category_id)""", "total_amount unit_price")
    out["q13_category_sales"] = _sql(f"""
        WITH c AS (SELECT cat.name AS category, count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_items_sold,
            sum(total_price) AS total_revenue, count(DISTINCT user_id) AS unique_customers, avg(unit_price) AS avg_unit_price,
            min(unit_price) AS min_price, max(unit_price) AS max_price FROM ln JOIN cat USING (category_id)
            WHERE status IN {SOLD3} AND order_date >= TIMESTAMP '2001-07-03' AND order_date < TIMESTAMP '2001-08-02' GROUP BY 1)
        SELECT *, round(CAST(total_revenue * 100 / sum(total_revenue) OVER () AS DECIMAL(28, 8)), 2) AS revenue_percentage,
            round(CAST(total_items_sold * 100 / sum(total_items_sold) OVER () AS DECIMAL(28, 8)), 2) AS volume_percentage,
            round(CAST(total_revenue / nullif(total_orders, 0) AS DECIMAL(28, 8)), 2) AS avg_order_value,
            row_number() OVER (ORDER BY total_revenue DESC, category) AS revenue_rank,
            row_number() OVER (ORDER BY total_items_sold DESC, category) AS volume_rank FROM c""",
        "total_revenue avg_unit_price min_price max_price revenue_percentage volume_percentage avg_order_value",
        ints="revenue_rank volume_rank")
    out["q14_top_customers"] = _customers("sum(total_amount)", "avg(total_amount)", 20)
    out["q14_top_customers_dedup"] = _customers(
        "sum(total_amount) FILTER (line = 1)", "avg(total_amount) FILTER (line = 1)", 300)
    out["q15_orders_in_range"] = _sql("""
        SELECT user_id, order_date, status, total_amount FROM o
        WHERE order_date >= TIMESTAMP '2000-01-01' AND order_date < TIMESTAMP '2000-07-01' AND status IN ('shipped', 'delivered')
        ORDER BY order_date DESC, order_id LIMIT 1000""", "total_amount", "order_date")
    out["q16_user_summary"] = _sql(f"""
        SELECT u.user_id, u.name, u.email, count(order_id) AS order_count, coalesce(sum(total_amount), 0) AS total_spent, max(order_date) AS last_order_date
        FROM u LEFT JOIN o ON o.user_id = u.user_id WHERE status IN {SOLD3} OR status IS NULL
        GROUP BY 1, 2, 3 ORDER BY total_spent DESC, u.user_id LIMIT 500""", "total_spent", "last_order_date")
    sales = lambda extra: _sql(f"""
        SELECT p.product_id, p.name, cat.name AS category, count(line_no) AS times_ordered, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
            sum(total_price) AS total_revenue, avg(unit_price) AS avg_selling_price, p.rating, p.stock_quantity
        FROM p JOIN cat USING (category_id) LEFT JOIN li ON li.product_id = p.product_id LEFT JOIN o ON o.order_id = li.order_id
        WHERE is_active AND (status IN {SOLD3} OR status IS NULL) {extra}
        GROUP BY ALL ORDER BY total_revenue DESC NULLS LAST, p.product_id LIMIT 100""", "total_revenue avg_selling_price rating")
    out["q17_product_sales"] = sales("")
    out["q17_product_sales_category"] = sales("AND cat.name = 'PROMO'")
    latest = lambda extra: _sql(f"""SELECT order_id, user_id, status, total_amount, created_at FROM o WHERE status = 'shipped' {extra}
        ORDER BY created_at DESC, order_id LIMIT 1000""", "total_amount", "created_at")
    out["q18_latest_by_status"] = latest("")
    out["q18_latest_since_by_month"] = latest("AND created_at >= TIMESTAMP '2001-01-01'")
    out["q19_month_totals_range"] = out["q19_month_totals_date_part"] = _sql(
        "SELECT count(*) AS count, avg(total_amount) AS avg_amount FROM o WHERE year(order_date) = 1998 AND month(order_date) = 6", "avg_amount")
    out["q20_page_by_offset"] = out["q20_page_by_positions"] = out["q20_page_by_key"] = _sql(
        "SELECT order_id, user_id, order_date, total_amount, status FROM o ORDER BY order_id LIMIT 20 OFFSET 780", "total_amount", "order_date")
    out["q21_status_totals"] = _sql("""SELECT status, count(*) AS order_count, avg(total_amount) AS avg_amount, sum(total_amount) AS total_revenue
        FROM o WHERE order_date >= TIMESTAMP '1998-01-01' AND order_date < TIMESTAMP '1999-01-01' GROUP BY 1""", "avg_amount total_revenue")
    out["q22_frequent_spenders_pre_aggregated"] = out["q22_frequent_spenders_join_first"] = _sql("""
        SELECT u.user_id, u.name AS user_name, count(*) AS order_count, sum(total_amount) AS total_spent FROM u JOIN o USING (user_id)
        WHERE status IN ('shipped', 'delivered') AND order_date >= TIMESTAMP '1999-01-01' GROUP BY 1, 2 HAVING count(*) >= 5
        ORDER BY total_spent DESC, user_id LIMIT 100""", "total_spent")
    out["q23_orders_by_status_since"] = _sql("""SELECT order_id, order_date, total_amount FROM o WHERE status = 'shipped'
        AND order_date >= TIMESTAMP '2000-01-01' ORDER BY order_id LIMIT 100""", "total_amount", "order_date")
    out["q23_pending_over"] = _sql(f"SELECT {ORDER_COLS} FROM o WHERE status = 'pending' AND total_amount > 100 ORDER BY order_id LIMIT 50", **ORDER_KINDS)
    out["q23_orders_per_user"] = _sql("SELECT user_id, count(*) AS order_count FROM o WHERE year(order_date) = 1998 GROUP BY 1 ORDER BY 1 LIMIT 20")
    for algorithm in ("auto", "hash_join", "merge_join", "nested_loop"):
        out[f"q24_order_lines_{algorithm}"] = _sql("""SELECT order_id, u.name, product_name, total_amount FROM ln JOIN u USING (user_id)
            WHERE status = 'shipped'""", "total_amount")
    for form in ("exists", "join", "in"):
        out[f"q25_buyers_{form}"] = _sql("SELECT user_id, name FROM u WHERE user_id IN (SELECT user_id FROM o WHERE status = 'shipped')")
    out["q26_basic_select"] = _sql(f"SELECT {ORDER_COLS} FROM o ORDER BY order_id LIMIT 1000", **ORDER_KINDS)
    out["q26_basic_where"] = _sql(f"SELECT {ORDER_COLS} FROM o WHERE status = 'shipped' ORDER BY order_id LIMIT 500", **ORDER_KINDS)
    out["q26_basic_join"] = _sql("SELECT order_id, name, total_amount FROM o JOIN u USING (user_id) ORDER BY order_id LIMIT 500", "total_amount")
    out["q26_basic_group"] = _sql("SELECT status, count(*) AS count, avg(total_amount) AS avg_amount FROM o GROUP BY 1", "avg_amount")
    out["q26_basic_order"] = _sql(f"SELECT {ORDER_COLS} FROM o ORDER BY order_date DESC, order_id LIMIT 500", **ORDER_KINDS)
    out["q27_complex_subquery"] = _sql(f"""SELECT {ORDER_COLS} FROM o WHERE user_id IN (SELECT user_id FROM u WHERE name LIKE 'Customer#0000001%')
        ORDER BY order_id LIMIT 100""", **ORDER_KINDS)
    out["q27_complex_window"] = _sql("""SELECT order_id, total_amount, row_number() OVER (PARTITION BY status ORDER BY total_amount DESC, order_id) AS rank
        FROM o ORDER BY order_id LIMIT 1000""", "total_amount")
    out["q27_complex_joins"] = _sql("""SELECT order_id, u.name, product_name, quantity FROM ln JOIN u USING (user_id)
        ORDER BY order_id, line_no, product_id, supplier, quantity, total_price LIMIT 200""")
    out["q27_complex_aggregation"] = _sql("""SELECT name, total_orders, total_spent, avg_order FROM (
        SELECT u.user_id, u.name, count(order_id) AS total_orders, sum(total_amount) AS total_spent, avg(total_amount) AS avg_order
        FROM u LEFT JOIN o USING (user_id) GROUP BY 1, 2 HAVING count(order_id) > 5 ORDER BY 1 LIMIT 100)""", "total_spent avg_order")
    out["q28_daily_sales"] = _sql("""SELECT CAST(order_date AS DATE) AS date, count(*) AS orders, sum(total_amount) AS revenue FROM o
        WHERE order_date >= TIMESTAMP '1998-01-01' GROUP BY 1 ORDER BY 1 LIMIT 100""", "revenue", dates="date")
    out["q28_top_products"] = _sql("""SELECT name, total_sold, total_revenue FROM (
        SELECT product_id, any_value(product_name) AS name, CAST(sum(quantity) AS BIGINT) AS total_sold, sum(total_price) AS total_revenue
        FROM ln WHERE status = 'delivered' GROUP BY 1 ORDER BY total_sold DESC, product_id LIMIT 20)""", "total_revenue")
    out["q28_user_behavior"] = _sql(f"""SELECT action_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users FROM beh
        WHERE {week} GROUP BY 1""")
    out["q29_recent_lines"] = _sql("""
        SELECT order_id, user_id, created_at, product_id, product_name, cat.name AS category_name, br.name AS brand_name, quantity, unit_price,
            val AS item_total,
            row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, val DESC, order_id, line_no, product_id, supplier, quantity, total_price)
                AS user_order_rank,
            count(*) OVER (PARTITION BY user_id) AS user_total_orders, avg(unit_price) OVER (PARTITION BY category_id) AS category_avg_price,
            rank() OVER (PARTITION BY category_id ORDER BY val DESC) AS item_value_rank_in_category
        FROM ln JOIN cat USING (category_id) JOIN br USING (brand_id)
        WHERE created_at >= TIMESTAMP '2001-07-03' AND created_at < TIMESTAMP '2001-08-02'
        ORDER BY created_at DESC, val DESC, order_id, line_no, product_id, supplier, quantity, total_price LIMIT 100""",
        "unit_price item_total category_avg_price", "created_at", ints="user_order_rank")
    out["q30a_hot_products"] = _sql("""SELECT product_name, category, brand, total_orders, total_sold, avg_price, last_order_date FROM (
        SELECT product_id, any_value(product_name) AS product_name, any_value(cat.name) AS category, any_value(br.name) AS brand,
            count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_sold, avg(unit_price) AS avg_price,
            max(created_at) AS last_order_date FROM ln JOIN cat USING (category_id) JOIN br USING (brand_id)
        WHERE created_at >= TIMESTAMP '2000-08-02' AND created_at < TIMESTAMP '2001-08-02'
        GROUP BY 1 HAVING count(DISTINCT order_id) > 5 ORDER BY total_sold DESC, product_id LIMIT 10)""", "avg_price", "last_order_date")
    out["q30b_order_sequence"] = _sql("""SELECT user_id, created_at, lag(created_at) OVER w AS prev_order, lead(created_at) OVER w AS next_order,
            row_number() OVER w AS order_sequence, count(*) OVER (PARTITION BY user_id) AS total_user_orders FROM o
        WHERE created_at >= TIMESTAMP '2000-08-02' AND created_at < TIMESTAMP '2001-08-02'
        WINDOW w AS (PARTITION BY user_id ORDER BY created_at, order_id) ORDER BY user_id, created_at, order_id LIMIT 50""",
        stamps="created_at prev_order next_order", ints="order_sequence")
    out["q30c_monthly_growth"] = _sql("""
        WITH m AS (SELECT date_trunc('month', o.created_at) AS month, sum(val) AS monthly_revenue, count(DISTINCT order_id) AS monthly_orders
            FROM o JOIN li USING (order_id) WHERE created_at >= TIMESTAMP '2001-02-02' AND created_at < TIMESTAMP '2001-08-02' GROUP BY 1),
        g AS (SELECT *, lag(monthly_revenue) OVER (ORDER BY month) AS prev_month_revenue FROM m)
        SELECT *, if(prev_month_revenue > 0, (monthly_revenue - prev_month_revenue) / prev_month_revenue * 100, 0) AS growth_rate FROM g""",
        "monthly_revenue prev_month_revenue growth_rate", dates="month")
    out["q30d_price_stats"] = _sql("""SELECT cat.name AS category, count(*) AS product_count, avg(price) AS avg_price, stddev_samp(price) AS price_stddev,
            quantile_cont(price, 0.5) AS median_price, quantile_cont(price, 0.95) AS p95_price, min(price) AS min_price, max(price) AS max_price
        FROM p JOIN cat USING (category_id) GROUP BY 1 HAVING count(*) > 10""",
        "avg_price price_stddev median_price p95_price min_price max_price")
    out["q31_product_stats"] = _sql("""
        WITH s AS (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS sold, sum(total_price) AS money FROM li JOIN o USING (order_id)
                   WHERE status IN ('shipped', 'delivered') GROUP BY 1)
        SELECT p.product_id, p.name, cat.name AS category_name, br.name AS brand_name, price, rating, rating_count, stock_quantity,
            coalesce(sold, 0) AS total_sold, coalesce(money, 0) AS total_revenue
        FROM p LEFT JOIN cat USING (category_id) LEFT JOIN br USING (brand_id) LEFT JOIN s USING (product_id)""", "price rating total_revenue")
    out["q32_user_stats"] = _sql("""
        WITH s AS (SELECT user_id, count(*) AS n, sum(total_amount) AS money, avg(total_amount) AS mean FROM o WHERE status IN ('shipped', 'delivered') GROUP BY 1),
        a AS (SELECT user_id, count(*) FILTER (action_type = 'view') AS v, count(*) FILTER (action_type = 'search') AS q FROM beh GROUP BY 1)
        SELECT u.user_id, u.name, u.email, signup_date, coalesce(n, 0) AS total_orders, coalesce(money, 0) AS total_spent,
            coalesce(mean, 0) AS avg_order_value, coalesce(v, 0) AS total_views, coalesce(q, 0) AS total_searches
        FROM u LEFT JOIN su USING (user_id) LEFT JOIN s USING (user_id) LEFT JOIN a USING (user_id)""",
        "total_spent avg_order_value", "signup_date")
    out["q33_recommendation_score"] = _sql("""
        WITH s AS (SELECT p.product_id, p.category_id, rating, rating_count, coalesce(sold, 0) AS sold FROM p LEFT JOIN (
                SELECT product_id, sum(quantity) AS sold FROM li JOIN o USING (order_id) WHERE status IN ('shipped', 'delivered') GROUP BY 1)
                USING (product_id)),
        k AS (SELECT category_id, sum(sold) AS sold, count(*) AS n FROM s GROUP BY 1),
        l AS (SELECT user_id, CAST(sum(k.sold) / sum(k.n) / 10 AS DECIMAL(10, 4)) AS liking
              FROM (SELECT DISTINCT user_id, category_id FROM ln) JOIN k USING (category_id) GROUP BY 1),
        pairs AS (SELECT DISTINCT user_id, product_id FROM ev UNION ALL SELECT NULL, product_id FROM p)
        SELECT pairs.user_id, pairs.product_id, CAST(coalesce(greatest(CAST(
                CAST(rating * rating_count / 100 AS DECIMAL(10, 4)) * 0.4 + CAST(log10(s.sold + 1) * 2 AS DECIMAL(10, 4)) * 0.4
                + coalesce(liking, 0) * 0.2 AS DECIMAL(10, 4)), 0), 0) AS DOUBLE) AS score
        FROM pairs LEFT JOIN s USING (product_id) LEFT JOIN l ON l.user_id = pairs.user_id""", "score")
    summary = _sql("""
        WITH d AS (SELECT CAST(order_date AS DATE) AS summary_date, status IN ('shipped', 'delivered') AS good, * FROM o),
        t AS (SELECT summary_date, count(*) FILTER (good) AS total_orders, sum(total_amount) FILTER (good) AS total_revenue,
                count(DISTINCT user_id) FILTER (good) AS unique_customers, avg(total_amount) FILTER (good) AS avg_order_value FROM d GROUP BY 1),
        c AS (SELECT CAST(order_date AS DATE) AS summary_date, cat.name AS top_category FROM ln JOIN cat USING (category_id) GROUP BY 1, 2
              QUALIFY row_number() OVER (PARTITION BY CAST(order_date AS DATE) ORDER BY sum(quantity) DESC, cat.name) = 1),
        x AS (SELECT CAST(order_date AS DATE) AS summary_date, product_id AS top_product FROM ln GROUP BY 1, 2
              QUALIFY row_number() OVER (PARTITION BY CAST(order_date AS DATE) ORDER BY sum(quantity) DESC, product_id) = 1)
        SELECT * FROM t LEFT JOIN c USING (summary_date) LEFT JOIN x USING (summary_date)""", "total_revenue avg_order_value", dates="summary_date")
    out["q34_daily_summary"] = out["s5_daily_summary_upserted"] = summary
    trend = """SELECT product_id, count(*) AS total_interactions, count(DISTINCT user_id) AS unique_users,
            count(*) FILTER (event_type = 'purchase') AS purchases,
            count(*) * 0.3::DOUBLE + count(DISTINCT user_id) * 0.5::DOUBLE + count(*) FILTER (event_type = 'purchase') * 0.2::DOUBLE AS trending_score
        FROM ev WHERE ts > TIMESTAMP '2024-01-30' AND ts < TIMESTAMP '2024-01-31' GROUP BY 1"""
    out["q35_trending"] = _sql(f"""SELECT * FROM ({trend}) ORDER BY CAST(trending_score AS DECIMAL(28, 8)) DESC, product_id LIMIT 50""", "trending_score")
    rating = """SELECT user_id, product_id, avg(CASE event_type WHEN 'cart' THEN 3 WHEN 'like' THEN 4 WHEN 'purchase' THEN 5 ELSE 1 END::DOUBLE) AS avg_rating,
            count(*) AS interaction_count, avg_rating * ln(count(*) + 1) AS final_rating FROM ev GROUP BY 1, 2"""
    out["q36_ratings"] = out["x5_recommender_stream"] = _sql(rating, "avg_rating final_rating")
    out["q38_affinity_recommendations"] = _sql("""
        SELECT user_id, CAST(rank AS INTEGER) AS rank, product_id, round(CAST(score AS DECIMAL(28, 8)), 2) AS score FROM rec UNION ALL
        SELECT user_id, CAST(prank AS INTEGER), product_id, round(CAST(least(5.0, n / 10) AS DECIMAL(28, 8)), 2) FROM u, pop
        WHERE prank <= 10 AND user_id NOT IN (SELECT user_id FROM aff)""", "score")
    out["q39_simple_trending"] = _sql("""SELECT product_id, count(*) * 2.5 AS score, count(*) AS interactions, count(DISTINCT user_id) AS unique_users,
            greatest(1, count(*) // 5) AS purchases FROM ev GROUP BY 1 ORDER BY interactions DESC, product_id LIMIT 20""", "score")
    out["q40_enriched_trending"] = _sql(f"""SELECT p.name, p.price, t.* FROM (SELECT * FROM ({trend})
        ORDER BY CAST(trending_score AS DECIMAL(28, 8)) DESC, product_id LIMIT 20) t JOIN p USING (product_id)""", "price trending_score")
    served = """SELECT user_id, product_id, p.name, p.price, round(CAST(score AS DECIMAL(28, 8)), 2) AS recommendation_score"""
    out["q40_enriched_recommendations"] = _sql(f"{served}, CAST(rank AS INTEGER) AS rank FROM rec JOIN p USING (product_id)", "price recommendation_score")
    out["s8_snapshot_served"] = _sql(f"{served} FROM rec JOIN p USING (product_id)", "price recommendation_score")
    out["q41_search_products"] = _search("true", 0)
    out["q41_search_filtered"] = _search("lang = 'en' AND n_chars BETWEEN 300 AND 5000", 20)
    out["q41_index_products"], out["q41_index_filtered"] = out["q41_search_products"], out["q41_search_filtered"]
    out["q41_search_all"] = _sql("""SELECT doc_id AS product_id, lang AS category, source AS brand, CAST(n_chars AS DOUBLE) AS price,
        CAST(1 AS DOUBLE) AS relevance_score, count(*) OVER () AS total_count FROM documents WHERE source = 'src1' ORDER BY doc_id LIMIT 20""",
        "price relevance_score")
    out["q37_als_checks"] = _sql("""SELECT count(DISTINCT user_id) AS users,
        count(DISTINCT user_id) * least(10, count(DISTINCT product_id)) AS n_rows, CAST(0 AS BIGINT) AS rank_gaps,
        CAST(0 AS BIGINT) AS rising_scores, CAST(0 AS BIGINT) AS unknown_products
        FROM ev WHERE user_id IS NOT NULL AND product_id IS NOT NULL""")
    counters = _sql("SELECT user_id, count(*) AS total_events, " + ", ".join(
        f"count(*) FILTER (event_type = '{k}') AS {k}_count" for k in ("view", "cart", "purchase", "like", "search"))
        + ", max(ts) AS last_activity FROM ev GROUP BY 1", stamps="last_activity")
    out["q42_user_counters"] = out["x8_counters_stream"] = counters
    popular = """SELECT product_id, CAST(sum(CASE event_type WHEN 'view' THEN 1 WHEN 'purchase' THEN 5 ELSE 3 END) AS DOUBLE) AS popularity_score FROM ev
        WHERE event_type IN ('view', 'purchase', 'like') GROUP BY 1"""
    out["q43_popular_products"] = _sql(f"""SELECT p.name, x.* FROM (SELECT * FROM ({popular}) ORDER BY popularity_score DESC, product_id LIMIT 20) x
        JOIN p USING (product_id)""", "popularity_score")
    out["x9_popularity_stream"] = _sql(popular, "popularity_score")
    out["q06_category_tree_fixpoint"] = out["q06_category_tree"]
    out["a3_sketched_counts"] = _sql("""SELECT strftime(order_date, '%Y-%m') AS month, category_id, count(*) AS n_lines,
        count(DISTINCT user_id) AS n_buyers, count(DISTINCT order_id) AS n_orders, count(DISTINCT product_id) AS n_products, true AS within
        FROM ln GROUP BY 1, 2""")
    out["a7_sketched_prices"] = _sql("SELECT category_id, count(*) AS lines, true AS within FROM ln GROUP BY 1")
    out["q20_page_by_key_clustered"], out["q21_status_totals_clustered"] = out["q20_page_by_key"], out["q21_status_totals"]
    out["q23_orders_by_status_clustered"] = out["q23_orders_by_status_since"]
    out["s8_snapshot_swept"] = out["s8_snapshot_served"]
    out["s6_json_sink"] = out["s7_keyed_documents"] = out["x12_lake_after_two_runs"] = _sql("""
        SELECT order_id, user_name, status, CAST(items_count AS BIGINT) AS items_count, CAST(total_quantity AS BIGINT) AS total_quantity
        FROM doc WHERE created_at < TIMESTAMP '1997-01-01' OR greatest(created_at, updated_at) >=
            (SELECT max(greatest(created_at, updated_at)) FROM doc WHERE created_at < TIMESTAMP '1997-01-01')""")
    out["s9_routed_events"] = _sql("SELECT event_type, count(*) AS n FROM ev GROUP BY 1 UNION ALL SELECT 'all', count(*) FROM ev")
    sections = [("overview", "total_revenue"), ("categories", "revenue"), ("daily_trends", "daily_revenue"), ("top_products", "product_revenue")]
    out["u1_dashboard_sections"] = _sql(" UNION ALL ".join(
        f"SELECT '{name}' AS section, count(*) AS entries, sum({figure}) AS total FROM ({out[f'q11_dashboard_{name}']})"
        for name, figure in sections), "total")
    out["a23_purchase_share"] = _sql("""SELECT user_id, 100.0 * p / nullif(p + v, 0) AS purchase_percent FROM (
        SELECT user_id, CAST(count(*) FILTER (event_type = 'purchase') AS DOUBLE) AS p, count(*) FILTER (event_type = 'view') AS v
        FROM ev GROUP BY 1)""", "purchase_percent")
    out["g3_stamped_orders"] = _sql("""SELECT order_id, created_at, TIMESTAMP '2001-08-02' AS updated_at FROM o WHERE status = 'pending'""",
                                    stamps="created_at updated_at")
    out["x10_interactions_stream"] = _sql("""SELECT user_id, product_id, n, events,
            CAST(w AS DOUBLE) AS weight FROM (
        SELECT user_id, product_id, count(*) AS n, sum(CASE event_type WHEN 'cart' THEN 3 WHEN 'like' THEN 4 WHEN 'purchase' THEN 5 ELSE 1 END) AS w
        FROM ev GROUP BY 1, 2) JOIN (SELECT user_id, count(*) AS events, max(ts) AS last FROM ev GROUP BY 1) USING (user_id)
        WHERE events >= 10 OR last + INTERVAL 1 DAY <= (SELECT max(ts) FROM ev) - INTERVAL 1 HOUR""", "weight")
    out["q44_behavior_log"] = out["x11_log_table_stream"] = _sql("""SELECT user_id, product_id, action_type, CAST(NULL AS VARCHAR) AS session_id, CAST(NULL AS VARCHAR) AS device_type,
        CAST(NULL AS VARCHAR) AS ip_address, CAST(NULL AS VARCHAR) AS user_agent, CAST(NULL AS VARCHAR) AS search_query, created_at FROM beh""", stamps="created_at")
    out["q45_purchase_orders"] = out["x11_orders_stream"] = out["x11_orders_stream_state"] = _sql("""SELECT 'order_' || event_id AS order_id, user_id, ts AS order_date, total_amount, 'pending' AS status,
        CAST(NULL AS VARCHAR) AS shipping_address, CAST(NULL AS VARCHAR) AS payment_method FROM ev WHERE event_type = 'purchase'""", "total_amount", "order_date")
    out["q45_purchase_items"] = out["x11_items_stream"] = _sql("""SELECT 'order_' || event_id AS order_id, product_id, quantity, total_amount / quantity AS unit_price,
        total_amount AS total_price FROM ev WHERE event_type = 'purchase'""", "unit_price total_price")
    out["q46_cart_upsert"] = out["x11_cart_stream"] = _sql(
        "SELECT user_id, product_id, count(*) AS quantity, max(ts) AS added_at FROM ev WHERE event_type = 'cart' GROUP BY 1, 2", stamps="added_at")
    out["q47_order_documents"] = _sql("""SELECT * REPLACE (array_to_string(categories, ',') AS categories, array_to_string(brands, ',') AS brands),
        CAST(NULL AS VARCHAR) AS shipping_address, 'postgresql' AS etl_source FROM doc""", "total_amount", "order_date created_at updated_at")
    out["q47_order_documents_since"] = _sql("""SELECT order_id, user_name, items_count, total_quantity, array_to_string(categories, ',') AS categories,
        created_at, updated_at FROM doc WHERE greatest(created_at, updated_at) > TIMESTAMP '2001-06-01'""", stamps="created_at updated_at")
    out["q48_parse_sql_log"] = _sql("""SELECT message, log_type, sql_query, sql_params, execution_time_ms, error_message, performance_category,
        query_type, log_timestamp FROM pl""", "execution_time_ms", "log_timestamp")
    out["q49a_log_by_category"] = _sql("""SELECT performance_category, count(*) AS n FROM pl WHERE performance_category IS NOT NULL GROUP BY 1
        ORDER BY n DESC, 1 LIMIT 5""")
    out["q49b_log_time_trend"] = _sql("""
        WITH x AS (SELECT CAST(floor(epoch(log_timestamp)) AS BIGINT) AS s, execution_time_ms FROM pl WHERE execution_time_ms IS NOT NULL),
        g AS (SELECT coalesce(min(step) FILTER (spread <= step * 100), 315360000) AS step FROM (SELECT max(s) - min(s) AS spread FROM x),
              (SELECT unnest([1, 5, 10, 30, 60, 300, 600, 1800, 3600, 10800, 43200, 86400, 604800, 2592000, 7776000, 31536000, 315360000]::BIGINT[]) AS step))
        SELECT make_timestamp(s // step * step * 1000000) AS bucket, avg(execution_time_ms) AS avg_ms FROM x, g GROUP BY 1""", "avg_ms", "bucket")
    out["q49c_log_by_type"] = _sql("SELECT query_type, count(*) AS n FROM pl GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")
    timed = "FROM pl WHERE execution_time_ms IS NOT NULL GROUP BY sql_query"
    out["q49d_slowest_statements"] = _sql(f"SELECT sql_query, max(execution_time_ms) AS max_ms {timed} ORDER BY max_ms DESC, 1 LIMIT 10", "max_ms")
    out["q50a_hourly_revenue"] = _sql("SELECT date_trunc('hour', order_date) AS bucket, sum(total_amount) AS revenue FROM doc GROUP BY 1", "revenue", "bucket")
    out["q50b_revenue_by_brand"] = _sql("""SELECT brand, sum(total_amount) AS revenue FROM (SELECT unnest(brands) AS brand, total_amount FROM doc)
        GROUP BY 1 ORDER BY revenue DESC, 1 LIMIT 10""", "revenue")
    out["q50c_orders_by_payment"] = _sql("SELECT payment_method, count(*) AS n FROM doc GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5")
    out["q50d_orders_by_status"] = _sql("SELECT status, count(*) AS n FROM doc GROUP BY 1 ORDER BY n DESC, 1 LIMIT 6")
    out["q50e_quantity_by_category"] = _sql("""SELECT category, CAST(sum(total_quantity) AS BIGINT) AS quantity
        FROM (SELECT unnest(categories) AS category, total_quantity FROM doc) GROUP BY 1 ORDER BY quantity DESC, 1 LIMIT 8""")
    out["q50f_revenue_24h"] = _sql("""SELECT total, CAST(total >= 50000000 AS INTEGER) + CAST(total >= 100000000 AS INTEGER) + CAST(total >= 200000000 AS INTEGER) AS band
        FROM (SELECT coalesce(sum(total_amount), 0) AS total FROM doc WHERE order_date BETWEEN TIMESTAMP '2001-08-01' AND TIMESTAMP '2001-08-02')""", "total")
    latency = f"""x AS (SELECT sql_query, avg(execution_time_ms) AS avg_ms, min(execution_time_ms) AS min_ms, max(execution_time_ms) AS max_ms,
        count(*) AS n {timed})"""
    out["q51_statement_latency"] = _sql(f"""WITH {latency} SELECT *,
        CASE WHEN avg_ms > 2 * avg(avg_ms) OVER () THEN 'slow' WHEN avg_ms < 0.5 * avg(avg_ms) OVER () THEN 'fast' END AS label,
        row_number() OVER (ORDER BY avg_ms, sql_query) = 1 AS is_fastest, row_number() OVER (ORDER BY avg_ms DESC, sql_query) = 1 AS is_slowest FROM x""",
        "avg_ms min_ms max_ms")
    out["q51_speed_up"] = _sql(f"""WITH {latency} SELECT *, round(before_ms / after_ms, 1) AS ratio FROM (
        SELECT avg(avg_ms) FILTER (sql_query = 'SELECT 1') AS before_ms, avg(avg_ms) FILTER (sql_query = 'SELECT 2') AS after_ms FROM x)""",
        "before_ms after_ms ratio")
    out["q52_slow_statements"] = _sql(f"""SELECT sql_query, count(*) AS calls, sum(execution_time_ms) AS total_ms, avg(execution_time_ms) AS mean_ms
        {timed} HAVING avg(execution_time_ms) > 100 ORDER BY mean_ms DESC, 1 LIMIT 20""", "total_ms mean_ms")
    out["d1_duplicate_lines"] = _sql("SELECT order_id, line_no, count(*) AS n FROM li GROUP BY 1, 2 HAVING count(*) > 1")
    out["d2_orders_without_items"] = _sql("SELECT order_id, user_id FROM o WHERE order_id NOT IN (SELECT order_id FROM li)")
    out["d2_event_products"] = _sql("SELECT product_id, event_id FROM ev WHERE product_id NOT IN (SELECT product_id FROM p)")
    out["d3_rules_users"] = _rules("u", {"age_range": "age BETWEEN 0 AND 150", "gender_known": "gender IN ('M', 'F')"})
    out["d3_rules_products"] = _rules("p", {"price_positive": "price >= 0", "stock_positive": "stock_quantity >= 0", "rating_range": "rating BETWEEN 0 AND 5"})
    out["d3_rules_orders"] = _rules("o", {
        "status_known": "status IN ('pending', 'processing', 'shipped', 'delivered', 'cancelled')", "amount_positive": "total_amount >= 0",
        "payment_known": "payment_method IN ('credit_card', 'debit_card', 'paypal', 'bank_transfer')"})
    out["d3_rules_order_items"] = _rules("li", {
        "quantity_above_zero": "quantity > 0", "unit_price_positive": "unit_price >= 0", "total_price_positive": "total_price >= 0"})
    out["d3_rules_product_reviews"] = _rules("rv", {"stars_range": "rating BETWEEN 1 AND 5"})
    out["d3_rules_user_behavior_log"] = _rules("beh", {
        "action_known": "action_type IN ('view', 'search', 'cart_add', 'cart_remove', 'purchase', 'review')"})
    out["d4_event_nulls"] = _sql(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c if c != 'session_id' else 'NULL'}) AS nulls FROM ev"
        for c in ("event_id", "user_id", "quantity", "total_amount", "session_id")))
    out["d5_filled_quantity"] = _sql("""SELECT event_type, CAST(sum(coalesce(quantity, 1)) AS BIGINT) AS quantity, sum(coalesce(total_amount, 0)) AS total_amount
        FROM ev GROUP BY 1""", "total_amount")
    out["d6_items_kept"] = _sql("SELECT order_id, count(*) AS n FROM li WHERE order_id NOT IN (SELECT order_id FROM o WHERE status = 'cancelled') GROUP BY 1")
    out["s4_changed_orders"] = _sql("SELECT order_id, created_at, updated_at FROM o WHERE greatest(created_at, updated_at) > TIMESTAMP '2001-06-01'",
                                    stamps="created_at updated_at")
    out["f_padded_and_shortened"] = _sql("""SELECT product_id, 'product_' || lpad(CAST(product_id AS VARCHAR), 6, '0') AS padded,
        if(length(description) > 12, left(description, 12) || '...', description) AS short FROM p""")
    windows = """SELECT x.start, x.start + INTERVAL 10 MINUTE AS "end", user_id, product_id, event_type, count(*) AS count
        FROM (SELECT unnest([time_bucket(INTERVAL 5 MINUTE, ts), time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE]) AS start, * FROM ev) x
        GROUP BY ALL"""
    out["x2_window_counts"] = _sql(windows, stamps='start "end"')
    out["x3_window_counts_stream"] = _sql(f"""SELECT * FROM ({windows}) WHERE "end" <= (SELECT max(ts) FROM ev) - INTERVAL 10 MINUTE""", stamps='start "end"')
    out["x13_log_stream"] = _sql("SELECT CAST(log_timestamp AS DATE) AS log_date, log_type, count(*) AS n FROM pl GROUP BY 1, 2", dates="log_date")
    return out
