"""Every job as a query over the star tables, in a form that another engine can be compared with."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from storeglass.functions.exprs import at, days_before, exact_round, padded_id, percent_of_sum, shorten, span
from storeglass.operators import quality
from storeglass.operators.materialize import shared_folder
from storeglass.plans import behavior, charts, customers, etl, orders, recommend, sales, search, sketches, sqllog
from storeglass.plans.search_index import SearchIndex
from storeglass.sources import lake
from storeglass.sources.clustered import ClusteredTable
from storeglass.sources.retail import StarTables
from storeglass.sources.schemas import STAR
from storeglass.sources.versions import VersionedTable
from storeglass.streaming import aggregates, interactions, jobs

AS_OF = "2001-08-02"
COHORT_AS_OF = "1996-07-01"
EVENTS_AS_OF = "2024-01-31"
PAGE = 40
SEARCH = "the on réa"


def portable(df: DataFrame) -> DataFrame:
    """Flat comparable columns: times as text, fractions rounded to four digits on decimals."""
    out = []
    for field in df.schema.fields:
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            column = exact_round(column, 4)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            column = F.array_join(F.array_sort(column), ",")
        out.append(column.alias(field.name))
    return df.select(*out)


def exploded(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """One row per list entry, one row with nulls for an empty list."""
    return df.select(*keys, F.explode_outer(column).alias("_e")).select(*keys, "_e.*")


def score_pairs(t) -> DataFrame:
    seen = t.events.select("user_id", "product_id").distinct()
    return seen.unionByName(t.products.select(F.lit(None).cast("bigint").alias("user_id"), "product_id"))


def cart_in_two_steps(t) -> DataFrame:
    first = behavior.cart_upsert(None, t.events.filter(span("ts", None, "2024-01-15")))
    return behavior.cart_upsert(first, t.events.filter(span("ts", "2024-01-15")))


def documents(t) -> DataFrame:
    return etl.order_documents(t, as_of=AS_OF, lists=False)


def document_rows(t) -> DataFrame:
    d = etl.order_documents(t, as_of=AS_OF)
    items = F.array_join(F.transform("items", lambda i: F.concat_ws(
        ":", i["product_id"].cast("string"), i["product_name"], i["category"], i["brand"], i["quantity"].cast("string"))), "|")
    return d.drop("etl_timestamp").withColumn("items", items)


def documents_since(t) -> DataFrame:
    return etl.order_documents(t, hwm="2001-06-01", as_of=AS_OF).select(
        "order_id", "user_name", "items_count", "total_quantity", "categories", "created_at", "updated_at")


def _place(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/run-{uuid.uuid4().hex}"


def _stream(spark: SparkSession, root: str) -> DataFrame:
    """The event file as a stream of decoded events with a timestamp (a stream reads a single file by a glob only)."""
    raw = spark.readStream.schema(STAR["events"]).parquet(f"{root.rstrip('/')}/event[s].parquet")
    t = StarTables(spark, root)
    t._read = lambda name: raw
    return t.events.withColumn("timestamp", F.col("ts").cast("timestamp"))


def stream_windows(spark: SparkSession, root: str) -> DataFrame:
    place = _place(spark)
    counts = aggregates.windowed_counts(_stream(spark, root))
    jobs.start(counts, f"{place}/out", f"{place}/state").awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{place}/out")


def stream_counters(spark: SparkSession, root: str) -> DataFrame:
    place = _place(spark)
    running = aggregates.counters_stream(aggregates.once(_stream(spark, root)), "ts")
    jobs.counters_to_table(running, f"{place}/out", f"{place}/state", "user_id", buckets=8).awaitTermination()
    return spark.read.parquet(f"{place}/out").drop("bucket", "batch_id")


def stream_popularity(spark: SparkSession, root: str) -> DataFrame:
    place = _place(spark)
    running = aggregates.popularity_stream(aggregates.once(_stream(spark, root)))
    jobs.counters_to_table(running, f"{place}/out", f"{place}/state", "product_id", buckets=8).awaitTermination()
    return spark.read.parquet(f"{place}/out").drop("bucket", "batch_id")


def stream_ratings(spark: SparkSession, root: str) -> DataFrame:
    """Ratings and snapshots kept up by the recommender stream."""
    place = _place(spark)
    jobs.run_recommender(_stream(spark, root), place, f"{place}/state").awaitTermination()
    return jobs.rating_table(spark, place)


def _derived(spark: SparkSession, root: str, remember: str | None = None) -> str:
    """Tables derived from a stream that delivers every event twice."""
    place, events = _place(spark), _stream(spark, root)
    jobs.derive_tables(events.unionByName(events), place, f"{place}/state", remember=remember).awaitTermination()
    return place


def stream_cart(spark: SparkSession, root: str) -> DataFrame:
    return jobs.cart_table(spark, _derived(spark, root))


def derived_table(name: str, remember: str | None = None) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, root: spark.read.parquet(f"{_derived(spark, root, remember)}/{name}").drop("batch_id")


def stream_interactions(spark: SparkSession, root: str) -> DataFrame:
    """Sums kept in state and flushed every ten events of a user, or when a user has been idle for a day; every event
    comes twice."""
    place, events = _place(spark), _stream(spark, root)
    flushed = interactions.flushed_interactions(events.unionByName(events), every=10, idle="1 day")
    interactions.keep_flushed(flushed, f"{place}/out", f"{place}/state", partitions=8).awaitTermination()
    return interactions.flushed_table(spark, f"{place}/out")


def _sketched(spark: SparkSession, root: str) -> tuple[StarTables, VersionedTable]:
    """Daily sketches of all lines, of which the last years' days were loaded again."""
    t, table = StarTables(spark, root), VersionedTable(spark, f"{_place(spark)}/sketches")
    sketches.load_days(t, table)
    sketches.load_days(t, table, "2000-01-01")
    return t, table


def sketched_counts(spark: SparkSession, root: str) -> DataFrame:
    """Exact distinct counts per month and category, and whether the stored sketches come within three per cent."""
    t, table = _sketched(spark, root)
    totals = sketches.category_totals(table, None, None, by_month=True)
    both = sketches.exact_totals(t, None, None, by_month=True).join(totals, ["month", "category_id"], "left")
    near = F.lit(True)
    for name in sketches.DISTINCT:
        near = near & (F.abs(F.col(name) - F.col(f"n_{name}")) <= 0.03 * F.col(f"n_{name}") + 1)
    return both.select("month", "category_id", "n_lines", *(f"n_{n}" for n in sketches.DISTINCT),
                       (near & (F.col("lines") == F.col("n_lines"))).alias("within"))


def sketched_prices(spark: SparkSession, root: str) -> DataFrame:
    """Lines per category, and whether the quartiles from stored sketches are within three per cent of their rank."""
    t, table = _sketched(spark, root)
    totals = sketches.category_totals(table, None, None)
    errors = sketches.rank_errors(t, totals, None, None)
    return totals.join(errors, "category_id").select(
        "category_id", "lines", (F.greatest("error_p25", "error_p50", "error_p75") <= 0.03).alias("within"))


def _clustered(spark: SparkSession, root: str, *keys: str) -> tuple[StarTables, ClusteredTable]:
    t, table = StarTables(spark, root), ClusteredTable(spark, f"{_place(spark)}/orders", list(keys))
    table.write(t.orders, 16)
    return t, table


def clustered_page(spark: SparkSession, root: str) -> DataFrame:
    _, table = _clustered(spark, root, "order_id")
    return table.after(table.at((PAGE - 1) * 20).first()["order_id"], 20).select(*orders.PAGE_COLUMNS)


def clustered_status_since(spark: SparkSession, root: str) -> DataFrame:
    t, table = _clustered(spark, root, "status", "order_date", "order_id")
    t.__dict__["orders"] = table.between(["shipped"], "2000-01-01")
    return orders.orders_by_status_since(t, "shipped", "2000-01-01")


def clustered_status_totals(spark: SparkSession, root: str) -> DataFrame:
    t, table = _clustered(spark, root, "status", "order_date", "order_id")
    t.__dict__["orders"] = table.between(["pending", "processing", "shipped", "delivered", "cancelled"], "1998-01-01", "1999-01-01")
    return orders.status_totals(t, 1998)


def etl_sink(read: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A sink of the order ETL after a run over the orders of early years and one over all orders."""

    def run(spark: SparkSession, root: str) -> DataFrame:
        early, t, place = StarTables(spark, root), StarTables(spark, root), _place(spark)
        early.__dict__["orders"] = t.orders.filter(span("created_at", None, "1997-01-01"))
        jobs.run_orders_etl(early, spark, place, "2001-08-02 10:00:00", buckets=8, versioned=True)
        jobs.run_orders_etl(t, spark, place, "2001-08-02 11:00:00", buckets=8, versioned=True)
        return read(spark, place).select("order_id", "user_name", "status", F.col("items_count").cast("bigint").alias("items_count"),
                                         F.col("total_quantity").cast("bigint").alias("total_quantity"))

    return run


def routed_events(spark: SparkSession, root: str) -> DataFrame:
    """Events per type from the folders by type, and all of them from the common one."""
    place = _place(spark)
    for query in jobs.route_by_type(_stream(spark, root), place, f"{place}/state"):
        query.awaitTermination()
    by_type = spark.read.parquet(f"{place}/by_type").groupBy("event_type").agg(F.count("*").alias("n"))
    return by_type.unionByName(spark.read.parquet(f"{place}/all").agg(F.lit("all").alias("event_type"), F.count("*").alias("n")))


def dashboard_sections(t) -> DataFrame:
    """Each section of the one JSON union, read back: entries and the sum of its main figure."""
    total = {"overview": "total_revenue", "categories": "revenue", "daily_trends": "daily_revenue", "top_products": "product_revenue"}
    entries = F.from_json(F.when(F.col("section") == "overview", F.concat(F.lit("["), "data", F.lit("]"))).otherwise(F.col("data")),
                          "array<map<string,string>>")
    rows = sales.dashboard_sections(t, AS_OF).select("section", F.explode(entries).alias("e"))
    names = F.create_map(*(F.lit(x) for pair in total.items() for x in pair))
    return rows.groupBy("section").agg(
        F.count("*").alias("entries"), F.sum(F.element_at("e", F.element_at(names, F.col("section"))).cast("double")).alias("total"))


def snapshot_swept(spark: SparkSession, root: str) -> DataFrame:
    """The served snapshot after entries of users who never came back have expired and were swept away."""
    t = StarTables(spark, root)
    recs = recommend.affinity_recommendations(t.events)
    payload = recs.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("rank", "product_id", "score"))).alias("recs"))
    path = f"{_place(spark)}/recommendations"
    lake.write_snapshot(payload.withColumn("user_id", -1 - F.col("user_id")), path, "user_id", 3600, "2024-01-30", buckets=8)
    lake.write_snapshot(payload.withColumn("recs", F.slice("recs", 1, 1)), path, "user_id", 7200, "2024-01-30 23:30:00", buckets=8)
    lake.write_snapshot(payload, path, "user_id", 3600, EVENTS_AS_OF, buckets=8)
    lake.sweep_snapshot(spark, path, EVENTS_AS_OF, keep=1)
    # After the sweep nothing that has expired by then is stored, so that no time has to be named to leave it out.
    flat = VersionedTable(spark, path).read().select("user_id", F.inline("recs"))
    products = t.products.select("product_id", "name", "price")
    return recommend.enrich(flat, products, 10, [F.asc("rank")], per="user_id").select(
        "user_id", "product_id", "name", "price", F.col("score").alias("recommendation_score"))


def als_checks(t) -> DataFrame:
    """Figures of the factorisation that its input determines, and counts of broken rules, which are to be 0."""
    ratings = behavior.ratings(t.events)
    recs = recommend.als_recommendations(ratings)
    before = F.lag("score").over(Window.partitionBy("user_id").orderBy("rank"))  # ten rows a user
    per_user = recs.withColumn("_rises", (before < F.col("score")).cast("bigint")).groupBy("user_id").agg(
        F.count("*").alias("n"), F.max("rank").alias("last"), F.countDistinct("rank").alias("ranks"), F.sum("_rises").alias("rises"))
    unknown = recs.join(ratings.select("product_id").distinct(), "product_id", "left_anti").agg(F.count("*").alias("unknown_products"))
    gaps = F.count(F.when((F.col("last") != F.col("n")) | (F.col("ranks") != F.col("n")), 1))
    return per_user.agg(
        F.count("*").alias("users"), F.sum("n").alias("n_rows"), gaps.alias("rank_gaps"),
        F.coalesce(F.sum("rises"), F.lit(0)).cast("bigint").alias("rising_scores")).withColumn(
        "unknown_products", unknown.scalar())


def stream_log(spark: SparkSession, root: str) -> DataFrame:
    place = _place(spark)
    raw = spark.readStream.schema(STAR["events"]).parquet(f"{root.rstrip('/')}/event[s].parquet")
    t = StarTables(spark, root)
    t._read = lambda name: raw
    jobs.ingest_log(t.sql_log, f"{place}/out", f"{place}/state").awaitTermination()
    return spark.read.parquet(f"{place}/out").groupBy("log_date", "log_type").agg(F.count("*").alias("n"))


def summary_upserted(spark: SparkSession, root: str) -> DataFrame:
    """Summary table written in full, then the days of one year once more."""
    t = StarTables(spark, root)
    path = f"{_place(spark)}/daily_sales_summary"
    days = sales.daily_summary(t)
    # Days could be the partitions themselves; by month the files stay large enough here.
    by_month = days.withColumn("month", F.trunc("summary_date", "MM")).withColumn("_at", F.lit(0))
    lake.upsert_partitioned(by_month, path, ["summary_date"], "_at", ["month"])
    lake.upsert_partitioned(by_month.filter(F.year("summary_date") == 2000), path, ["summary_date"], "_at", ["month"])
    return spark.read.parquet(path).drop("month", "_at")


def orders_by_month(spark: SparkSession, root: str) -> DataFrame:
    """Latest orders since a date on the month-partitioned layout."""
    t = StarTables(spark, root)
    path = f"{_place(spark)}/orders"
    orders.write_orders_by_month(t.orders, path)
    t.__dict__["orders"] = spark.read.parquet(path)
    return orders.latest_by_status(t, "shipped", 1000, "2001-01-01")


def snapshot_served(spark: SparkSession, root: str) -> DataFrame:
    """Affinity recommendations written as a snapshot, read before expiry and enriched."""
    t = StarTables(spark, root)
    recs = recommend.affinity_recommendations(t.events)
    payload = recs.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("rank", "product_id", "score"))).alias("recs"))
    path = f"{_place(spark)}/recommendations"
    lake.write_snapshot(payload, path, "user_id", 3600, EVENTS_AS_OF, buckets=8)
    served = lake.read_snapshot(spark, path, "2024-01-31 00:59:59")
    flat = served.select("user_id", F.inline("recs"))
    products = t.products.select("product_id", "name", "price")
    return recommend.enrich(flat, products, 10, [F.asc("rank")], per="user_id").select(
        "user_id", "product_id", "name", "price", F.col("score").alias("recommendation_score"))


def indexed_search(**options) -> Callable[[SparkSession, str], DataFrame]:
    """A page from a stored index whose products were all replaced once."""

    def run(spark: SparkSession, root: str) -> DataFrame:
        docs, index = StarTables(spark, root).search_docs, SearchIndex(spark, f"{_place(spark)}/index")
        index.update(docs.withColumn("description", F.concat_ws(" ", "name", F.lit(SEARCH))))
        index.update(docs)
        return index.search(SEARCH, **options).drop("description", "tags", "name")

    return run


def tables_queries() -> dict[str, Callable]:
    """Queries that only need the tables."""
    o, s, c, b, r = orders, sales, customers, behavior, recommend
    return {
        "q01_status_breakdown": lambda t: o.status_breakdown(t),
        "q02_user_orders": lambda t: exploded(o.user_orders(t), "items", "user_id", "order_id", "order_date", "status",
                                              "total_amount", "payment_method"),
        "q02_user_orders_page2_status": lambda t: o.user_orders(t, page=2, size=3, status="shipped").select(
            "user_id", "order_id", "total_amount", F.size("items").cast("bigint").alias("items_count")),
        "q03_product_page": lambda t: o.product_page(t, category="SMALL", mode="page_then_filter").drop("tags"),
        "q03_product_page_filtered": lambda t: o.product_page(t, page=2, category="SMALL", min_price=905.0, mode="filter_then_page"),
        "q04_monthly_category_growth": lambda t: s.monthly_category_growth(t, AS_OF),
        "q05_product_sales_profile": lambda t: s.product_sales_profile(t, AS_OF),
        "q05_product_sales_profile_dedup": lambda t: s.product_sales_profile(t, AS_OF, dedup_fanout=True),
        "q06_category_tree": lambda t: s.category_tree(t, AS_OF).drop("id_path"),
        "q06_category_tree_fixpoint": lambda t: s.category_tree(t, AS_OF, method="fixpoint").drop("id_path"),
        "q07_cohort_retention": lambda t: c.cohort_retention(t, COHORT_AS_OF),
        "q08_string_profile": lambda t: c.string_profile(t, "1999"),
        "q09_behavior_counts": lambda t: b.behavior_counts(t, EVENTS_AS_OF),
        "q09_behavior_products": lambda t: b.behavior_products(t, EVENTS_AS_OF),
        "q10_engagement": lambda t: b.engagement(b.behavior_counts(t, EVENTS_AS_OF), users=t.users).drop("primary_actions"),
        "q10_primary_actions": lambda t: b.engagement(b.behavior_counts(t, EVENTS_AS_OF)).select(
            "user_id", F.inline("primary_actions")),
        "q11_dashboard_overview": lambda t: s.dashboard(t, AS_OF)["overview"],
        "q11_dashboard_categories": lambda t: s.dashboard(t, AS_OF)["categories"],
        "q11_dashboard_daily_trends": lambda t: s.dashboard(t, AS_OF)["daily_trends"],
        "q11_dashboard_top_products": lambda t: s.dashboard(t, AS_OF)["top_products"],
        "q12_purchase_history": lambda t: o.purchase_history(t, AS_OF),
        "q12_purchase_history_details": lambda t: exploded(o.purchase_history(t, AS_OF, details=True), "items", "user_id",
                                                           "order_id", "total_amount", "item_count"),
        "q13_category_sales": lambda t: s.category_sales(t, AS_OF),
        "q14_top_customers": lambda t: c.top_customers(t, AS_OF),
        "q14_top_customers_dedup": lambda t: c.top_customers(t, AS_OF, limit=300, dedup_fanout=True),
        "q15_orders_in_range": lambda t: o.orders_in_range(t, "2000-01-01", "2000-07-01"),
        "q16_user_summary": lambda t: c.user_summary(t),
        "q17_product_sales": lambda t: s.product_sales(t),
        "q17_product_sales_category": lambda t: s.product_sales(t, "PROMO"),
        "q18_latest_by_status": lambda t: o.latest_by_status(t, "shipped"),
        "q19_month_totals_range": lambda t: o.month_totals(t, 1998, 6, "range"),
        "q19_month_totals_date_part": lambda t: o.month_totals(t, 1998, 6, "date_part"),
        "q20_page_by_offset": lambda t: o.orders_page_offset(t, PAGE),
        "q20_page_by_positions": lambda t: o.orders_page_offset(t, PAGE, direct=0),
        "q20_page_by_key": lambda t: o.orders_page_after(t, o.key_at(t, (PAGE - 1) * 20)),
        "q21_status_totals": lambda t: o.status_totals(t, 1998),
        "q22_frequent_spenders_pre_aggregated": lambda t: o.frequent_spenders(t, "1999-01-01"),
        "q22_frequent_spenders_join_first": lambda t: o.frequent_spenders(t, "1999-01-01", form="join_first"),
        "q23_orders_by_status_since": lambda t: o.orders_by_status_since(t, "shipped", "2000-01-01"),
        "q23_pending_over": lambda t: o.pending_over(t, 100).drop("shipping_address"),
        "q23_orders_per_user": lambda t: o.orders_per_user(t, 1998),
        **{f"q24_order_lines_{a}": (lambda t, a=a: o.order_lines_with_names(t, "shipped", a))
           for a in ("auto", "hash_join", "merge_join", "nested_loop")},
        **{f"q25_buyers_{f}": (lambda t, f=f: o.buyers(t, "shipped", f)) for f in ("exists", "join", "in")},
        **{f"q26_basic_{k}": (lambda t, k=k: o.basic_pack(t)[k]) for k in ("select", "where", "join", "group", "order")},
        **{f"q27_complex_{k}": (lambda t, k=k: o.complex_pack(t, "Customer#0000001")[k])
           for k in ("subquery", "window", "joins", "aggregation")},
        "q28_daily_sales": lambda t: s.daily_sales(t, "1998-01-01"),
        "q28_top_products": lambda t: s.analytic_pack(t, EVENTS_AS_OF)["top_products"],
        "q28_user_behavior": lambda t: s.analytic_pack(t, EVENTS_AS_OF)["user_behavior"],
        "q29_recent_lines": lambda t: s.recent_lines(t, AS_OF),
        "q30a_hot_products": lambda t: s.hot_products(t, AS_OF, days=365),
        "q30b_order_sequence": lambda t: s.order_sequence(t, AS_OF, days=365),
        "q30c_monthly_growth": lambda t: s.monthly_growth(t, AS_OF),
        "q30d_price_stats": lambda t: s.price_stats(t),
        "q31_product_stats": lambda t: s.product_stats(t),
        "q32_user_stats": lambda t: c.user_stats(t),
        "q33_recommendation_score": lambda t: s.recommendation_score(t, score_pairs(t)),
        "q34_daily_summary": lambda t: s.daily_summary(t),
        "q35_trending": lambda t: b.trending(t.events, EVENTS_AS_OF),
        "q36_ratings": lambda t: b.ratings(t.events),
        "q37_als_recommendations": lambda t: r.als_recommendations(b.ratings(t.events)),
        "q37_als_checks": als_checks,
        "q38_affinity_recommendations": lambda t: r.affinity_recommendations(t.events, users=t.users),
        "q39_simple_trending": lambda t: b.simple_trending(t.events),
        "q40_enriched_trending": lambda t: r.enrich(
            b.trending(t.events, EVENTS_AS_OF), t.products.select("product_id", "name", "price"), 20,
            [F.desc("trending_score"), F.asc("product_id")]),
        "q40_enriched_recommendations": lambda t: r.enrich(
            r.affinity_recommendations(t.events).withColumnRenamed("score", "recommendation_score"),
            t.products.select("product_id", "name", "price"), 10, [F.asc("rank")], per="user_id"),
        "q41_search_products": lambda t: search.search_products(t.search_docs, SEARCH).drop("description", "tags", "name"),
        "q41_search_filtered": lambda t: search.search_products(
            t.search_docs, SEARCH, category="en", min_price=300, max_price=5000, page=2).drop("description", "tags", "name"),
        "q41_search_all": lambda t: search.search_products(t.search_docs, brand="src1").drop("description", "tags", "name"),
        "q42_user_counters": lambda t: b.user_counters(t.events),
        "q43_popular_products": lambda t: r.enrich(
            b.popularity(t.events), t.products.select("product_id", "name"), 20, [F.desc("popularity_score"), F.asc("product_id")]),
        "q44_behavior_log": lambda t: b.behavior_log(t.events),
        "q45_purchase_orders": lambda t: b.orders_from_purchases(t.events)[0],
        "q45_purchase_items": lambda t: b.orders_from_purchases(t.events)[1],
        "q46_cart_upsert": cart_in_two_steps,
        "q47_order_documents": document_rows,
        "q47_order_documents_since": documents_since,
        "q48_parse_sql_log": lambda t: sqllog.parse_sql_log(t.sql_log),
        "q49a_log_by_category": lambda t: sqllog.log_by_category(sqllog.parse_sql_log(t.sql_log)),
        "q49b_log_time_trend": lambda t: sqllog.log_time_trend(sqllog.parse_sql_log(t.sql_log)),
        "q49c_log_by_type": lambda t: sqllog.log_by_type(sqllog.parse_sql_log(t.sql_log)),
        "q49d_slowest_statements": lambda t: sqllog.slowest_statements(sqllog.parse_sql_log(t.sql_log)),
        "q50a_hourly_revenue": lambda t: charts.hourly_revenue(documents(t)),
        "q50b_revenue_by_brand": lambda t: charts.revenue_by_brand(documents(t)),
        "q50c_orders_by_payment": lambda t: charts.orders_by_payment(documents(t)),
        "q50d_orders_by_status": lambda t: charts.orders_by_status(documents(t)),
        "q50e_quantity_by_category": lambda t: charts.quantity_by_category(documents(t)),
        "q50f_revenue_24h": lambda t: charts.revenue_24h(documents(t), AS_OF),
        "q51_statement_latency": lambda t: sqllog.statement_latency(sqllog.parse_sql_log(t.sql_log)),
        "q51_speed_up": lambda t: sqllog.speed_up(
            sqllog.statement_latency(sqllog.parse_sql_log(t.sql_log)), "SELECT 1", "SELECT 2"),
        "q52_slow_statements": lambda t: sqllog.slow_statements(sqllog.parse_sql_log(t.sql_log)),
        "d1_duplicate_lines": lambda t: quality.check_unique(t.order_items.select(
            "order_id", F.col("order_item_id.line_no").alias("line_no")), ["order_id", "line_no"]),
        "d2_orders_without_items": lambda t: quality.check_fk(t.orders.select("order_id", "user_id"), "order_id", t.order_items),
        "d2_event_products": lambda t: quality.check_fk(t.events.select("event_id", "product_id"), "product_id", t.products),
        **{f"d3_rules_{n}": (lambda t, n=n: quality.check_rules(getattr(t, n), quality.table_rules()[n]))
           for n in ("users", "products", "orders", "order_items", "product_reviews", "user_behavior_log")},
        "d4_event_nulls": lambda t: quality.check_not_null(t.events, ["event_id", "user_id", "quantity", "total_amount", "session_id"]),
        "d5_filled_quantity": lambda t: quality.fill_defaults(t.events, {"quantity": 1, "total_amount": 0.0}).groupBy(
            "event_type").agg(F.sum("quantity").alias("quantity"), F.sum("total_amount").alias("total_amount")),
        "d6_items_kept": lambda t: quality.cascade_delete(
            t.order_items, t.orders.filter("status = 'cancelled'"), "order_id").groupBy("order_id").agg(F.count("*").alias("n")),
        "s4_changed_orders": lambda t: lake.extract_since(t.orders, "2001-06-01").select(
            "order_id", "created_at", "updated_at"),
        "f_padded_and_shortened": lambda t: t.products.select(
            "product_id", padded_id("product", "product_id").alias("padded"), shorten("description", 12).alias("short")),
        "u1_dashboard_sections": dashboard_sections,
        "a23_purchase_share": lambda t: b.user_counters(t.events).select(
            "user_id", percent_of_sum("purchase_count", "view_count").alias("purchase_percent")),
        "g3_stamped_orders": lambda t: quality.stamp_update(t.orders.filter("status = 'pending'"), AS_OF).select(
            "order_id", "created_at", "updated_at"),
        "x2_window_counts": lambda t: aggregates.windowed_counts(t.events, delay=None, ts="ts"),
    }


def session_queries() -> dict[str, Callable]:
    """Queries that run a stream or write and read back; they need the session and the folder."""
    return {
        "q18_latest_since_by_month": orders_by_month,
        "q41_index_products": indexed_search(),
        "q41_index_filtered": indexed_search(category="en", min_price=300, max_price=5000, page=2),
        "q20_page_by_key_clustered": clustered_page,
        "q21_status_totals_clustered": clustered_status_totals,
        "q23_orders_by_status_clustered": clustered_status_since,
        "s6_json_sink": etl_sink(lambda spark, place: spark.read.json(f"{place}/json")),
        "s7_keyed_documents": etl_sink(lambda spark, place: VersionedTable(spark, f"{place}/documents").read()),
        "x12_lake_after_two_runs": etl_sink(lambda spark, place: spark.read.parquet(f"{place}/lake")),
        "s8_snapshot_swept": snapshot_swept,
        "s9_routed_events": routed_events,
        "a3_sketched_counts": sketched_counts,
        "a7_sketched_prices": sketched_prices,
        "s5_daily_summary_upserted": summary_upserted,
        "s8_snapshot_served": snapshot_served,
        "x3_window_counts_stream": stream_windows,
        "x5_recommender_stream": stream_ratings,
        "x8_counters_stream": stream_counters,
        "x9_popularity_stream": stream_popularity,
        "x10_interactions_stream": stream_interactions,
        "x11_cart_stream": stream_cart,
        "x11_orders_stream": derived_table("orders"),
        "x11_items_stream": derived_table("order_items"),
        "x11_log_table_stream": derived_table("user_behavior_log"),
        "x11_orders_stream_state": derived_table("orders", "2 days"),
        "x13_log_stream": stream_log,
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over_tables(job):
        return lambda spark, root: portable(job(StarTables(spark, root)))

    def over_session(job):
        return lambda spark, root: portable(job(spark, root))

    return {
        **{name: over_tables(job) for name, job in tables_queries().items()},
        **{name: over_session(job) for name, job in session_queries().items()},
    }
