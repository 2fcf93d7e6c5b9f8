import json
from datetime import datetime as dt, timedelta

from pyspark.sql import functions as F

from storeglass.plans import behavior, recommend, sqllog
from storeglass.sources import events as source, lake
from storeglass.sources.retail import Tables
from storeglass.streaming import aggregates, jobs

NOON = dt(2024, 1, 1, 12)


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_upsert_keeps_the_latest_and_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "order_id long, v string, at long, day int")
    lake.upsert_partitioned(make([(1, "a", 1, 1), (1, "b", 2, 1), (2, "x", 1, 2)]), path, ["order_id"], "at", ["day"])
    update = make([(1, "same time", 2, 1), (3, "new", 1, 1)])
    for _ in range(2):
        lake.upsert_partitioned(update, path, ["order_id"], "at", ["day"])
        assert values(spark.read.parquet(path), "order_id", "v", "day") == [(1, "same time", 1), (2, "x", 2), (3, "new", 1)]
    lake.upsert_partitioned(make([(1, "late", 1, 1)]), path, ["order_id"], "at", ["day"])
    assert (1, "same time") in values(spark.read.parquet(path), "order_id", "v")


def test_json_upsert(spark, tmp_path):
    path = str(tmp_path / "j")
    make = lambda rows: spark.createDataFrame(rows, "order_id long, tags array<string>, at long, day int")
    lake.upsert_partitioned(make([(1, ["a"], 1, 1)]), path, ["order_id"], "at", ["day"], "json")
    lake.upsert_partitioned(make([(1, ["b", "c"], 2, 1), (2, [], 1, 1)]), path, ["order_id"], "at", ["day"], "json")
    assert values(spark.read.json(path), "order_id", "tags") == [(1, ["b", "c"]), (2, [])]


def test_snapshot_expires(spark, tmp_path):
    path = str(tmp_path / "s")
    lake.write_snapshot(spark.createDataFrame([("u1", 1), ("u2", 2)], "k string, v int"), path, "k", 300, NOON, buckets=4)
    lake.write_snapshot(spark.createDataFrame([("u1", 9)], "k string, v int"), path, "k", 300, NOON + timedelta(minutes=3), buckets=4)
    assert values(lake.read_snapshot(spark, path, NOON + timedelta(minutes=4)), "k", "v") == [("u1", 9), ("u2", 2)]
    assert values(lake.read_snapshot(spark, path, NOON + timedelta(minutes=6)), "k", "v") == [("u1", 9)]


def test_malformed_events_are_kept_aside(spark):
    raw = spark.createDataFrame([('{"event_id": "e1", "user_id": "u", "timestamp": "2024-01-01T12:00:00.5", "quantity": 2}',),
                                 ("not json",), ('{"event_id": "e2", "quantity": "many"}',)], "value string")
    good, bad = source.decode_json(raw)
    row = good.first()
    assert good.count() == 1 and row.timestamp == dt(2024, 1, 1, 12, 0, 0, 500000) and row.quantity == 2
    assert values(bad, "value") == [("not json",), ('{"event_id": "e2", "quantity": "many"}',)]


def event(n, minute, user="u1", product="p1", kind="view", **more):
    at = (NOON + timedelta(minutes=minute)).isoformat()
    return json.dumps({"event_id": f"e{n}", "user_id": user, "product_id": product, "event_type": kind, "timestamp": at, **more})


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_windows_drop_late_rows_and_emit_closed_windows(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    stream = lambda: aggregates.windowed_counts(source.read_events(spark, "text", {"path": str(folder)}))
    put(folder, "1.json", [event(1, 1), event(2, 8), event(3, 2), event(4, 60)])
    jobs.start(stream(), out, state).awaitTermination()
    put(folder, "2.json", [event(5, 3), event(6, 90)])  # the first one is far behind the watermark
    jobs.start(stream(), out, state).awaitTermination()
    rows = values(spark.read.parquet(out), "start", "count")
    at = lambda minute: NOON + timedelta(minutes=minute)
    assert rows == [(at(-5), 2), (at(0), 3), (at(5), 1), (at(55), 1), (at(60), 1)]


def test_redelivered_events_count_once(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "1.json", [event(1, 1), event(1, 1), event(2, 2, kind="purchase"), event(3, 2, product="p2", kind="cart")])
    put(folder, "2.json", [event(2, 2, kind="purchase"), event(4, 3, kind="like")])
    read = lambda: aggregates.once(source.read_events(spark, "text", {"path": str(folder), "maxFilesPerTrigger": "1"}))
    jobs.counters_to_table(aggregates.counters_stream(read()), str(tmp_path / "c"), str(tmp_path / "cs"), "user_id", buckets=2).awaitTermination()
    row = spark.read.parquet(str(tmp_path / "c")).first()
    assert (row.total_events, row.view_count, row.purchase_count, row.cart_count, row.like_count) == (4, 1, 1, 1, 1)
    assert row.last_activity == NOON + timedelta(minutes=3)
    jobs.counters_to_table(aggregates.popularity_stream(read()), str(tmp_path / "p"), str(tmp_path / "ps"), "product_id", buckets=2).awaitTermination()
    assert values(spark.read.parquet(str(tmp_path / "p")), "product_id", "popularity_score") == [("p1", 9.0)]


def test_routing_by_type_and_topics(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "1.json", [event(1, 1), event(2, 2, kind="cart")])
    for query in jobs.route_by_type(source.read_events(spark, "text", {"path": str(folder)}), str(tmp_path / "o"), str(tmp_path / "s")):
        query.awaitTermination()
    assert values(spark.read.parquet(str(tmp_path / "o/by_type")), "event_type", "event_id") == [("cart", "e2"), ("view", "e1")]
    everything = spark.read.parquet(str(tmp_path / "o/all"))
    assert everything.count() == 2
    assert values(source.with_topics(everything), "topic", "key") == [
        ("user-events-all", "u1"), ("user-events-all", "u1"), ("user-events-cart", "u1"), ("user-events-view", "u1")]


def timed(stream):
    return stream.withColumn("ts", F.col("timestamp").cast("timestamp_ntz"))


def test_recommender_in_batches_equals_one_batch(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "r")
    lines = [event(n, n % 50, f"u{n % 13}", f"p{n % 17}", ("view", "cart", "like", "purchase")[n % 4]) for n in range(300)]
    put(folder, "1.json", lines[:150])
    put(folder, "2.json", lines[150:])
    stream = timed(source.read_events(spark, "text", {"path": str(folder), "maxFilesPerTrigger": "1"}))
    jobs.run_recommender(stream, path, str(tmp_path / "s"), n=3, compact_every=1).awaitTermination()
    assert values(spark.read.parquet(f"{path}/rating_base").select("version").distinct(), "version") == [(0,), (1,)]
    jobs.compact_sums(spark, path, 1)  # a repeated fold changes nothing
    batch = timed(source.decode_json(spark.read.text(str(folder)))[0])
    want = behavior.ratings(batch).select("user_id", "product_id", F.round("final_rating", 9).alias("r"))
    got = jobs.rating_table(spark, path).select("user_id", "product_id", F.round("final_rating", 9).alias("r"))
    assert got.count() == want.count() == 221 and got.exceptAll(want).count() == 0
    last = dt(2024, 1, 1, 12, 49)
    recs = lake.read_snapshot(spark, f"{path}/recommendations", last)
    assert recs.count() == 13 and all(len(r.recommendations) == 3 for r in recs.collect())
    trend = lake.read_snapshot(spark, f"{path}/trending", last).first().products
    best = behavior.trending(batch, "2024-01-02").first()
    assert len(trend) == 17 and (trend[0].product_id, trend[0].score) == (best.product_id, best.trending_score)


def test_small_data_trains_nothing(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "r")
    put(folder, "1.json", [event(1, 1), event(2, 2)])
    stream = timed(source.read_events(spark, "text", {"path": str(folder)}))
    jobs.run_recommender(stream, path, str(tmp_path / "s")).awaitTermination()
    assert not (tmp_path / "r" / "recommendations").exists() and (tmp_path / "r" / "trending").exists()


def test_affinity_flush_equals_batch(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "r")
    put(folder, "1.json", [event(n, n, f"u{n % 3}", f"p{n % 5}") for n in range(20)])
    stream = timed(source.read_events(spark, "text", {"path": str(folder)}))
    jobs.flush_affinity(stream, path, str(tmp_path / "s"), 4).awaitTermination()
    want = recommend.affinity_recommendations(timed(source.decode_json(spark.read.text(str(folder)))[0]), 4)
    assert spark.read.parquet(f"{path}/recommendations").exceptAll(want).count() == 0 and want.count() == 12


def test_derived_tables_and_replayed_batch(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "d")
    put(folder, "1.json", [event(1, 1, kind="purchase", quantity=4, total_amount=10.0), event(2, 2, kind="cart"), event(3, 3, kind="cart")])
    stream = timed(source.read_events(spark, "text", {"path": str(folder)}))
    jobs.derive_tables(stream, path, str(tmp_path / "s")).awaitTermination()
    item = spark.read.parquet(f"{path}/order_items").first()
    assert (item.order_id, item.quantity, item.unit_price, item.total_price) == ("order_e1", 4, 2.5, 10.0)
    rows = timed(source.decode_json(spark.read.text(str(folder)))[0])
    jobs.append_batch(behavior.cart_upsert(None, rows), f"{path}/cart_increments", 0)  # batch 0 once more
    assert values(jobs.cart_table(spark, path), "user_id", "product_id", "quantity") == [("u1", "p1", 2)]
    assert values(spark.read.parquet(f"{path}/user_behavior_log"), "action_type") == [("cart_add",), ("cart_add",), ("purchase",)]


def test_cart_upsert_of_existing_and_new(spark):
    cart = spark.createDataFrame([("u1", "p1", 3, NOON)], "user_id string, product_id string, quantity int, added_at timestamp_ntz")
    later = NOON + timedelta(hours=1)
    added = spark.createDataFrame([("u1", "p1", "cart", later), ("u1", "p2", "cart", later), ("u1", "p1", "view", later)],
                                  "user_id string, product_id string, event_type string, ts timestamp_ntz")
    assert values(behavior.cart_upsert(cart, added), "product_id", "quantity", "added_at") == [("p1", 4, later), ("p2", 1, later)]


def test_incremental_etl_moves_its_mark(spark, tmp_path):
    order = "order_id long, user_id long, order_date timestamp_ntz, status string, total_amount double, shipping_address string, payment_method string, created_at timestamp_ntz, updated_at timestamp_ntz"
    row = lambda i, status, changed: (i, 1, NOON, status, 5.0, None, "paypal", NOON, changed)
    fixed = dict(
        users=spark.createDataFrame([(1, "U", "u@example.com")], "user_id long, name string, email string"),
        products=spark.createDataFrame([(1, "P", 1, 1)], "product_id long, name string, category_id int, brand_id int"),
        categories=spark.createDataFrame([(1, "C")], "category_id int, name string"),
        brands=spark.createDataFrame([(1, "B")], "brand_id int, name string"),
        order_items=spark.createDataFrame([(n, n, 1, 1, 5.0, 5.0) for n in (1, 2)],
                                          "order_item_id long, order_id long, product_id long, quantity int, unit_price double, total_price double"))
    path = str(tmp_path / "etl")
    first = Tables(orders=spark.createDataFrame([row(1, "pending", NOON), row(2, "pending", NOON)], order), **fixed)
    assert jobs.run_orders_etl(first, spark, path, "2024-01-02 10:00:00", buckets=4)
    assert not jobs.run_orders_etl(first, spark, path, "2024-01-02 10:10:00", buckets=4)
    second = Tables(orders=spark.createDataFrame([row(1, "shipped", NOON + timedelta(days=1)), row(2, "pending", NOON)], order), **fixed)
    assert jobs.run_orders_etl(second, spark, path, "2024-01-02 10:20:00", buckets=4)
    for table in ("lake", "documents"):
        assert values(spark.read.parquet(f"{path}/{table}"), "order_id", "status") == [(1, "shipped"), (2, "pending")]
    copy = spark.read.json(f"{path}/json")
    assert values(copy, "order_id", "status", "hour") == [(1, "shipped", 10), (2, "pending", 10)]
    assert lake.read_mark(spark, f"{path}/mark") == str(NOON + timedelta(days=1))


def test_log_ingest_by_day(spark, tmp_path):
    folder = tmp_path / "in"
    line = lambda message, day, **more: json.dumps({"message": message, "timestamp": f"2024-01-0{day}T10:00:00", **more})
    put(folder, "1.json", [line("[SQL Query] SELECT 1", 1, sql_query="SELECT 1"), line("[SQL Execution Time] 1500.00ms", 2, sql_query="SELECT 1")])
    jobs.ingest_log(source.read_log_lines(spark, str(folder)), str(tmp_path / "o"), str(tmp_path / "s")).awaitTermination()
    log = spark.read.parquet(str(tmp_path / "o"))
    assert values(log, "log_type", "query_type") == [("sql_performance", "SELECT"), ("sql_query", "SELECT")]
    assert sqllog.slowest_statements(log).first().max_ms == 1500.0
    assert [r.n for r in sqllog.log_by_type(log, only_queries=True).collect()] == [1]
    assert {p.name for p in (tmp_path / "o").glob("log_date=*")} == {"log_date=2024-01-01", "log_date=2024-01-02"}


def test_trending_stream_is_close_to_batch(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "1.json", [event(n, n % 60, f"u{n % 7}", f"p{n % 3}") for n in range(60)] + [event(99, 3000)])
    stream = aggregates.trending_stream(source.read_events(spark, "text", {"path": str(folder)}))
    jobs.start(stream, str(tmp_path / "o"), str(tmp_path / "s")).awaitTermination()
    assert values(behavior.trending_score(spark.read.parquet(str(tmp_path / "o"))), "product_id", "total_interactions", "unique_users") == [
        ("p0", 20, 7), ("p1", 20, 7), ("p2", 20, 7)]


def test_upsert_into_thousands_of_partitions(spark, tmp_path):
    path = str(tmp_path / "days")
    days = spark.range(1500).select(F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")).alias("summary_date"), F.col("id").alias("v"))
    lake.upsert_by_day(days, path)
    changed = days.withColumn("v", F.col("v") + 1).unionByName(
        spark.createDataFrame([("2030-01-01", 7)], "d string, v long").select(F.col("d").cast("date").alias("summary_date"), "v"))
    lake.upsert_by_day(changed, path)
    after = spark.read.parquet(path)
    assert after.count() == 1501 and after.agg(F.sum("v")).first()[0] == sum(range(1501)) + 7


def test_upsert_of_a_null_partition_and_of_nothing(spark, tmp_path):
    path = str(tmp_path / "n")
    make = lambda rows: spark.createDataFrame(rows, "k long, v string, at long, p string")
    lake.upsert_partitioned(make([(1, "a", 1, None), (2, "b", 1, "x")]), path, ["k"], "at", ["p"])
    lake.upsert_partitioned(make([(1, "c", 2, None)]), path, ["k"], "at", ["p"])
    lake.upsert_partitioned(make([]), path, ["k"], "at", ["p"])
    assert values(spark.read.parquet(path), "k", "v") == [(1, "c"), (2, "b")]


def test_events_delivered_again_count_once(spark, tmp_path):
    schema = "event_id string, user_id long, product_id long, event_type string, ts timestamp, quantity int, price double"
    batch = lambda *ids: spark.createDataFrame([(i, 1, 1, "view", NOON, 1, 1.0) for i in ids], schema)
    path = str(tmp_path / "seen")
    ids = lambda df: sorted((r.event_id or "") for r in df.collect())
    assert ids(jobs.fresh_events(batch("a", "b", "a", None, None), path, 0)) == ["", "", "a", "b"]
    assert ids(jobs.fresh_events(batch("b", "c"), path, 1)) == ["c"]
    assert ids(jobs.fresh_events(batch("b", "c"), path, 1)) == ["c"]  # a replayed batch
    assert ids(jobs.fresh_events(batch("a", "c", "d"), path, 2)) == ["d"]


def test_folded_parts_go(spark, tmp_path):
    path = str(tmp_path / "sums")
    for n in range(6):
        jobs.append_batch(spark.createDataFrame([(1, 1, 1.0, 1)], "user_id long, product_id long, weight double, n long"), f"{path}/rating_sums", n)
        if n % 2:
            jobs.compact_sums(spark, path, n)
    assert jobs.interaction_sums(spark, path).first().n == 6
    assert sorted(p.name for p in (tmp_path / "sums" / "rating_sums").glob("batch_id=*")) == ["batch_id=4", "batch_id=5"]


def test_order_sinks_leave_no_second_copy(spark, tmp_path, star):
    """Documents are stored for the run only, JSON is compressed, and a run over the same orders adds nothing."""
    import glob

    from storeglass.operators.materialize import shared_folder
    from storeglass.streaming import jobs

    checkpoints = lambda: set(glob.glob(f"{shared_folder(spark)}/*/rdd-*"))
    before, key = checkpoints(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(key, None)
    assert jobs.run_orders_etl(star, spark, str(tmp_path), "2001-08-02 10:00:00", buckets=2, versioned=True)
    assert not jobs.run_orders_etl(star, spark, str(tmp_path), "2001-08-02 11:00:00", buckets=2, versioned=True)
    assert not checkpoints() - before and not glob.glob(f"{shared_folder(spark)}/stored-*")
    files = glob.glob(f"{tmp_path}/json/**/part-*", recursive=True)
    assert files and all(f.endswith(".json.gz") for f in files)
    assert spark.conf.get(key, None) == kept
    rows = spark.read.json(f"{tmp_path}/json")
    assert rows.count() == rows.select("order_id").distinct().count() == spark.read.parquet(f"{tmp_path}/lake").count()
