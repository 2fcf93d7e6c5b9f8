"""Streaming jobs. Each micro-batch writes under its batch id, so a replayed batch replaces its own rows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from storeglass.functions.exprs import at
from storeglass.operators.materialize import materialize, stored
from storeglass.operators.settings import settings
from storeglass.plans import behavior, etl
from storeglass.plans.recommend import affinity_from_pairs, als_recommendations, interactions
from storeglass.plans.sqllog import parse_sql_log
from storeglass.sources.lake import next_mark, read_if_exists, read_mark, upsert_partitioned, write_mark, write_snapshot
from storeglass.sources.versions import VersionedTable, keep_last

#: Shuffle files go with the write that needed them, not when the driver happens to collect its garbage.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def start(df: DataFrame, path: str, checkpoint: str, mode: str = "append", interval: str | None = None,
          partitions: list[str] | None = None) -> StreamingQuery:
    """Parquet sink; without an interval everything available is processed and the query ends."""
    writer = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return _triggered(writer, interval).start(path)


def _triggered(writer, interval: str | None):
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def each_batch(stream: DataFrame, run, checkpoint: str, interval: str | None = None, mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(run).outputMode(mode).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


def append_batch(df: DataFrame, path: str, batch_id: int, partitions: tuple[str, ...] = ()) -> None:
    """Writes the rows of a batch to its own partition, replacing what an earlier try of it wrote."""
    df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*partitions, "batch_id").parquet(path)


def fresh_events(batch: DataFrame, path: str, batch_id: int) -> DataFrame:
    """The events of a batch that no earlier batch brought, each once (a stored frame with event_date).

    Ids that were taken are kept per day under `seen`; a batch reads those of its own days only, and a replayed batch
    leaves out what it wrote itself, so it gives the same rows again. Events without an id cannot be told apart and pass.
    """
    spark = batch.sparkSession
    dated = batch.withColumn("event_date", F.to_date("ts"))
    named = dated.filter("event_id IS NOT NULL").dropDuplicates(["event_id"])
    seen = read_if_exists(spark, f"{path}/seen")
    if seen is not None:
        days = [row["event_date"] for row in named.select("event_date").distinct().collect()]
        earlier = seen.filter(F.col("event_date").isin(days) & (F.col("batch_id") != batch_id)).select("event_id")
        named = named.join(earlier, "event_id", "left_anti").select(*dated.columns)
    rows = materialize(named.unionByName(dated.filter("event_id IS NULL")))
    append_batch(rows.filter("event_id IS NOT NULL").select("event_id", "event_date"), f"{path}/seen", batch_id, ("event_date",))
    return rows


def latest_time(spark: SparkSession, path: str, rows: DataFrame):
    """Latest event time so far, from a stored mark and the rows of the batch."""
    known, here = read_mark(spark, f"{path}/latest"), rows.agg(F.max("ts").alias("last")).first()["last"]
    latest = max(x for x in (here, datetime.fromisoformat(known) if known else None) if x is not None)
    write_mark(spark, f"{path}/latest", latest)
    return latest


def drop_folded(spark: SparkSession, path: str, before: int) -> None:
    """Removes the parts and folds that a later fold holds: batches up to `before`, folds older than it."""
    jvm = spark._jvm
    for folder, name, last in (("rating_sums", "batch_id", before), ("rating_base", "version", before - 1)):
        place = jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in files.listStatus(place):
            found = status.getPath().getName()
            if found.startswith(f"{name}=") and int(found.partition("=")[2]) <= last:
                files.delete(status.getPath(), True)


def route_by_type(stream: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> list[StreamingQuery]:
    """Events once by type and once all together."""
    return [
        start(stream, f"{path}/by_type", f"{checkpoint}/by_type", interval=interval, partitions=["event_type"]),
        start(stream, f"{path}/all", f"{checkpoint}/all", interval=interval),
    ]


def counters_to_table(aggregate: DataFrame, path: str, checkpoint: str, key: str, interval: str | None = None,
                      buckets: int = 64) -> StreamingQuery:
    """Latest row per key of a running aggregate (update mode), merged by key; the newest batch wins."""

    def flush(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("bucket", F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")).withColumn(
            "batch_id", F.lit(batch_id).cast("bigint"))
        upsert_partitioned(rows, path, [key], "batch_id", ["bucket"])

    return each_batch(aggregate, flush, checkpoint, interval, "update")


def run_recommender(
    stream: DataFrame, path: str, checkpoint: str, min_ratings: int = 100, n: int = 10, seed: int = 7,
    interval: str | None = None, compact_every: int = 100,
) -> StreamingQuery:
    """Events -> bronze table and rating sums; ALS and trending snapshots after every micro-batch.

    Rating sums are kept as one small partition per batch and added up on reading; every `compact_every` batches they
    are folded into one. ALS runs from `min_ratings` rated
    pairs on. Events need event_id, user_id, product_id, event_type and `ts` (timestamp without zone).
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = fresh_events(batch, path, batch_id)
        if rows.isEmpty():
            return
        append_batch(rows, f"{path}/events", batch_id, ("event_date",))
        rows = rows.drop("event_date")
        append_batch(interactions(rows), f"{path}/rating_sums", batch_id)
        if batch_id % compact_every == compact_every - 1:
            compact_sums(spark, path, batch_id)
        events = spark.read.parquet(f"{path}/events")
        as_of = latest_time(spark, path, rows)
        ratings = rating_table(spark, path)
        if ratings.limit(min_ratings + 1).count() > min_ratings:
            recs = als_recommendations(ratings, n, seed)
            payload = recs.groupBy("user_id").agg(
                F.array_sort(F.collect_list(F.struct("rank", "product_id", "score"))).alias("recommendations"))
            write_snapshot(payload, f"{path}/recommendations", "user_id", 3600, as_of)
        last_day = events.filter(F.col("event_date") >= F.date_sub(F.lit(as_of.date()), 1))
        write_trending(behavior.trending(last_day, as_of + timedelta(microseconds=1)), f"{path}/trending", as_of)

    return each_batch(stream, process, checkpoint, interval)


def write_trending(trending: DataFrame, path: str, as_of) -> None:
    """The trending list as one snapshot entry (at most `limit` rows in it)."""
    payload = trending.select(F.struct(
        (-F.col("trending_score")).alias("k"), "product_id", F.col("trending_score").alias("score"),
        F.col("total_interactions").alias("interactions"), "unique_users", "purchases").alias("item"))
    listed = payload.agg(F.array_sort(F.collect_list("item")).alias("products")).withColumn(
        "products", F.transform("products", lambda p: p.dropFields("k")))
    write_snapshot(listed.withColumn("name", F.lit("trending_products")), path, "name", 300, as_of, buckets=1)


def interaction_sums(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """Weight and number per user and product over all batches: the last fold plus the batches after it."""
    base = read_if_exists(spark, f"{path}/rating_base")
    if base is not None and upto is not None:
        base = base.filter(F.col("version") < upto)
    folded = None if base is None else base.agg(F.max("version").alias("v")).first()["v"]
    parts = spark.read.parquet(f"{path}/rating_sums")
    if upto is not None:
        parts = parts.filter(F.col("batch_id") <= upto)
    parts = parts if folded is None else parts.filter(F.col("batch_id") > folded)
    rows = parts.select("user_id", "product_id", "weight", "n")
    if folded is not None:
        rows = rows.unionByName(base.filter(F.col("version") == folded).select(*rows.columns))
    return rows.groupBy("user_id", "product_id").agg(F.sum("weight").alias("weight"), F.sum("n").alias("n"))


def compact_sums(spark: SparkSession, path: str, batch_id: int) -> None:
    """Folds the sums of all batches up to this one. Nothing read is overwritten, and a repeated fold is the same."""
    before = read_if_exists(spark, f"{path}/rating_base")
    last = None if before is None else before.filter(F.col("version") < batch_id).agg(F.max("version").alias("v")).first()["v"]
    interaction_sums(spark, path, batch_id).withColumn("version", F.lit(batch_id).cast("bigint")).write.mode(
        "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{path}/rating_base")
    if last is not None:  # the fold before this one stays for readers that began with it
        drop_folded(spark, path, last)


def rating_table(spark: SparkSession, path: str) -> DataFrame:
    """Ratings from the sums of all batches; equal to the ratings of all events."""
    average = F.col("weight") / F.col("n")
    return interaction_sums(spark, path).select(
        "user_id", "product_id", average.alias("avg_rating"), F.col("n").alias("interaction_count"),
        (average * F.log(F.col("n") + F.lit(1.0))).alias("final_rating"))


def flush_affinity(stream: DataFrame, path: str, checkpoint: str, n: int = 10, interval: str | None = None,
                   compact_every: int = 100, versioned: bool = False) -> StreamingQuery:
    """Keeps the interaction sums and rewrites the affinity recommendations after every micro-batch: in one folder, or as
    a versioned table, whose readers always find a whole list."""

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        append_batch(interactions(fresh_events(batch, path, batch_id).drop("event_date")), f"{path}/rating_sums", batch_id)
        if batch_id % compact_every == compact_every - 1:
            compact_sums(spark, path, batch_id)
        pairs = interaction_sums(spark, path)
        popular = pairs.groupBy("product_id").agg(F.sum("n").alias("n"))
        lists = affinity_from_pairs(pairs, popular, n)
        if not versioned:
            lists.write.mode("overwrite").parquet(f"{path}/recommendations")
            return
        table = VersionedTable(spark, f"{path}/recommendations")
        table.replace(lists)
        table.vacuum(keep=2)  # readers that began with the list before this one can end

    return each_batch(stream, process, checkpoint, interval)


def once_in_state(stream: DataFrame, delay: str, ts: str = "timestamp") -> DataFrame:
    """Each event once, by ids in the state store: a batch looks up its own ids only, whatever its days have seen, and
    an id goes when the watermark has passed its event by `delay`. Events without an id cannot be told apart and pass."""
    marked = stream.withWatermark(ts, delay)
    named = marked.filter("event_id IS NOT NULL").dropDuplicatesWithinWatermark(["event_id"])
    return named.unionByName(marked.filter("event_id IS NULL"))


def derive_tables(stream: DataFrame, path: str, checkpoint: str, interval: str | None = None,
                  remember: str | None = None) -> StreamingQuery:
    """Events -> orders and lines, cart increments, behaviour log.

    Repeated deliveries are found among the stored ids of a batch's days, however late they come; with `remember` among
    the ids in the state store instead, which are kept for that long: no batch then reads what earlier ones wrote.
    """
    stream = stream if remember is None else once_in_state(stream, remember)

    def process(batch: DataFrame, batch_id: int) -> None:
        rows = fresh_events(batch, path, batch_id).drop("event_date") if remember is None else materialize(batch)
        orders, items = behavior.orders_from_purchases(rows)
        append_batch(orders, f"{path}/orders", batch_id)
        append_batch(items, f"{path}/order_items", batch_id)
        append_batch(behavior.cart_upsert(None, rows), f"{path}/cart_increments", batch_id)
        append_batch(behavior.behavior_log(rows), f"{path}/user_behavior_log", batch_id)

    return each_batch(stream, process, checkpoint, interval)


def cart_table(spark: SparkSession, path: str) -> DataFrame:
    """Cart as the sum of all increments."""
    return spark.read.parquet(f"{path}/cart_increments").groupBy("user_id", "product_id").agg(
        F.sum("quantity").alias("quantity"), F.max("added_at").alias("added_at"))


def run_orders_etl(t, spark: SparkSession, path: str, as_of=None, buckets: int = 64, versioned: bool = False) -> bool:
    """One incremental run: documents since the stored mark into the lake (by load hour, parquet and JSON) and into the
    keyed document table (with `versioned` one whose readers see whole runs only). False when there was nothing to do.
    The mark moves after the writes, so a failed run repeats.
    """
    mark = read_mark(spark, f"{path}/mark")
    keyed = VersionedTable(spark, f"{path}/documents") if versioned else None
    before = keyed.read() if keyed else read_if_exists(spark, f"{path}/documents")
    loaded = None
    if mark is not None and before is not None:
        # Orders with the very time of the mark are read again; those that were loaded in this state drop out.
        time = F.greatest("created_at", "updated_at").alias("_time")
        loaded = before.select("order_id", time).filter(F.col("_time") == at(mark))
    documents = etl.order_documents(t, mark, as_of, at_mark=True, without=loaded)
    # The documents come from a join by order_id, so that one per order takes no further shuffle.
    latest = keep_last(documents, ["order_id"], [F.col("etl_timestamp")])
    with settings(spark, DROP_SHUFFLES), stored(latest) as documents:
        if documents.isEmpty():
            return False
        hours = ["year", "month", "day", "hour"]
        dated = etl.sink_partitions(documents)
        upsert_partitioned(dated, f"{path}/lake", ["order_id"], "etl_timestamp", hours, unique=True)
        upsert_partitioned(dated, f"{path}/json", ["order_id"], "etl_timestamp", hours, "json", unique=True)
        bucketed = documents.withColumn("bucket", F.pmod(F.xxhash64("order_id"), F.lit(buckets)).cast("int"))
        if keyed:
            keyed.upsert(bucketed, ["order_id"], "etl_timestamp", ["bucket"], unique=True)
            keyed.vacuum(keep=2)
        else:
            upsert_partitioned(bucketed, f"{path}/documents", ["order_id"], "etl_timestamp", ["bucket"], unique=True)
        write_mark(spark, f"{path}/mark", next_mark(documents))
    return True


def ingest_log(lines: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Log lines -> parsed table partitioned by day."""
    parsed = parse_sql_log(lines).withColumn("log_date", F.to_date("log_timestamp"))
    return start(parsed, path, checkpoint, interval=interval, partitions=["log_date"])
