"""Recommendations: from own history filled with popular products, and by matrix factorisation."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, functions as F

from storeglass.functions.exprs import RATING_WEIGHTS, exact_round, weight_of
from storeglass.operators.inner_product import top_by_inner_product
from storeglass.operators.lookup import enrich_rows, lookup_join
from storeglass.operators.ranking import global_positions, top_per_group


def interactions(events: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Sum of weights per user and product."""
    weights = RATING_WEIGHTS if weights is None else weights
    return events.groupBy("user_id", "product_id").agg(
        F.sum(weight_of("event_type", weights, 1.0)).alias("weight"), F.count("*").alias("n"))


def affinity_recommendations(events: DataFrame, n: int = 10, users: DataFrame | None = None) -> DataFrame:
    """n products per user from events: own ones by weight, then popular unseen ones."""
    # Popularity is a second scan of one column that combines map-side; taking it from the pairs would keep both of
    # their measures in the big shuffle.
    popular = events.groupBy("product_id").agg(F.count("*").alias("n"))
    return affinity_from_pairs(interactions(events), popular, n, users)


def affinity_from_pairs(pairs: DataFrame, popular: DataFrame, n: int = 10, users: DataFrame | None = None) -> DataFrame:
    """The same from kept sums: pairs (user_id, product_id, weight) and popular (product_id, n).

    A user with k < n own products has seen at most k of the n most popular ones, so these n suffice for the fill; they
    travel as one literal-size list, not as a join. With `users`, users without history get popular products only.
    """
    own = top_per_group(pairs.select("user_id", "product_id", "weight"), ["user_id"],
                        [F.desc("weight"), F.asc("product_id")], n)
    # At most n entries per user.
    entry = F.struct("rank", "product_id", exact_round(F.least(F.lit(5.0), F.col("weight") / 2), 2).alias("score"))
    lists = own.groupBy("user_id").agg(F.array_sort(F.collect_list(entry)).alias("own"))
    popular = popular.orderBy(F.desc("n"), "product_id").limit(n)
    ranked = F.struct((-F.col("n")).alias("k"), F.col("product_id").alias("product_id"), F.col("n").alias("n"))
    top = popular.agg(F.array_sort(F.collect_list(ranked))).scalar()
    if users is not None:
        lists = users.select("user_id").join(lists, "user_id", "left")
    seen = F.transform("own", lambda e: e["product_id"])
    fill = F.filter("_top", lambda p: ~F.array_contains(F.col("_seen"), p["product_id"]))
    known = F.transform("own", lambda e: F.struct(e["product_id"].alias("product_id"), e["score"].alias("score")))
    scored = lambda cap, divisor: lambda p: F.struct(
        p["product_id"].alias("product_id"), exact_round(F.least(F.lit(cap), p["n"] / divisor), 2).alias("score"))
    filled = F.slice(F.concat(known, F.transform(fill, scored(4.0, 15))), 1, n)
    out = lists.withColumn("_top", top).withColumn("_seen", seen)
    recs = F.when(F.col("own").isNull(), F.transform("_top", scored(5.0, 10))).otherwise(filled)
    return out.select("user_id", F.posexplode(recs).alias("_pos", "_rec")).select(
        "user_id", (F.col("_pos") + 1).alias("rank"), "_rec.product_id", "_rec.score")


def dense_ids(values: DataFrame, column: str, out: str) -> DataFrame:
    """Integer ids 0 .. n-1 for the distinct values of a column, numbered without a single-task window."""
    placed = global_positions(values.select(column).filter(F.col(column).isNotNull()).distinct(), [F.asc(column)])
    return placed.select(column, (F.col("position") - 1).cast("int").alias(out))


def als_recommendations(ratings: DataFrame, n: int = 10, seed: int = 7, report: dict | None = None) -> DataFrame:
    """Top n products per user by alternating least squares; ids are translated by joins, never on the driver. The lists
    are those of all users by all products, found without scoring all pairs (`report` gets the numbers)."""
    users = dense_ids(ratings, "user_id", "user_index")
    products = dense_ids(ratings, "product_id", "product_index")
    indexed = lookup_join(ratings.select("user_id", "product_id", "final_rating"), users, "user_id", spread_by="product_id")
    indexed = lookup_join(indexed, products, "product_id", spread_by="user_id")
    model = ALS(maxIter=10, regParam=0.1, seed=seed, userCol="user_index", itemCol="product_index",
                ratingCol="final_rating", coldStartStrategy="drop").fit(indexed)
    vectors = lambda factors: factors.select("id", F.col("features").alias("vector"))
    recs = top_by_inner_product(vectors(model.userFactors), vectors(model.itemFactors), n, seed=seed, report=report).select(
        F.col("user").cast("int").alias("user_index"), "rank", F.col("item").cast("int").alias("product_index"), "score")
    named = lookup_join(recs, products, "product_index", spread_by="user_index").join(users, "user_index")
    return named.select("user_id", "rank", "product_id", "score")


def enrich(snapshot: DataFrame, products: DataFrame, limit: int, order: list, per: str | None = None) -> DataFrame:
    """Product fields for the first `limit` entries of a snapshot (of each `per`); unknown products drop out."""
    if per:
        # A snapshot that carries its ranks needs no ranking.
        shown = (snapshot.filter(F.col("rank") <= limit) if "rank" in snapshot.columns
                 else top_per_group(snapshot, [per], order, limit, "_shown").drop("_shown"))
        return lookup_join(shown, products, "product_id", spread_by=per)
    return enrich_rows(snapshot.orderBy(*order).limit(limit), products, "product_id", limit)
