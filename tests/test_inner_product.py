"""Exact top lists against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from storeglass.operators import inner_product
from storeglass.operators.inner_product import top_by_inner_product

VECTORS = "id long, vector array<float>"


def frame(spark, vectors, start=0):
    return spark.createDataFrame([(start + k, [float(x) for x in v]) for k, v in enumerate(vectors)], VECTORS).repartition(3)


def plain(users, items, n, start):
    scores = np.round(users.astype(np.float32).astype(float) @ items.astype(np.float32).astype(float).T, 6)
    out = []
    for u, row in enumerate(scores):
        order = sorted(range(len(row)), key=lambda k: (-row[k], k))[:n]
        out += [(u, rank + 1, start + k, row[k]) for rank, k in enumerate(order)]
    return out


def clustered(draw, n, groups, width=6, spread=0.1):
    return draw.normal(size=(groups, width))[draw.integers(groups, size=n)] + spread * draw.normal(size=(n, width))


@pytest.mark.parametrize("n_items,n,pack,visitors", [(400, 10, 4096, 50_000), (400, 10, 7, 20), (400, 60, 30, 5), (5, 10, 4096, 3), (2, 3, 1, 1)])
def test_equal_to_all_pairs(spark, n_items, n, pack, visitors):
    draw = np.random.default_rng(n_items + n)
    users, items = clustered(draw, 90, 12), clustered(draw, n_items, 12)
    if n_items > 5:
        items[7], items[50:60], users[3] = items[8], items[50], 0  # ties, and a user to whom all are equal
    report = {}
    found = top_by_inner_product(frame(spark, users), frame(spark, items, 1000), n, pack, visitors, report=report)
    got = sorted((r["user"], r["rank"], r["item"], r["score"]) for r in found.collect())
    want = plain(users, items, n, 1000)
    assert [g[:3] for g in got] == [w[:3] for w in want] and np.allclose([g[3] for g in got], [w[3] for w in want])
    assert report["pairs"] == 90 * n_items and report["scored"] <= report["pairs"]


def test_most_pairs_are_not_scored(spark):
    draw = np.random.default_rng(1)
    users, items = clustered(draw, 200, 40, 10, 0.05), clustered(draw, 3000, 40, 10, 0.05)
    report = {}
    found = top_by_inner_product(frame(spark, users), frame(spark, items), 10, pack=500, report=report).count()
    assert found == 2000 and report["scored"] < 0.25 * report["pairs"], report


def test_empty(spark):
    some, none = frame(spark, np.ones((2, 3))), frame(spark, np.ones((1, 3))).limit(0)
    assert top_by_inner_product(some, none, 3).collect() == [] == top_by_inner_product(none, some, 3).collect()


@pytest.mark.parametrize("pack", [9, 4096])
def test_factorisation_lists_are_those_of_all_pairs(spark, monkeypatch, pack):
    """als_recommendations against the same model's lists over all pairs, on the given events."""
    from pyspark.ml.recommendation import ALS

    from storeglass.plans.behavior import ratings
    from storeglass.plans.recommend import als_recommendations, dense_ids
    from storeglass.sources.retail import StarTables

    rated = ratings(StarTables(spark, "/root/testdata/sf0.01").events).cache()
    monkeypatch.setattr(inner_product, "PACK", pack)
    report = {}
    got = {(r["user_id"], r["rank"]): r for r in als_recommendations(rated, 10, report=report).collect()}
    users, products = dense_ids(rated, "user_id", "user_index"), dense_ids(rated, "product_id", "product_index")
    indexed = rated.join(users, "user_id").join(products, "product_id")
    model = ALS(maxIter=10, regParam=0.1, seed=7, userCol="user_index", itemCol="product_index", ratingCol="final_rating",
                coldStartStrategy="drop").fit(indexed)
    want = model.recommendForAllUsers(10).join(users, "user_index").selectExpr("user_id", "posexplode(recommendations) as (pos, rec)").collect()
    assert len(got) == len(want) > 1000
    for r in want:
        assert abs(got[r["user_id"], r["pos"] + 1]["score"] - r["rec"]["rating"]) < 1e-4
    assert report["scored"] <= report["pairs"]
