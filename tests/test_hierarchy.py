"""Tree walks: cycles, deep chains, more nodes than the engine's recursion allows, several parents."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from storeglass.operators import lookup
from storeglass.operators.hierarchy import walk_tree

NODES = "id long, name string, parent long"


def walk(nodes, **options):
    return walk_tree(nodes, "id", "parent", "name", **options)


def rows(df):
    return sorted((r["id"], r["level"], r["path"], tuple(r["id_path"])) for r in df.collect())


@pytest.mark.parametrize("once", [False, True])
def test_fixpoint_equals_recursion_on_a_tree(spark, once):
    nodes = spark.createDataFrame([(1, "A", None), (2, "B", None)] + [(k, f"n{k}", k // 3 + 1 if k > 5 else 1) for k in range(3, 60)], NODES)
    for depth in (1, 2, 10):
        assert rows(walk(nodes, max_depth=depth, method="fixpoint", once=once)) == rows(walk(nodes, max_depth=depth))


def test_deep_chain(spark):
    nodes = spark.createDataFrame([(k, f"n{k}", k - 1 if k else None) for k in range(30)], NODES)
    found = rows(walk(nodes, max_depth=None, method="fixpoint"))
    assert [r[1] for r in found] == list(range(1, 31)) and found[-1][3] == tuple(range(30))
    assert found[-1][2] == " > ".join(f"n{k}" for k in range(30))


def test_cycles_end(spark):
    """A ring without a root is no part of the walk; one that hangs on a root is walked once around."""
    ring = [(10, "x", 11), (11, "y", 10)]
    hung = [(1, "root", None), (2, "a", 1), (3, "b", 2), (4, "c", 3), (2, "a", 4), (5, "self", 5)]
    nodes = spark.createDataFrame(ring + hung, NODES)
    want = [(1, 1, "root", (1,)), (2, 2, "root > a", (1, 2)), (3, 3, "root > a > b", (1, 2, 3)), (4, 4, "root > a > b > c", (1, 2, 3, 4))]
    for once in (False, True):
        assert rows(walk(nodes, max_depth=None, method="fixpoint", once=once)) == want


def test_several_parents(spark):
    nodes = spark.createDataFrame([(1, "A", None), (2, "B", 1), (3, "C", 1), (4, "D", 2), (4, "D", 3), (4, "D", 1), (5, "E", 4)], NODES)
    paths = lambda **o: sorted(r["path"] for r in walk(nodes, method="fixpoint", **o).filter("id >= 4").collect())
    assert paths() == ["A > B > D", "A > B > D > E", "A > C > D", "A > C > D > E", "A > D", "A > D > E"]
    assert paths(once=True) == ["A > D", "A > D > E"]


def test_more_nodes_than_the_recursion_allows(spark):
    limit = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "500")
    try:
        nodes = spark.range(2000).select("id", F.concat(F.lit("n"), F.col("id")).alias("name"), F.when(F.col("id") > 0, F.expr("(id - 1) div 10")).alias("parent"))
        with pytest.raises(Exception, match="RECURSION"):
            walk(nodes).collect()
        found = walk(nodes, max_depth=None, method="fixpoint")
        assert found.count() == 2000 and found.agg(F.max("level")).first()[0] == 5
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", limit)


def test_a_parent_of_most_nodes_is_joined_with_salts(spark, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    nodes = spark.range(3000).select("id", F.col("id").cast("string").alias("name"), F.when(F.col("id") > 0, F.lit(0)).alias("parent"))
    found = walk(nodes, method="fixpoint", once=True)
    assert found.count() == 3000 and found.filter("level = 2").count() == 2999


def test_no_roots(spark):
    assert walk(spark.createDataFrame([(1, "a", 2), (2, "b", 1)], NODES), method="fixpoint", max_depth=None).collect() == []
