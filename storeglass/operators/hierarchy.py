"""Trees kept as rows with a parent: levels and paths from the roots down."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from storeglass.operators.lookup import lookup_join
from storeglass.operators.materialize import materialize


def walk_tree(
    nodes: DataFrame, key: str, parent: str, name: str, max_depth: int | None = 10, method: str = "recursive", once: bool = False
) -> DataFrame:
    """key, name, level (1 for roots, whose parent is null), path ("A > B"), id_path for all nodes below a root.

    `recursive` is one WITH RECURSIVE statement: right for trees within the engine's bounds of levels and rows
    (spark.sql.cteRecursionLevelLimit, ...RowLimit) and without cycles, which it would follow down to `max_depth`.

    `fixpoint` goes level by level from a stored frontier: its children are looked up among the nodes, those that stand
    on their own path are left out, so a cycle ends where it closes, and it goes on until no child is found or
    `max_depth` is reached (None: no bound). A level's rows are written and read once; the frontier is the lookup side,
    broadcast while it is small, else joined with salts, so that one parent of very many nodes is spread over tasks.
    `once` keeps a visited set: a node with several parents is listed at its first level only, by its smallest path.
    """
    if method == "recursive":
        return nodes.sparkSession.sql(
            f"""
            WITH RECURSIVE walk ({key}, {name}, level, path, id_path) AS (
                SELECT {key}, {name}, 1, {name}, array({key}) FROM {{tree}} WHERE {parent} IS NULL
                UNION ALL
                SELECT child.{key}, child.{name}, walk.level + 1, concat(walk.path, ' > ', child.{name}),
                       concat(walk.id_path, array(child.{key}))
                FROM walk JOIN {{tree}} child ON child.{parent} = walk.{key}
                WHERE walk.level < {{depth}}
            )
            SELECT * FROM walk
            """,
            tree=nodes, depth=max_depth,
        )
    nodes = nodes.select(key, parent, name)
    first = nodes.filter(F.col(parent).isNull()).select(
        key, name, F.lit(1).alias("level"), F.col(name).alias("path"), F.array(key).alias("id_path"))
    below = nodes.filter(F.col(parent).isNotNull()).select(F.col(key).alias("_key"), F.col(name).alias("_name"), F.col(parent).alias(key))
    levels: list[DataFrame] = []
    frontier = materialize(_first_path(first, key) if once else first)
    while not frontier.isEmpty():
        levels.append(frontier)
        if max_depth is not None and len(levels) >= max_depth:
            break
        # Several rows of a node (one per path) would break the lookup's rule of one row per key.
        found = lookup_join(below, frontier, key, spread_by="_key") if once else below.join(frontier, key)
        children = found.filter(~F.array_contains("id_path", F.col("_key"))).select(
            F.col("_key").alias(key), F.col("_name").alias(name), (F.col("level") + 1).alias("level"),
            F.concat_ws(" > ", "path", "_name").alias("path"), F.concat("id_path", F.array("_key")).alias("id_path"))
        if once:
            visited = reduce(DataFrame.unionByName, (level.select(key) for level in levels))
            children = _first_path(children.join(visited, key, "left_anti"), key)
        frontier = materialize(children)
    return reduce(DataFrame.unionByName, levels) if levels else first


def _first_path(rows: DataFrame, key: str) -> DataFrame:
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct("path", "id_path")).alias("_r")).select(key, "_r.*").select(*rows.columns)
