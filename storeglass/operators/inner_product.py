"""The n items of highest inner product for every user, exactly, without scoring all pairs.

Items are put into cells by k-means over their vectors; a cell of more than PACK items is dealt over several, and up to
PACK items in all are one cell. A cell knows
its centre c and the distance r of its farthest item, so no item in it can exceed u.c + |u| r for a user u. Each user
first visits the cells of highest bound, until they hold enough items; the n-th score found is then the least that
matters, and of the other cells only those whose bound reaches it are visited. What is left out can't be in the list.

Users travel to cells, never all items to all users: visits are shuffled by cell, a cell with very many visitors is
repeated over several tasks. Only the list of cells is broadcast, a few numbers for each PACK items or more.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from storeglass.operators.materialize import materialize
from storeglass.operators.ranking import top_per_group

#: Items of a cell at most, about; visitors of a cell in one task; cells visited first; cells of the clustering at most.
PACK, VISITORS, FIRST, CELLS = 4096, 50_000, 2, 1024
#: Scores are rounded to so many digits, so that equal ones are settled by the item.
DIGITS = 6


class Cells:
    """Centres, radii and sizes; bounds of users' scores."""

    def __init__(self, rows: list):
        self.numbers = np.array([r["cell"] for r in rows], np.int64)
        self.centres = np.array([r["centre"] for r in rows], np.float64)
        self.radii = np.array([r["radius"] for r in rows], np.float64)
        self.sizes = np.array([r["n"] for r in rows], np.int64)

    def bounds(self, users: np.ndarray) -> np.ndarray:
        """A margin covers rounding, in the sums and to DIGITS."""
        norms = np.linalg.norm(users, axis=1)[:, None]
        reach = norms * (np.linalg.norm(self.centres, axis=1) + self.radii)
        return users @ self.centres.T + norms * self.radii + 1e-9 * reach + 10.0**-DIGITS


def _vectors(column) -> np.ndarray:
    lengths = len(column) and len(column[0])
    return np.asarray(pa.chunked_array([column]).combine_chunks().flatten(), np.float64).reshape(len(column), lengths)


def cells_of(items: DataFrame, pack: int, seed: int) -> tuple[DataFrame, Cells]:
    """items (id, vector) with their cell, and the cells."""
    n = items.count()
    if n <= pack:  # one matrix that any task can hold: nothing to be gained by parting it
        norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
        rows = items.agg(F.lit(0).alias("cell"), F.transform(F.first("vector"), lambda x: F.lit(0.0)).alias("centre"),
                         F.max(norm).alias("radius"), F.count("*").alias("n")).collect()
        return items.withColumn("cell", F.lit(0).cast("long")), Cells(rows)
    vectors = items.withColumn("_v", array_to_vector("vector"))
    model = KMeans(k=min(max(isqrt(n), 2), CELLS), seed=seed, featuresCol="_v", predictionCol="_k", maxIter=10, solver="row").fit(vectors)
    spark = items.sparkSession
    centres = spark.createDataFrame([(k, [float(x) for x in c]) for k, c in enumerate(model.clusterCenters())], "_k int, centre array<double>")
    placed = model.transform(vectors).drop("_v")
    sizes = placed.groupBy("_k").agg(F.count("*").alias("_n"))  # CELLS rows at most
    known = centres.join(sizes, "_k").withColumn("_parts", F.ceil(F.col("_n") / pack))
    part = F.pmod(F.xxhash64("id"), F.col("_parts"))
    away = F.sqrt(F.aggregate(F.zip_with("vector", "centre", lambda x, c: (x - c) * (x - c)), F.lit(0.0), lambda s, d: s + d))
    placed = materialize(placed.join(F.broadcast(known), "_k").select(
        "id", "vector", (F.col("_k") * (1 << 32) + part).alias("cell"), "centre", away.alias("_away")))
    rows = placed.groupBy("cell").agg(
        F.first("centre").alias("centre"), F.max("_away").alias("radius"), F.count("*").alias("n")).orderBy("cell").collect()
    return placed.select("id", "vector", "cell"), Cells(rows)


def _first_cells(users: DataFrame, cells: Cells, n: int, first: int) -> DataFrame:
    """id, vector, cells: for each user those of highest bound, `first` of them and enough to hold n items."""
    shared = users.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(-known.bounds(_vectors(batch.column(1))), axis=1, kind="stable")
            held = np.cumsum(known.sizes[order], axis=1)
            taken = np.maximum((held < n).sum(axis=1) + 1, first)
            chosen = [known.numbers[row[:k]] for row, k in zip(order, taken, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chosen, pa.list_(pa.int64()))], names=["id", "vector", "cells"])

    return users.select("id", "vector").mapInArrow(run, "id long, vector array<double>, cells array<long>")


def _other_cells(users: DataFrame, cells: Cells) -> DataFrame:
    """The cells that may still matter to users (id, vector, cells, least), without those they have visited."""
    shared = users.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            open_cells = known.bounds(_vectors(batch.column(1))) >= np.asarray(batch.column(3))[:, None]
            chosen = [np.setdiff1d(known.numbers[row], seen.as_py()) for row, seen in zip(open_cells, batch.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(chosen, pa.list_(pa.int64()))], names=["id", "vector", "cells"])

    return users.select("id", "vector", "cells", "least").mapInArrow(run, "id long, vector array<double>, cells array<long>")


def _visited(visits: DataFrame, items: DataFrame, n: int, visitors: int) -> DataFrame:
    """user, item, score: the n best items of every cell for each of its visitors (id, vector, cell)."""
    salts = visits.groupBy("cell").agg(F.ceil(F.count("*") / visitors).cast("int").alias("salts"))  # a row per cell
    packed = items.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("id", "vector"))).alias("e"))
    packed = packed.join(salts, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("user"),
        F.transform("e", lambda e: e["id"]).alias("ids"), F.flatten(F.transform("e", lambda e: e["vector"])).alias("vector"))
    asking = visits.join(F.broadcast(salts), "cell").select(
        "cell", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("kind"), F.col("id").alias("user"),
        F.lit(None).cast("array<long>").alias("ids"), "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = matrix = None
        for batch in batches:
            edges = [*np.flatnonzero(np.diff(np.asarray(batch.column(2)), prepend=2)), batch.num_rows]
            for low, high in zip(edges, edges[1:], strict=False):
                part = batch.slice(low, high - low)
                if part.column(2)[0].as_py() == 0:  # the last one counts; a cell nobody visits can't occur
                    last = part.num_rows - 1
                    ids = np.array(part.column(4)[last].as_py(), np.int64)
                    matrix = np.array(part.column(5)[last].as_py(), np.float64).reshape(len(ids), -1)
                    continue
                users = np.asarray(part.column(3))
                for start in range(0, len(users), 512):
                    vectors = _vectors(part.column(5).slice(start, 512))
                    scores = np.round(vectors @ matrix.T, DIGITS)
                    k = min(n, len(ids))
                    best = np.argsort(-scores, axis=1, kind="stable")[:, :k]  # ids ascend, so do they where scores are equal
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(users[start : start + 512], k)), pa.array(ids[best].ravel()),
                        pa.array(np.take_along_axis(scores, best, axis=1).ravel())], names=["user", "item", "score"])

    rows = packed.unionByName(asking).repartition("cell", "salt").sortWithinPartitions("cell", "salt", "kind")
    return rows.select("cell", "salt", "kind", "user", "ids", "vector").mapInArrow(run, "user long, item long, score double")


def top_by_inner_product(
    users: DataFrame, items: DataFrame, n: int, pack: int | None = None, visitors: int = VISITORS, first: int = FIRST, seed: int = 7,
    report: dict | None = None,
) -> DataFrame:
    """user, rank, item, score (rounded) from users and items (id, vector): n items each, equal scores by item.

    `report`, if given, gets the numbers of `pairs` and of pairs `scored`.
    """
    pack = pack or PACK
    typed = lambda df: df.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
    users, items = typed(users), materialize(typed(items))
    if items.isEmpty():
        return users.select(F.col("id").alias("user"), F.lit(1).alias("rank"), F.col("id").alias("item"), F.lit(0.0).alias("score")).limit(0)
    items, cells = cells_of(items, pack, seed)
    best_first = [F.desc("score"), F.asc("item")]
    begun = materialize(_first_cells(users, cells, n, first))
    visits = begun.select("id", "vector", F.explode("cells").alias("cell"))
    found = materialize(top_per_group(_visited(visits, items, n, visitors), ["user"], best_first, n))
    least = found.filter(F.col("rank") == n).select(F.col("user").alias("id"), F.col("score").alias("least"))
    further = _other_cells(begun.join(least, "id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf")))), cells)
    more = materialize(further.select("id", "vector", F.explode("cells").alias("cell")))
    if report is not None:
        held = users.sparkSession.createDataFrame([(int(c), int(s)) for c, s in zip(cells.numbers, cells.sizes)], "cell long, n long")
        scored = visits.select("cell").unionByName(more.select("cell")).join(F.broadcast(held), "cell").agg(F.sum("n")).first()[0]
        report |= {"pairs": users.count() * int(cells.sizes.sum()), "scored": scored or 0}
    rows = found.drop("rank").unionByName(_visited(more, items, n, visitors))
    return top_per_group(rows, ["user"], best_first, n).select("user", "rank", "item", "score")
