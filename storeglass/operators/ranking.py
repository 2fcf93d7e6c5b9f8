"""Ranks and positions that do not need one task to see everything."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from storeglass.operators.materialize import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its lower 33 bits


def top_per_group(
    df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank", skip: int = 0
) -> DataFrame:
    """Rows `skip`+1 .. `skip`+k of each group.

    The `<=` bound lets Catalyst cut every group to its best rows before the shuffle (WindowGroupLimit), so a hot group
    sends at most skip + k rows per map task. Beyond the bound up to which it does so, distributed positions are used.
    `order` should be total.
    """
    cut = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if skip + k < cut:
        window = Window.partitionBy(*keys).orderBy(*order)
        ranked = df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= skip + k)
    else:
        ranked = group_positions(df, keys, order, rank).withColumn(rank, F.col(rank).cast("int")).filter(F.col(rank) <= skip + k)
    return ranked.filter(F.col(rank) > skip) if skip else ranked


def global_positions(df: DataFrame, order: list[Column], position: str = "position") -> DataFrame:
    """row_number() over the whole frame without a single-task window.

    Range partitioning puts the rows in order across partitions, a sort inside each partition in order within it; the
    position is the row number in the partition plus the rows of all lower partitions. The frame is materialised in
    between, as the partition bounds come from sampling and both reads must see the same ones. `order` has to be a
    total order, which also spreads equal leading keys over partitions.
    """
    ids = F.monotonically_increasing_id()
    placed = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", ids)
    )
    placed = placed.select(
        "*",
        F.shiftright("_id", _ROW_BITS).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    # One row per partition: bounded by the number of tasks, whatever the data.
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(offsets), "_part").withColumn(
        position, F.col("_before") + F.col("_row") + 1
    ).drop("_id", "_part", "_row", "_before")


def group_positions(df: DataFrame, keys: list[str], order: list[Column], position: str = "position") -> DataFrame:
    """row_number() over (partition by keys order by order) where a group may hold a large share of all rows."""
    # Positions come from a checkpoint, so reading them twice gives the same rows.
    placed = global_positions(df, [F.col(k).asc_nulls_first() for k in keys] + order, "_global")
    starts = placed.groupBy(*keys).agg(F.min("_global").alias("_start"))
    if len(keys) == 1:
        matched = placed.alias("p").join(
            starts.alias("s"), F.col(f"p.{keys[0]}").eqNullSafe(F.col(f"s.{keys[0]}"))
        ).select("p.*", "s._start")
    else:
        matched = placed.join(starts, keys)
    return matched.withColumn(position, F.col("_global") - F.col("_start") + 1).drop("_global", "_start")


def probe_ranks(
    probes: DataFrame, facts: DataFrame, group: str | None, value: str, rank: str,
    less: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """RANK() of a few probe values among all facts of their group, largest first, with one pass over the facts.

    Every fact only counts how many probe values it exceeds; these counters are summed map-side. The facts are neither
    sorted nor shuffled by group. `probes` must be bounded (a top-k result); returns one row per (group, probe value).
    `value` may be a struct, which gives ROW_NUMBER() with a tie-break; `less(a, b)` is an order of its own for the values.
    """
    if less is None:
        less, cuts = (lambda a, b: a < b), F.sort_array(F.collect_set(value)).alias("_cuts")
    else:
        compare = lambda a, b: F.when(less(a, b), -1).when(less(b, a), 1).otherwise(0)
        cuts = F.array_sort(F.collect_set(value), compare).alias("_cuts")
    if group is None:
        bounds = probes.agg(cuts)
        seen = facts.withColumn("_cuts", bounds.scalar())
        keys = []
    else:
        bounds = probes.groupBy(group).agg(cuts)
        seen = facts.join(F.broadcast(bounds), group)
        keys = [group]
    passed = F.size(F.filter("_cuts", lambda cut: less(cut, F.col(value))))
    counters = (
        seen.select(*keys, passed.alias("_above")).filter("_above > 0")
        .groupBy(*keys, "_above").agg(F.count("*").alias("_n"))
    )
    return ranks_from_counters(bounds, counters, keys, value, rank)


def ranks_from_counters(bounds: DataFrame, counters: DataFrame, keys: list[str], value: str, rank: str) -> DataFrame:
    """Ranks of the sorted probe values `_cuts` from the numbers `_n` of facts exceeding `_above` of them."""
    slots = bounds.select(*keys, F.posexplode("_cuts").alias("_slot", value)).withColumn("_above", F.col("_slot") + 1)
    upward = Window.partitionBy(*keys).orderBy(F.desc("_slot"))
    return (
        slots.join(counters, [*keys, "_above"], "left")
        .withColumn(rank, F.sum(F.coalesce("_n", F.lit(0))).over(upward) + 1)
        .select(*keys, value, rank)
    )
