"""Joining a large table with a lookup table that has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 8


def planned_bytes(df: DataFrame) -> int:
    """Size estimate of the optimised plan (files read x columns kept); runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    return planned_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def lookup_join(
    facts: DataFrame, lookup: DataFrame, key: str, spread_by: str, how: str = "inner",
    limit: int | None = None, salts: int = SALTS, sized_by: DataFrame | None = None,
) -> DataFrame:
    """facts join lookup on `key` (unique in lookup).

    A lookup of checked small size is broadcast and nothing is shuffled. A larger one is joined on (key, salt): the
    facts of one key are spread over `salts` tasks by the hash of `spread_by`, each lookup row is repeated per salt.
    One key with a third of the facts thus never ends up in one task; adaptive execution can split further.

    The planner puts a joined frame at the product of its inputs. Where `lookup` is a table with columns of others joined
    on their unique keys, `sized_by` names that table: it has as many rows, and twice its size is taken as the bound.
    """
    if is_small(lookup, limit) or sized_by is not None and 2 * planned_bytes(sized_by) <= (limit or BROADCAST_BYTES):
        return facts.join(F.broadcast(lookup), key, how)
    salted = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = facts.withColumn("_salt", F.pmod(F.xxhash64(F.col(spread_by)), F.lit(salts)).cast("int"))
    return spread.join(salted, [key, "_salt"], how).drop("_salt")


def enrich_rows(rows: DataFrame, lookup: DataFrame, key: str, row_bound: int, how: str = "inner") -> DataFrame:
    """Fetch lookup columns for a result of at most `row_bound` rows.

    The bounded side is the broadcast one, so a lookup table of any size is only scanned, not shuffled.
    """
    if row_bound > 100_000 or how != "inner":
        return rows.join(lookup, key, how)
    return lookup.join(F.broadcast(rows), key)
