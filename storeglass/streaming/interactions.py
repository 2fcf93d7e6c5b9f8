"""Running interaction state per user, flushed every n events: arbitrary stateful streaming.

Per user the state holds sums and numbers of interactions by product, the ids of events it has counted, and how many events
came since the last flush. A user's list is put out when `every` events have come, or by a timer when the watermark has
passed the user's last event by `idle`. Ids are forgotten at a flush once the watermark has passed their event, since one
delivered again would then be late and is not looked at. State lives in the state store (RocksDB: beyond memory, on disk),
is part of the query's checkpoint, and a batch that is run again starts from the state before it: nothing is summed twice,
no batch reads what earlier ones wrote. Lists and timers need that store, so the stream is started with it, whatever the
session has.

A call to the state goes from the Python worker to the executor and back, which takes far longer than the sum it is for.
So ids and sums are lists, read or written by one call for a user and batch: a batch adds its sums to the end, and a flush,
which reads all of a user's sums anyway, folds them into one entry a product. Users are the unit of work: a single user's
events are handled by one task, in the order they arrive there.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from storeglass.functions.exprs import RATING_WEIGHTS, weight_of
from storeglass.operators.settings import settings
from storeglass.session import SETTINGS
from storeglass.sources.versions import VersionedTable

FLUSHED = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("product_id", T.LongType()), T.StructField("weight", T.DoubleType()),
    T.StructField("n", T.LongType()), T.StructField("events", T.LongType()), T.StructField("reason", T.StringType())])

#: Of the session's settings the one that maps and timers in state can't do without.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"

#: Rows that go to the state by one call.
CALL_ROWS = 10_000

# The processor goes to the workers as it is: the one that Spark starts beside the driver need not find this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Interactions(StatefulProcessor):
    """Keeps sums per user and product; puts all of a user's sums out when they are flushed."""

    def __init__(self, every: int, idle_ms: int):
        self.every, self.idle_ms = every, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getListState("sums", "product_id long, weight double, n long")
        self.seen = handle.getListState("seen", "event_id string, ms long")
        self.counts = handle.getValueState("counts", "events long, waiting long, last long, timer long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.counts.exists()
        events, waiting, last, timer = self.counts.get() if known else (0, 0, 0, 0)
        seen, fresh = dict(self.seen.get()) if known else {}, {}
        added: dict[int, list] = {}
        for batch in rows:
            for event_id, product_id, weight, ms in zip(*(batch[c] for c in ("event_id", "product_id", "weight", "ms")), strict=True):
                if not pd.isna(event_id):  # without an id an event can't be told apart, and counts
                    if event_id in seen or event_id in fresh:
                        continue
                    fresh[str(event_id)] = int(ms)
                events, waiting, last = events + 1, waiting + 1, max(last, int(ms))
                if not pd.isna(product_id):
                    _add(added, int(product_id), float(weight), 1)
        due = waiting >= self.every
        if timer:
            self.handle.deleteTimer(timer)
        timer = 0 if due or not waiting else last + self.idle_ms
        if timer:
            self.handle.registerTimer(timer)
        self.counts.update((events, 0 if due else waiting, last, timer))
        if due:
            yield self._flush(key, events, "events", seen | fresh, added, timerValues)
        else:
            _append(self.seen, list(fresh.items()))
            _append(self.sums, [(product_id, *sums) for product_id, sums in added.items()])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        events, _, last, _ = self.counts.get()
        self.counts.update((events, 0, last, 0))
        yield self._flush(key, events, "idle", dict(self.seen.get()), {}, timerValues)

    def _flush(self, key, events: int, reason: str, seen: dict[str, int], added: dict[int, list], timerValues) -> pd.DataFrame:
        """All of a user's sums, which are stored with those just `added`; ids that are still to be known stay."""
        watermark, sums = timerValues.getCurrentWatermarkInMs(), {}
        for product_id, weight, n in self.sums.get():
            _add(sums, product_id, weight, n)
        for product_id, (weight, n) in added.items():
            _add(sums, product_id, weight, n)
        _put(self.sums, [(product_id, *values) for product_id, values in sums.items()])
        _put(self.seen, [(event_id, ms) for event_id, ms in seen.items() if ms >= watermark])
        return pd.DataFrame([(key[0], product_id, *values, events, reason) for product_id, values in sums.items()], columns=FLUSHED.names)

    def close(self) -> None:
        pass


def _add(sums: dict[int, list], product_id: int, weight: float, n: int) -> None:
    values = sums.setdefault(product_id, [0.0, 0])
    values[0] += weight
    values[1] += n


def _append(state, rows: list[tuple]) -> None:
    for k in range(0, len(rows), CALL_ROWS):
        state.appendList(rows[k:k + CALL_ROWS])


def _put(state, rows: list[tuple]) -> None:
    state.clear()  # a list without entries can't be put
    _append(state, rows)


def flushed_interactions(
    events: DataFrame, every: int = 100, idle: str = "30 minutes", delay: str = "1 hour",
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """Stream of user_id, product_id, weight, n, events, reason: all sums of a user whenever they are flushed.

    `events` need event_id, user_id, product_id, event_type and a `timestamp` (with zone). Events more than `delay`
    behind the latest one are dropped, as by any watermark.
    """
    weights = RATING_WEIGHTS if weights is None else weights
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    rows = events.filter("user_id IS NOT NULL").select(
        F.col("user_id").cast("long").alias("user_id"), F.col("event_id").cast("string").alias("event_id"),
        F.col("product_id").cast("long").alias("product_id"), weight_of("event_type", weights, 1.0).cast("double").alias("weight"),
        F.unix_millis("timestamp").alias("ms"), "timestamp").withWatermark("timestamp", delay)
    return rows.groupBy("user_id").transformWithStateInPandas(
        Interactions(every, idle_ms), FLUSHED, "Update", "EventTime")


def keep_flushed(flushed: DataFrame, path: str, checkpoint: str, interval: str | None = None, partitions: int = 64) -> StreamingQuery:
    """The latest sums per user and product in a versioned table. A batch that is run again writes the same rows once
    more; a batch that dies before its commit leaves readers with the version before."""
    from storeglass.streaming.jobs import each_batch

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = batch.groupBy("user_id", "product_id").agg(F.max_by(F.struct("weight", "n"), "events").alias("v"), F.max("events").alias("events"))
        rows = rows.select("user_id", "product_id", "v.weight", "v.n", "events",
                           F.pmod(F.xxhash64("user_id"), F.lit(partitions)).cast("int").alias("bucket"))
        VersionedTable(batch.sparkSession, path).upsert(rows, ["user_id", "product_id"], "events", ["bucket"])

    with settings(flushed.sparkSession, {STATE_STORE: SETTINGS[STATE_STORE]}):
        return each_batch(flushed, merge, checkpoint, interval, "update")


def flushed_table(spark: SparkSession, path: str) -> DataFrame:
    table = VersionedTable(spark, path).read()
    if table is None:
        return spark.createDataFrame([], FLUSHED).drop("reason")
    return table.drop("bucket")
