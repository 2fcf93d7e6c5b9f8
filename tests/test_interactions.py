"""Interaction state: flushes by number and by idleness, repeated deliveries, and a writer that dies."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from storeglass.functions.exprs import RATING_WEIGHTS
from storeglass.sources.versions import VersionedTable
from storeglass.streaming import interactions

EVENTS = "event_id string, user_id long, product_id long, event_type string, timestamp timestamp"
START = datetime(2024, 1, 1)


def made(n: int, users: int, seed: int = 1, hours: float = 1):
    draw = random.Random(seed)
    kinds = ["view", "cart", "like", "purchase", "search"]
    return [(f"e{seed}-{k}", draw.randrange(users), draw.randrange(6), draw.choice(kinds), START + timedelta(hours=hours * k / n)) for k in range(n)]


def files(spark, path, batches):
    """One file per batch, in the order in which a stream reads them."""
    import os
    import time

    for k, rows in enumerate(batches):
        out = f"{path}/in/{k}"
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(out)
        os.makedirs(f"{path}/all", exist_ok=True)
        part = next(f for f in os.listdir(out) if f.endswith(".parquet"))
        os.rename(f"{out}/{part}", f"{path}/all/{k}.parquet")
        os.utime(f"{path}/all/{k}.parquet", (time.time() - 1000 + k,) * 2)
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{path}/all")


def sums(rows):
    """Sums per user and product of distinct events, and events per user."""
    out, n, seen = defaultdict(lambda: [0.0, 0]), defaultdict(int), set()
    for event_id, user, product, kind, _ in rows:
        if user is None or event_id is not None and (user, event_id) in seen:
            continue
        seen.add((user, event_id))
        n[user] += 1
        if product is not None:
            out[user, product][0] += RATING_WEIGHTS.get(kind, 1.0)
            out[user, product][1] += 1
    return {(u, p, w, c, n[u]) for (u, p), (w, c) in out.items()}


def kept(spark, path):
    return {(r["user_id"], r["product_id"], r["weight"], r["n"], r["events"]) for r in interactions.flushed_table(spark, path).collect()}


def run(stream, path, every=1, idle="30 minutes"):
    flushed = interactions.flushed_interactions(stream, every, idle)
    interactions.keep_flushed(flushed, f"{path}/out", f"{path}/state", partitions=4).awaitTermination()


def test_every_event_is_counted_once_over_batches(spark, tmp_path):
    rows = made(240, 7)
    odd = [(None, 1, 2, "view", START), (None, 1, 2, "view", START), ("x", None, 1, "view", START), ("y", 2, None, "view", START), ("z", 2, 3, None, START)]
    batches = [rows[:80] + odd, rows[60:160], rows[150:] + rows[:20]]  # files overlap: deliveries are repeated
    run(files(spark, tmp_path, batches), tmp_path)
    assert kept(spark, f"{tmp_path}/out") == sums(rows + odd)


def test_flush_by_number(spark, tmp_path):
    """Users below the number wait; what a flushed user did since is not in the table yet."""
    first = [(f"a{k}", 1, k % 3, "view", START) for k in range(5)] + [(f"b{k}", 2, 0, "view", START) for k in range(4)]
    second = [("a5", 1, 0, "purchase", START), ("b4", 2, 0, "cart", START)]
    run(files(spark, tmp_path, [first, second]), tmp_path, every=5, idle="9 hours")
    assert kept(spark, f"{tmp_path}/out") == sums(first[:5]) | sums(first[5:] + second[1:])


def test_flush_of_idle_users(spark, tmp_path):
    rows = [("a", 1, 5, "cart", START), ("b", 2, 5, "view", START + timedelta(hours=3)), ("c", 3, 1, "view", START + timedelta(hours=6))]
    run(files(spark, tmp_path, [rows[:1], rows[1:2], rows[2:]]), tmp_path, every=10)
    # The watermark stands one hour behind the last event; user 3 has been seen since.
    assert kept(spark, f"{tmp_path}/out") == sums(rows[:2])


@pytest.mark.parametrize("where", ["before", "after"])
def test_a_batch_that_dies_is_run_again(spark, tmp_path, monkeypatch, where):
    """The process dies in its second batch, before or after the table's commit; a new start loses and repeats nothing."""
    rows = made(200, 5, 3)
    stream, calls = files(spark, tmp_path, [rows[:70], rows[70:140], rows[140:]]), []
    commit = VersionedTable._commit

    def dies(self, manifest):
        calls.append(manifest["version"])
        if len(calls) == 2:
            if where == "after":
                commit(self, manifest)
            raise OSError("killed")
        return commit(self, manifest)

    monkeypatch.setattr(VersionedTable, "_commit", dies)
    with pytest.raises(Exception, match="killed"):
        run(stream, tmp_path)
    monkeypatch.undo()
    seen = {"before": rows[:70], "after": rows[:140]}[where]
    assert kept(spark, f"{tmp_path}/out") == sums(seen)  # readers see whole batches only
    run(stream, tmp_path)
    assert kept(spark, f"{tmp_path}/out") == sums(rows)


def test_derived_tables_by_ids_in_state(spark, tmp_path):
    """Same rows as with stored ids, over batches that repeat events, and no table of seen ids."""
    from pyspark.sql import functions as F

    from storeglass.streaming import jobs

    rows = made(120, 5, 9, hours=0.5) + [(None, 1, 2, "purchase", START), (None, 1, 2, "purchase", START)]
    stream = files(spark, tmp_path, [rows[:60], rows[30:100] + rows[120:], rows[90:120] + rows[:10]])
    more = {"ts": F.to_timestamp_ntz(F.col("timestamp").cast("string")), "quantity": F.lit(1), "total_amount": F.lit(2.0)}
    more |= {c: F.lit(None).cast("string") for c in ("session_id", "device", "ip_address", "user_agent", "search_query")}
    made_of = {}
    for name, remember in (("ids", None), ("state", "2 hours")):
        place = str(tmp_path / name)
        jobs.derive_tables(stream.withColumns(more), place, f"{place}/s", remember=remember).awaitTermination()
        made_of[name] = {t: sorted(map(tuple, spark.read.parquet(f"{place}/{t}").drop("batch_id").collect()), key=repr)
                         for t in ("orders", "order_items", "user_behavior_log")}
    assert made_of["ids"] == made_of["state"] and len(made_of["state"]["user_behavior_log"]) == 122
    assert (tmp_path / "ids" / "seen").exists() and not (tmp_path / "state" / "seen").exists()


def test_a_session_with_another_state_store_and_workers_without_this_package(tmp_path):
    """The stream is started with the store it needs; its processor needs no module but Spark's own."""
    import os
    import subprocess
    import sys

    from storeglass import session

    root = os.path.dirname(os.path.dirname(session.__file__))
    code = f"""
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
sys.path.insert(0, {root!r})
from storeglass.streaming import interactions
stream = spark.readStream.schema("{EVENTS}").parquet("{tmp_path}/in")
flushed = interactions.flushed_interactions(stream, 2, "9 hours")
interactions.keep_flushed(flushed, "{tmp_path}/out", "{tmp_path}/state", partitions=2).awaitTermination()
assert spark.conf.get(interactions.STATE_STORE).endswith("HDFSBackedStateStoreProvider")
print("kept", [tuple(r) for r in interactions.flushed_table(spark, "{tmp_path}/out").collect()])
"""
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(tmp_path / "in")
    rows = [("a", 1, 5, "cart", START), ("b", 1, 5, "view", START), ("b", 1, 5, "view", START), ("c", 2, 5, "view", START)]
    names = ["event_id", "user_id", "product_id", "event_type", "timestamp"]
    table = pa.table(dict(zip(names, map(list, zip(*rows)), strict=True)))
    pq.write_table(table.set_column(4, "timestamp", table["timestamp"].cast(pa.timestamp("us", "UTC"))), tmp_path / "in" / "0.parquet")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "kept [(1, 5, 4.0, 2, 2)]" in done.stdout, done.stderr[-3000:]


def test_calls_to_the_state_do_not_grow_with_events(spark):
    """A user's events of a batch cost as many calls to the state store as one event."""
    import pandas as pd

    class State:
        calls = 0

        def __init__(self):
            self.rows = []

        def __getattr__(self, name):
            State.calls += 1
            return {"exists": lambda: bool(self.rows), "get": lambda: self.rows[0] if self.one else iter(self.rows),
                    "clear": lambda: self.rows.clear(), "appendList": lambda rows: self.rows.extend(rows),
                    "update": lambda row: self.rows.__setitem__(slice(None), [row])}[name]

    class Handle:
        def getListState(self, *_):
            state = State()
            state.one = False
            return state

        def getValueState(self, *_):
            state = State()
            state.one = True
            return state

        def registerTimer(self, _):
            pass

        deleteTimer = registerTimer

    class Times:
        def getCurrentWatermarkInMs(self):
            return 0

    calls = []
    for n in (1, 500):
        processor, State.calls = interactions.Interactions(every=1, idle_ms=1), 0
        processor.init(Handle())
        events = pd.DataFrame({"event_id": [f"e{k}" for k in range(n)], "product_id": [k % 50 for k in range(n)], "weight": 1.0, "ms": 5})
        for _ in range(2):  # the second time all events are repeated
            lists = list(processor.handleInputRows((7,), iter([events]), Times()))
        calls.append(State.calls)
        assert not any(map(len, lists)) or n == 1 or len(lists[0]) == 50
    assert calls[0] == calls[1]
