"""De-duplication by keyed state: replays go, late orders stay, the state does not grow."""
import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from conftest import raw_df, raw_row
from tidemark.streaming import jobs, keyed

BASE = dt.datetime(2024, 1, 1)


def put(spark, layout, orders):
    rows = [raw_row(o, None if o is None else "1.50", quantity=None if i % 5 == 0 else i, time=str(BASE + dt.timedelta(minutes=m))) for i, (o, m) in enumerate(orders)]
    raw_df(spark, rows).coalesce(1).write.mode("append").partitionBy("event_day").parquet(layout.raw_path)


def run(layout, within="1 hour", **kw):
    q = jobs.start_dedup(layout, within, trigger={"availableNow": True}, **kw)
    q.awaitTermination()
    return q


def test_replays_go_and_late_orders_stay(spark, scratch):
    layout = jobs.Layout(spark, scratch)
    put(spark, layout, [("A", 0), ("B", 1), ("A", 0), (None, 1), (None, 1)])
    run(layout)
    put(spark, layout, [("A", 0), ("C", 200), ("B", 30)])            # copies of A and B, and a long step ahead
    run(layout)
    put(spark, layout, [("D", 2), ("C", 200), ("E", 150)])           # D is late by far, and no copy
    run(layout)
    put(spark, layout, [("D", 2), ("E", 150), ("A", 400)])           # the same id much later is another order
    run(layout)
    got = sorted((r.order_id or "", int((r.event_time - BASE).total_seconds() // 60)) for r in jobs.read_emitted(layout, "orders_unique").collect())
    assert [g for g in got if g != ("D", 2)] == [("", 1), ("", 1), ("A", 0), ("A", 400), ("B", 1), ("C", 200), ("E", 150)]
    assert ("D", 2) in got          # (its copy came when D was behind the horizon already)
    raw = spark.read.parquet(layout.raw_path)
    assert jobs.read_emitted(layout, "orders_unique").select(raw.columns).exceptAll(raw).isEmpty()      # rows come through as they were


def test_against_brute_force_with_restarts(spark, scratch):
    rng, layout = random.Random(9), jobs.Layout(spark, scratch)
    now, first, want = 0.0, {}, []
    for step in range(6):
        now += 25
        batch = []
        for k in range(30):
            minute = round(now - rng.random() * 25, 3)
            o = f"O{step}-{k}"
            first[o] = minute
            batch.append((o, minute))
        batch += [(o, first[o]) for o in rng.sample(sorted(o for o, m in first.items() if m > now - 50), 12)]    # re-deliveries
        rng.shuffle(batch)
        put(spark, layout, batch)
        run(layout)
    got = sorted(r.order_id for r in jobs.read_emitted(layout, "orders_unique").select("order_id").collect())
    assert got == sorted(first)
    state = spark.read.format("statestore").load(layout.checkpoint("orders_unique"))
    kept = [t for r in state.select(F.col("value").getField(state.schema["value"].dataType.names[0]).alias("v")).collect()
            for t in (np.frombuffer(bytes(r.v["entries"] if not isinstance(r.v, (bytes, bytearray)) else r.v), np.int64).reshape(-1, 2)[:, 1])]
    # A bucket forgets when it is touched; all entries of the last step's buckets lie in the horizon.
    assert 30 <= len(kept) <= len(first)


def test_expiry_in_the_packed_state():
    seen = {1: [10, 500], 2: [20], 3: [499, 600]}
    assert keyed.unpack(keyed.pack(seen, 400)) == {1: [500], 3: [499, 600]}
    assert keyed.unpack(keyed.pack({}, 0)) == {} and keyed.unpack(keyed.pack(seen, 10**9)) == {}


def test_state_is_bounded_by_the_horizon(spark, scratch):
    layout = jobs.Layout(spark, scratch)
    sizes = []
    for step in range(5):
        put(spark, layout, [(f"O{step}-{k}", step * 120 + k) for k in range(40)])
        q = jobs._start_emitting(layout, "orders_unique", keyed.first_copies(jobs.raw_stream(layout, None, None), "order_id", "1 hour", buckets=4),
                                 {"availableNow": True})
        q.awaitTermination()
        value = spark.read.format("statestore").load(layout.checkpoint("orders_unique")).select("value").toJSON().collect()
        assert len(value) <= 4
        sizes.append(sum(len(v) for v in value))
    assert sizes[-1] <= 2.5 * sizes[0]
