"""Keyed tables over two tiers: late rows, new versions, crashed runs, compaction between."""
import random
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, customers_df, products_df, raw_df, raw_row
from tidemark import schemas
from tidemark.operators import enrich
from tidemark.sources import lifecycle, tiering
from tidemark.sources.log import append_log, read_log, start_log_writer
from tidemark.sources.upsert import UpsertTable

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]


def orders(spark, rows):
    """rows: (order_id, day, amount)"""
    raw = raw_df(spark, [raw_row(o, a, time=f"{d} 10:00:00") for o, d, a in rows])
    return enrich.enrich(raw, customers_df(spark, [("C1", "Asha", "GOLD")]), products_df(spark, [("P1", "Phone", "toys")]))


def table(spark, scratch):
    return UpsertTable.named(spark, f"{scratch}/hot", "orders_enriched"), f"{scratch}/cold"


def amounts(df):
    rows = [(r.event_day, r.order_id, float(r.order_amount)) for r in df.collect()]
    assert len({r[:2] for r in rows}) == len(rows)      # one row for each key
    return {r[:2]: r[2] for r in rows}


def test_late_rows_and_new_versions(spark, scratch):
    t, cold = table(spark, scratch)
    t.upsert(orders(spark, [("A", DAYS[0], 1), ("B", DAYS[0], 1), ("C", DAYS[1], 1), ("D", DAYS[3], 1)]))
    assert tiering.read_cold(t, cold).collect() == [] and len(amounts(tiering.read_union(t, cold))) == 4
    assert tiering.tier_table(t, cold, DAYS[2]) == "20240103"
    assert amounts(tiering.read_cold(t, cold)) == {("20240101", "A"): 1, ("20240101", "B"): 1, ("20240102", "C"): 1}
    assert tiering.hot_ttl(t, cold, keep_days=0) == ["20240101", "20240102"] and set(amounts(t.read_current())) == {("20240104", "D")}
    t.upsert(orders(spark, [("B", DAYS[0], 2), ("E", DAYS[1], 5), ("D", DAYS[3], 4)]))
    want = {("20240101", "A"): 1, ("20240101", "B"): 2, ("20240102", "C"): 1, ("20240102", "E"): 5, ("20240104", "D"): 4}
    assert amounts(tiering.read_union(t, cold)) == want
    assert amounts(tiering.read_cold(t, cold))[("20240101", "B")] == 1      # cold alone is as of its run
    tiering.tier_table(t, cold, DAYS[2])
    assert amounts(tiering.read_union(t, cold)) == want
    assert amounts(tiering.read_cold(t, cold)) == {k: v for k, v in want.items() if k[0] < "20240103"}
    tiering.hot_ttl(t, cold, keep_days=0)
    assert amounts(tiering.read_union(t, cold)) == want and set(amounts(t.read_current())) == {("20240104", "D")}
    tiering.tier_table(t, cold, "2024-01-05")
    assert amounts(tiering.read_cold(t, cold)) == want


def test_rows_that_came_since_the_run_stay_in_hot(spark, scratch):
    t, cold = table(spark, scratch)
    t.upsert(orders(spark, [("A", DAYS[0], 1)]))
    tiering.tier_table(t, cold, DAYS[2])
    t.upsert(orders(spark, [("B", DAYS[0], 2)]))
    tiering.hot_ttl(t, cold, keep_days=0)
    assert set(amounts(t.read_current())) == {("20240101", "B")}
    t.compact()                                             # folds a batch that is not in cold yet
    assert tiering.hot_ttl(t, cold, keep_days=0) == []
    assert amounts(tiering.read_union(t, cold)) == {("20240101", "A"): 1, ("20240101", "B"): 2}
    t.expire()
    tiering.tier_table(t, cold, DAYS[2])
    tiering.hot_ttl(t, cold, keep_days=0)
    assert amounts(t.read_current()) == {} and amounts(tiering.read_cold(t, cold)) == {("20240101", "A"): 1, ("20240101", "B"): 2}


def test_a_crashed_run_is_made_good(spark, scratch, monkeypatch):
    t, cold = table(spark, scratch)
    t.upsert(orders(spark, [("A", DAYS[0], 1), ("B", DAYS[1], 1)]))
    saved = tiering.fs_add_version
    calls = []

    def crash(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("driver lost")
        return saved(*args)
    monkeypatch.setattr(tiering, "fs_add_version", crash)
    with pytest.raises(OSError):
        tiering.tier_table(t, cold, DAYS[2])                # rows are written, the state is not
    monkeypatch.setattr(tiering, "fs_add_version", saved)
    assert len(amounts(tiering.read_union(t, cold))) == 2 and tiering.read_cold(t, cold).collect() == []
    t.upsert(orders(spark, [("A", DAYS[0], 7)]))
    tiering.tier_table(t, cold, DAYS[2])
    assert amounts(tiering.read_cold(t, cold)) == {("20240101", "A"): 7, ("20240102", "B"): 1} == amounts(tiering.read_union(t, cold))


def test_random_writes(spark, scratch):
    rng, t, latest = random.Random(11), *table(spark, scratch)[:1], {}
    cold = f"{scratch}/cold"
    for step in range(6):
        rows = {(rng.choice("ABCDEFGH"), rng.choice(DAYS)): rng.randint(1, 99) for _ in range(8)}
        t.upsert(orders(spark, [(o, d, a) for (o, d), a in rows.items()]))
        latest.update({(d.replace("-", ""), o): a for (o, d), a in rows.items()})
        action = rng.choice(["tier", "ttl", "compact", "none"]) if step else "tier"
        if action in ("tier", "ttl"):
            tiering.tier_table(t, cold, rng.choice(DAYS[1:]))
        if action == "ttl":
            tiering.hot_ttl(t, cold, keep_days=rng.choice([0, 1]))
        if action == "compact":
            t.compact()
        assert amounts(tiering.read_union(t, cold)) == latest, (step, action)


def test_cold_days_of_one_run_are_not_folded_and_only_touched_days_join(spark, scratch):
    t, cold = table(spark, scratch)
    t.upsert(orders(spark, [("A", DAYS[0], 1), ("B", DAYS[1], 1)]))
    tiering.tier_table(t, cold, DAYS[3])
    assert "Aggregate" not in tiering.read_cold(t, cold)._jdf.queryExecution().optimizedPlan().toString()
    tiering.hot_ttl(t, cold, keep_days=0)
    t.upsert(orders(spark, [("B", DAYS[1], 3)]))
    plan = tiering.read_union(t, cold)._jdf.queryExecution().executedPlan().toString()
    assert "event_day" in plan.split("PartitionFilters: [")[1].split("]")[0] and "Cartesian" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError):
        tiering.tier_table(UpsertTable.named(spark, scratch, "dashboard_kpis"), cold, DAYS[3])


def test_log_tier_copies_what_the_sink_committed(spark, scratch):
    hot, cold, src = f"{scratch}/log", f"{scratch}/cold", f"{scratch}/src"
    rows = [raw_row(f"O{i}", "1.00", time=f"{DAYS[i % 2]} 10:00:00") for i in range(20)]
    raw_df(spark, rows).write.parquet(src)
    q = start_log_writer(spark.readStream.schema(schemas.ORDERS_RAW).parquet(src), hot, f"{scratch}/ckpt")
    q.awaitTermination()
    # what a failed task leaves behind: a file that no batch has committed
    raw_df(spark, [raw_row(f"X{i}", "1.00", time=f"{DAYS[0]} 10:00:00") for i in range(5)]).drop("event_day").coalesce(1).write.parquet(f"{scratch}/x")
    import glob
    left = glob.glob(f"{scratch}/x/part-*.parquet")[0]
    shutil.copy(left, f"{hot}/event_day=20240101/part-00000-left-over.parquet")
    assert read_log(spark, hot).count() == 20
    lifecycle.tier(spark, hot, cold, schemas.ORDERS_RAW, DAYS[3])
    assert lifecycle.read_union(spark, hot, cold, schemas.ORDERS_RAW).count() == 20
    assert spark.read.schema(schemas.ORDERS_RAW).parquet(cold).where(F.col("order_id").startswith("X")).isEmpty()
    assert lifecycle.hot_ttl(spark, hot, cold, keep_days=0) == ["20240101", "20240102"]
    assert lifecycle.read_union(spark, hot, cold, schemas.ORDERS_RAW).count() == 20


@pytest.mark.parametrize("name", ["union_read", "cold_read", "cold_trend"])
def test_registered_reads_use_two_roots(spark, name):
    from tidemark.plans.registry import QUERIES
    files = QUERIES[name](spark, SF_SMALL).inputFiles()
    assert any("/cold" in f for f in files) and (name != "union_read" or any("/hot" in f for f in files))
