"""Point lookups by a key layout; purges from a log that a stream writes."""
import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import customers_df, products_df, raw_df, raw_row
from tidemark import schemas
from tidemark.sources import keyed, lifecycle, purge
from tidemark.sources.log import append_log, read_log, start_log_writer
from tidemark.sources.upsert import UpsertTable
from tidemark.streaming import jobs


def test_lookup_reads_one_bucket(spark, scratch):
    df = spark.range(1000).select(F.concat(F.lit("K"), "id").alias("k"), F.col("id").alias("v")).union(spark.range(300).select(F.lit("hot"), "id")).union(
        spark.range(50).select(F.lit(None), "id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # so few rows would go into one task
    try:
        n = keyed.write_keyed(df, scratch, "k", buckets=8, rows_per_file=100)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert n == 8 and keyed.read_keyed(spark, scratch, df.schema).exceptAll(df).isEmpty() and keyed.read_keyed(spark, scratch, df.schema).count() == 1350
    look = lambda *keys: keyed.lookup(spark, scratch, df.schema, "k", *keys)
    assert look("K17").collect() == [("K17", 17)] and look("K1", "K2", "none").count() == 2
    assert look("hot").count() == 300 and look(None).count() == 50 and look(None, "K3").count() == 51 and look().count() == 0
    plan = look("K17")._jdf.queryExecution().executedPlan().toString()
    assert "bucket_of_8" in plan.split("PartitionFilters: [")[1].split("]")[0] and "EqualTo(k,K17)" in plan and "Exchange" not in plan
    paths = {os.path.dirname(r[0]) for r in look("K17").select("_metadata.file_path").collect()}
    assert len(paths) == 1
    hot = [p for p in glob.glob(f"{scratch}/*/") if len(glob.glob(f"{p}/*.parquet")) >= 2]
    assert hot                                     # the hot key's bucket is in several files
    assert keyed.write_keyed(df, f"{scratch}-rows", "k") == 1 and keyed.lookup(spark, f"{scratch}-none", df.schema, "k", "x").count() == 0


def test_lookup_in_an_upsert_table_runs_no_job_ahead(spark, scratch):
    t = UpsertTable.named(spark, scratch, "customer_profile")
    t.upsert(customers_df(spark, [("C1", "Asha", "GOLD"), ("C2", "Ravi", "GOLD"), (None, "No", "GOLD")]))
    t.compact()
    t.upsert(customers_df(spark, [("C1", "Asha B", "SILVER")]))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lookup", "")
    df = t.lookup(customer_id="C1")
    assert not tracker.getJobIdsForGroup("lookup")
    assert [r.customer_name for r in df.collect()] == ["Asha B"]
    spark.sparkContext.setJobGroup("other", "")
    assert [r.customer_name for r in t.lookup(customer_id="C2").collect()] == ["Ravi"] and [r.customer_name for r in t.lookup(customer_id=None).collect()] == ["No"]
    assert t.lookup(customer_id="C9").count() == 0 and t.lookup(loyalty_tier="SILVER").count() == 1


@pytest.fixture
def live(spark, scratch):
    """A layout whose log a streaming sink has written."""
    layout = jobs.Layout(spark, scratch)
    rows = [raw_row(f"O{i}", "20000.00", customer=[None, "C1", "C2", "C3"][i % 4], time=f"2024-01-0{1 + i % 3} 10:00:00") for i in range(24)]
    raw_df(spark, rows).write.parquet(f"{scratch}/src")
    start_log_writer(spark.readStream.schema(schemas.ORDERS_RAW).parquet(f"{scratch}/src"), layout.raw_path, f"{scratch}/ckpt").awaitTermination()
    return layout


def test_purge_from_the_live_log(spark, live):
    every = {r.order_id: r.customer_id for r in read_log(spark, live.raw_path).collect()}
    assert live.log().count() == 24
    purge.purge(spark, live.purged_path, "customer_id", ["C1", None])
    assert {r.order_id for r in live.log().collect()} == {o for o, c in every.items() if c != "C1"}
    purge.purge(spark, live.purged_path, "customer_id", spark.createDataFrame([("C3",), ("C1",), ("C9",)], "c string"))
    want = {o for o, c in every.items() if c not in ("C1", "C3")}
    assert {r.order_id for r in live.log().collect()} == want
    # the stream goes on writing; the purge holds for its new files, too
    raw_df(spark, [raw_row("N1", "1.00", customer="C1", time="2024-01-05 10:00:00"), raw_row("N2", "1.00", customer="C2", time="2024-01-05 10:00:00")]) \
        .write.mode("append").parquet(f"{live.root}/src")
    start_log_writer(spark.readStream.schema(schemas.ORDERS_RAW).parquet(f"{live.root}/src"), live.raw_path, f"{live.root}/ckpt").awaitTermination()
    want |= {"N2"}
    assert {r.order_id for r in live.log().collect()} == want
    # files: the tier copies none of the purged rows, and hot days go
    cold = f"{live.root}/cold"
    lifecycle.tier(spark, live.raw_path, cold, schemas.ORDERS_RAW, "20240104", keep=lambda rows: purge.without(rows, live.purged_path))
    assert spark.read.schema(schemas.ORDERS_RAW).parquet(cold).where("customer_id in ('C1', 'C3')").isEmpty()
    assert lifecycle.hot_ttl(spark, live.raw_path, cold, keep_days=0) == ["20240101", "20240102", "20240103"]
    union = lifecycle.read_union(spark, live.raw_path, cold, schemas.ORDERS_RAW)
    assert {r.order_id for r in purge.without(union, live.purged_path).collect()} == want
    assert [tuple(r) for r in purge.remaining(union, live.purged_path).collect()] == [("20240105", 1)]
    # a key purged later: the cold days that hold it are rewritten, the others are not
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{cold}/event_day=*/*.parquet")}
    purge.purge(spark, live.purged_path, "customer_id", ["C2"])
    assert lifecycle.purge_cold(spark, cold, schemas.ORDERS_RAW, live.purged_path) == ["20240101", "20240102", "20240103"]
    rows = spark.read.schema(schemas.ORDERS_RAW).parquet(cold)
    assert {r.order_id for r in rows.collect()} == {o for o, c in every.items() if c is None} and before
    assert lifecycle.purge_cold(spark, cold, schemas.ORDERS_RAW, live.purged_path) == []


def test_enrichment_leaves_purged_customers_out(spark, live):
    live.table("customer_profile").upsert(customers_df(spark, [("C1", "Asha", "GOLD"), ("C2", "Ravi", "GOLD")]))
    live.table("product_catalog").upsert(products_df(spark, [("P1", "Phone", "toys")]))
    purge.purge(spark, live.purged_path, "customer_id", ["C1"])
    q = jobs.start_enrich_and_alert(live, trigger={"availableNow": True})
    q.awaitTermination()
    got = live.table("orders_enriched").read_current()
    assert got.count() == 18 and got.where("customer_id = 'C1'").isEmpty() and live.table("high_value_orders").read_current().where("customer_id = 'C1'").isEmpty()


def test_a_rewrite_that_a_crash_cut_short(spark, scratch, monkeypatch):
    append_log(raw_df(spark, [raw_row(f"O{i}", "1.00", customer=f"C{i % 2}", time=f"2024-01-0{1 + i % 2} 10:00:00") for i in range(8)]), scratch)
    rename, calls = lifecycle.fs_rename, []

    def crash(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("driver lost")
        return rename(*args)
    monkeypatch.setattr(lifecycle, "fs_rename", crash)
    with pytest.raises(OSError):
        lifecycle.purge_files(spark, scratch, schemas.ORDERS_RAW, "order_id", "O0")
    monkeypatch.setattr(lifecycle, "fs_rename", rename)
    assert lifecycle.recover(spark, scratch) == ["20240101"] and lifecycle.recover(spark, scratch) == []
    spark.catalog.refreshByPath(scratch)
    assert read_log(spark, scratch).count() == 8
    assert lifecycle.purge_files(spark, scratch, schemas.ORDERS_RAW, "order_id", "O0") == ["20240101"] and read_log(spark, scratch).count() == 7


def test_jobs_fold_their_tables(spark, scratch):
    plain, folding = jobs.Layout(spark, f"{scratch}/a"), jobs.Layout(spark, f"{scratch}/b", compact_every=2)
    for layout in (plain, folding):
        layout.table("customer_profile").upsert(customers_df(spark, [("C1", "Asha", "GOLD")]))
        layout.table("product_catalog").upsert(products_df(spark, [("P1", "Phone", "toys")]))
        for i in range(7):
            raw_df(spark, [raw_row(f"O{k}", f"{20000 + i}.00", time=f"2024-01-0{1 + k} 10:00:00") for k in (i % 3, 3 + i % 2)]) \
                .coalesce(1).write.mode("append").partitionBy("event_day").parquet(layout.raw_path)
            jobs.start_enrich_and_alert(layout, trigger={"availableNow": True}).awaitTermination()
    for name in ("orders_enriched", "high_value_orders"):
        a, b = plain.table(name), folding.table(name)
        assert a.read_current().exceptAll(b.read_current()).isEmpty() and a.read_current().count() == b.read_current().count() == 5
        assert len(a._batches()) == 7 and len(b._batches()) <= 4 and a.pointer()["version"] == -1 and b.pointer()["version"] == 2
