"""Rows that storage and replay must not lose or double."""
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import dedup
from tidemark.session import shared_root
from tidemark.sources import lifecycle as lc
from tidemark.sources import testdata
from tidemark.sources.log import append_log, read_log, start_log_writer
from tidemark.sources.upsert import UpsertTable, fs_delete, fs_list, fs_write_text
from tidemark.streaming import jobs

from conftest import customers_df, products_df, raw_df, raw_row, ts

NOW = {"availableNow": True}


def _products(spark, category, at):
    return spark.createDataFrame([("P1", "Phone", category, "Brand", Decimal("10.00"), 50, ts(at))], schemas.PRODUCT_CATALOG)


def _drain(query):
    query.awaitTermination()
    assert query.exception() is None


def test_ids_are_padded_and_never_cut(spark):
    got = spark.range(1).select(testdata.product_key(F.lit(7)), testdata.product_key(F.lit(12345678)),
                                testdata.customer_key(F.lit(1234567890123)), testdata.product_key(F.lit(None).cast("bigint"))).first()
    assert tuple(got) == ("SKU-000007", "SKU-12345678", "CUS-1234567890123", None)


def test_purge_of_a_day_that_holds_only_the_key(spark, scratch):
    path = f"{scratch}/log"
    append_log(raw_df(spark, [raw_row("O1", 1, customer="C1", time="2024-01-01 00:00:01"),
                              raw_row("O2", 1, customer="C1", time="2024-01-02 00:00:01"), raw_row("O3", 1, customer="C2", time="2024-01-02 00:00:01")]), path)
    assert lc.purge_files(spark, path, schemas.ORDERS_RAW, "customer_id", "C1") == ["20240101", "20240102"]
    assert [r.order_id for r in read_log(spark, path).collect()] == ["O3"]
    assert not [n for n in fs_list(spark, path) if n.startswith(".rewrite")]


def test_purge_and_compaction_refuse_a_stream_sink(spark, scratch):
    src, path = f"{scratch}/src", f"{scratch}/log"
    append_log(raw_df(spark, [raw_row("O1", 1), raw_row("O2", 1, customer="C2")]), src)
    _drain(start_log_writer(read_log(spark, src, streaming=True), path, f"{scratch}/ck"))
    with pytest.raises(ValueError):
        lc.purge_files(spark, path, schemas.ORDERS_RAW, "customer_id", "C1")
    with pytest.raises(ValueError):
        lc.compact_days(spark, path, schemas.ORDERS_RAW, ["20240101"], min_files=1)
    assert read_log(spark, path).count() == 2


def test_newest_version_in_one_batch_wins(spark, scratch):
    t = UpsertTable.named(spark, scratch, "product_catalog")
    rows = [(f"P{i}", v, "cat", "Brand", Decimal("1.00"), 1, ts(f"2024-01-0{d} 00:00:00")) for i in range(10) for v, d in (("old", 1), ("new", 2))]
    t.upsert(spark.createDataFrame(rows, schemas.PRODUCT_CATALOG))
    assert {r.product_name for r in t.read_current().collect()} == {"new"}


def test_rows_that_come_after_the_copy_of_their_day(spark, scratch):
    hot, cold = f"{scratch}/hot", f"{scratch}/cold"
    append_log(raw_df(spark, [raw_row("O1", 1, time="2024-01-01 00:00:01"), raw_row("O2", 1, time="2024-01-09 00:00:01")]), hot)
    ids = lambda: sorted(r.order_id for r in lc.read_union(spark, hot, cold, schemas.ORDERS_RAW).collect())
    lc.tier(spark, hot, cold, schemas.ORDERS_RAW, "20240105")
    append_log(raw_df(spark, [raw_row("O3", 1, time="2024-01-01 00:00:02")]), hot)
    assert ids() == ["O1", "O2", "O3"]
    assert lc.hot_ttl(spark, hot, cold, keep_days=1) == []   # a file of that day is not in cold
    lc.tier(spark, hot, cold, schemas.ORDERS_RAW, "20240105")
    assert ids() == ["O1", "O2", "O3"] and lc.hot_ttl(spark, hot, cold, keep_days=1) == ["20240101"] and ids() == ["O1", "O2", "O3"]
    append_log(raw_df(spark, [raw_row("O4", 1, time="2024-01-01 00:00:03")]), hot)
    lc.tier(spark, hot, cold, schemas.ORDERS_RAW, "20240106")
    lc.compact_days(spark, cold, schemas.ORDERS_RAW, ["20240101"], min_files=2)
    assert ids() == ["O1", "O2", "O3", "O4"]


def test_a_copy_that_broke_off_is_not_doubled(spark, scratch):
    hot, cold = f"{scratch}/hot", f"{scratch}/cold"
    append_log(raw_df(spark, [raw_row("O1", 1, time="2024-01-01 00:00:01")]), hot)
    lc.tier(spark, hot, cold, schemas.ORDERS_RAW, "20240105")
    for name in fs_list(spark, cold):   # as if the last state had not been written
        if name.endswith(".json") and not name.endswith(".0.json"):
            fs_delete(spark, f"{cold}/{name}")
    lc.tier(spark, hot, cold, schemas.ORDERS_RAW, "20240105")
    assert lc.read_union(spark, hot, cold, schemas.ORDERS_RAW).count() == 1


def test_rebuild_replaces_what_is_no_longer_true(spark, scratch):
    layout = jobs.Layout(spark, scratch)
    layout.table("customer_profile").upsert(customers_df(spark, [("C1", "Ann", "GOLD")]))
    layout.table("product_catalog").upsert(_products(spark, "catA", "2024-01-01 00:00:00"))
    append_log(raw_df(spark, [raw_row("O1", 30000, time="2024-01-01 00:00:01"), raw_row("O2", 10, time="2024-01-01 00:01:00"),
                              raw_row("O3", 10, time="2024-01-01 00:20:00")]), layout.raw_path)
    jobs.rebuild(layout, "2024-01-01 00:00:00", "2024-01-01 01:00:00")
    layout.table("product_catalog").upsert(_products(spark, "catB", "2024-01-02 00:00:00"))
    jobs.rebuild(layout, "2024-01-01 00:00:30", "2024-01-01 00:02:00")   # widened to the whole window
    got = sorted((str(r.window_start)[11:16], r.category, r.total_orders) for r in layout.table("revenue_5min").read_current().collect())
    assert got == [("00:00", "catB", 2), ("00:20", "catA", 1)]
    assert layout.table("orders_enriched").read_current().count() == 3
    assert layout.table("high_value_orders").read_current().count() == 1


def test_rebuild_keeps_lookup_misses(spark, scratch):
    layout = jobs.Layout(spark, scratch)
    layout.table("customer_profile").upsert(customers_df(spark, [("C1", "Ann", "GOLD")]))
    layout.table("product_catalog").upsert(products_df(spark, [("P1", "Phone", "catA")]))
    append_log(raw_df(spark, [raw_row("O1", 1), raw_row("O2", 1, customer="NOPE")]), layout.raw_path)
    jobs.rebuild(layout, "2024-01-01 00:00:00", "2024-01-02 00:00:00", on_miss="dlq")
    assert [r.order_id for r in layout.table("orders_enriched").read_current().collect()] == ["O1"]
    assert [r.original_order_id for r in spark.read.parquet(layout.errors_path).collect()] == ["O2"]


def test_a_unique_late_order_is_kept(spark, scratch):
    layout = jobs.Layout(spark, scratch)
    layout.table("customer_profile").upsert(customers_df(spark, [("C1", "Ann", "GOLD")]))
    layout.table("product_catalog").upsert(products_df(spark, [("P1", "Phone", "catA")]))
    for row in (raw_row("O1", 1, time="2024-01-05 00:00:00"), raw_row("O2", 1, time="2024-01-01 00:00:00"), raw_row("O1", 2, time="2024-01-05 00:10:00")):
        append_log(raw_df(spark, [row]), layout.raw_path)
        _drain(jobs.start_enrich_and_alert(layout, trigger=NOW, dedup_within="1 hour"))
    got = sorted((r.order_id, str(r.order_amount)) for r in layout.table("orders_enriched").read_current().collect())
    assert got == [("O1", "1.00"), ("O2", "1.00")]


def test_batches_are_seen_once_committed(spark, scratch):
    t = UpsertTable.named(spark, scratch, "product_catalog")
    t.upsert(products_df(spark, [("P1", "Phone", "a")]))
    before = t.signature()
    e = t.new_epoch()
    t.write_batch(products_df(spark, [("P2", "Pen", "a")]), e, 0)
    fs_delete(spark, f"{t.root}/changelog/epoch={e}/batch_id=0/_SUCCESS")
    assert t.read_current().count() == 1 and t.signature()[1] == before[1]
    t.write_batch(products_df(spark, [("P2", "Pen", "a")]), e, 0)
    assert t.read_current().count() == 2 and t.signature()[1] != before[1]
    t.write_batch(products_df(spark, [("P9", "Pen", "a")]), e, 0)   # committed: left as it is
    assert sorted(r.product_id for r in t.read_current().collect()) == ["P1", "P2"]


def test_a_crash_while_the_pointer_is_written(spark, scratch):
    t = UpsertTable.named(spark, scratch, "product_catalog")
    t.upsert(products_df(spark, [("P1", "Phone", "a")]))
    t.compact()
    t.expire()
    fs_write_text(spark, f"{t.root}/_pointer.99.json.tmp", "{")   # a temp file of the next one
    assert t.read_current().count() == 1


def test_retention_of_alert_tables(spark, scratch):
    t = UpsertTable.named(spark, scratch, "high_value_orders")
    rows = [(f"O{i}", "C1", "Ann", "GOLD", Decimal("30000.00"), "Mumbai", "cat", ts(f"2024-0{i}-01 00:00:00")) for i in (1, 3)]
    t.upsert(spark.createDataFrame(rows, schemas.SCHEMAS["high_value_orders"]))
    lc.apply_policy(spark, scratch, "20240310", {"high_value_orders": 30})
    assert [r.order_id for r in t.read_current().collect()] == ["O3"]
    lc.purge_table(t, "customer_id", "C1")
    assert t.read_current().count() == 0


def test_dedup_keeps_the_newest_copy(spark):
    df = raw_df(spark, [raw_row("O1", 1, time="2024-01-01 00:00:01"), raw_row("O1", 2, time="2024-01-01 00:00:02")])
    assert [str(r.order_amount) for r in dedup.dedup_orders(df).collect()] == ["2.00"]


def test_union_keeps_rows_without_a_day_and_months_are_ranges(spark):
    df = raw_df(spark, [raw_row("O1", 1, time="2024-01-31 23:59:59"), raw_row("O2", 1, time="2024-02-01 00:00:00")])
    lost = df.withColumn("event_day", F.lit(None).cast("string"))
    assert lc.union_read(lost, df.limit(0), "20240105").count() == 2
    assert [r.order_id for r in lc.month_slice(df, "2024-01").collect()] == ["O1"]
    assert [r.order_id for r in lc.month_slice(df, "2024-02").collect()] == ["O2"]
    assert lc.month_slice(df, "2023-12").count() == 0


def test_missing_files_fail_a_read_and_checkpoints_are_registered(spark):
    assert spark.conf.get("spark.sql.files.ignoreMissingFiles", "false") == "false"
    assert shared_root(spark) and spark.sparkContext.getCheckpointDir()


@pytest.mark.parametrize("hot", ["C1", None])
def test_a_hot_key_is_split_in_the_shuffled_lookup(spark, hot):
    from tidemark.operators import enrich
    names = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        customers = spark.range(2000).select(F.concat(F.lit("C"), F.col("id")).alias("customer_id"), F.lit("n").alias("customer_name"),
                                             F.lit("GOLD").alias("loyalty_tier"), F.lit("2024-01-01").cast("timestamp_ntz").alias("updated_at"))
        key = F.when(F.col("id") % 2 == 0, F.lit(hot)).otherwise(F.concat(F.lit("C"), F.col("id") % 2000))
        facts = spark.range(0, 60000, 1, 8).select(key.alias("customer_id"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        out = enrich.lookup(facts, customers, "customer_id", ["customer_name"], small=False)
        assert out.count() == 60000 and out.where("customer_name is null").count() == (0 if hot else 30000)
        out.write.format("noop").mode("overwrite").save()
        rows = out.groupBy(F.spark_partition_id()).count()
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString() and rows.count() > 1
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_a_stream_may_start_on_an_empty_log(spark, scratch):
    layout = jobs.Layout(spark, scratch)
    layout.table("customer_profile").upsert(customers_df(spark, [("C1", "Asha", "GOLD")]))
    layout.table("product_catalog").upsert(products_df(spark, [("P1", "Phone", "toys")]))
    append_log(raw_df(spark, []), layout.raw_path)
    q = jobs.start_enrich_and_alert(layout, trigger={"processingTime": "0 seconds"})
    try:
        append_log(raw_df(spark, [raw_row("O1", "20000.00")]), layout.raw_path)
        q.processAllAvailable()
    finally:
        q.stop()
    row = layout.table("orders_enriched").read_current().first()
    assert (row.order_id, row.event_day, row.customer_name, row.category) == ("O1", "20240101", "Asha", "toys")


def test_replace_keeps_one_row_for_each_key(spark, scratch):
    from tidemark.operators import alerts, enrich
    dims = customers_df(spark, [("C1", "Asha", "GOLD")]), products_df(spark, [("P1", "Phone", "toys")])
    rows = lambda *r: alerts.high_value(enrich.enrich(raw_df(spark, [raw_row(o, a, time=t) for o, a, t in r]), *dims))
    t = UpsertTable.named(spark, scratch, "high_value_orders")
    t.upsert(rows(("A", "20000", "2024-01-01 10:00:00"), ("B", "20000", "2024-01-01 10:00:00")))
    t.upsert(rows(("A", "30000", "2024-01-02 10:00:00")))
    day_one = (F.col("event_time") >= "2024-01-01") & (F.col("event_time") < "2024-01-02")
    t.replace(day_one, rows(("A", "20000", "2024-01-01 10:00:00"), ("B", "21000", "2024-01-01 10:00:00")))
    got = lambda: sorted((r.order_id, float(r.order_amount)) for r in t.read_current().collect())
    assert got() == [("A", 30000.0), ("B", 21000.0)]
    t.upsert(rows(("C", "20000", "2024-01-03 10:00:00")))
    assert got() == [("A", 30000.0), ("B", 21000.0), ("C", 20000.0)]
    t.replace(F.lit(False), rows(("A", "1", "2024-01-02 10:00:00"), ("A", "40000", "2024-01-02 10:00:00")))
    assert got()[0] == ("A", 40000.0)


def test_errors_of_a_batch_that_runs_again_after_a_restart(spark, scratch):
    layout = jobs.Layout(spark, scratch)
    layout.table("customer_profile").upsert(customers_df(spark, [("C1", "Asha", "GOLD")]))
    layout.table("product_catalog").upsert(products_df(spark, [("P1", "Phone", "toys")]))
    append_log(raw_df(spark, [raw_row("O1", "10.00", product="P9"), raw_row("O2", "10.00", customer="C9"), raw_row("O3", "10.00")]), layout.raw_path)
    for _ in range(2):
        q = jobs.start_enrich_and_alert(layout, trigger={"availableNow": True}, on_miss="dlq", validate_now=False)
        q.awaitTermination()
        for name in fs_list(spark, f"{layout.checkpoint('enrich_alert')}/commits"):
            fs_delete(spark, f"{layout.checkpoint('enrich_alert')}/commits/{name}")     # the last batch runs again
    assert sorted(r.original_order_id for r in spark.read.parquet(layout.errors_path).collect()) == ["O1", "O2"]
    assert [r.order_id for r in layout.table("orders_enriched").read_current().collect()] == ["O3"]


def test_a_null_attribute_is_no_miss(spark, scratch):
    from tidemark.operators import enrich, quality
    raw = raw_df(spark, [raw_row("O1", "10.00"), raw_row("O2", "10.00", product="P9"), raw_row("O3", "10.00", customer="C9", product="P9")])
    dims = customers_df(spark, [("C1", None, "GOLD")]), products_df(spark, [("P1", None, "toys")])
    for small in (True, False):
        good, misses = quality.split_misses(enrich.enrich(raw, *dims, on_miss="dlq", small_customers=small, small_products=small, flags=True), "2024-01-01")
        assert [(r.order_id, r.category) for r in good.collect()] == [("O1", "toys")] and good.columns == enrich.ENRICHED_COLUMNS
        assert sorted((r.original_order_id, r.error_type) for r in misses.collect()) == [("O2", "UNKNOWN_PRODUCT"), ("O3", "UNKNOWN_CUSTOMER_AND_PRODUCT")]
    rate = quality.join_miss_rate(enrich.enrich(raw, *dims, flags=True)).first()
    assert (rate.customer_misses, rate.product_misses, rate.any_misses) == (1, 2, 2)


def test_run_checks_count_the_stored_tables(spark):
    from conftest import SF_SMALL
    from tidemark.plans import streams
    from tidemark.plans.frames import Tables
    tables = streams.stored_orders(Tables(spark, SF_SMALL))
    passed = {r.check_name: r.passed for r in streams.run_checks(tables).collect()}
    assert passed["enriched_ratio"]
    lost = {**tables, "orders_enriched": tables["orders_enriched"].where("not endswith(order_id, '7')")}
    assert not {r.check_name: r.passed for r in streams.run_checks(lost).collect()}["enriched_ratio"]
