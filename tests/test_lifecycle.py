"""FIXTURES 5.11 / 5.12 and L5, L8, L9: tiering, union reads, retention, compaction, purge,
schema evolution — on real directories below the shared scratch root."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import raw_df, raw_row
from tidemark import schemas
from tidemark.sources import lifecycle as lc
from tidemark.sources.log import append_log, read_log
from tidemark.sources.upsert import fs_list

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05"]


def _log(spark, path, per_day=2, days=DAYS, files=1):
    rows = [raw_row(f"{d}-{i}", "1.00", customer=f"C{i}", time=f"{d} 10:00:0{i}")
            for d in days for i in range(per_day)]
    for _ in range(files):   # several appends -> several files per day
        append_log(raw_df(spark, rows), path)
    return rows


def test_tiering_union_and_cold_reads(spark, scratch):
    hot, cold = f"{scratch}/hot", f"{scratch}/cold"
    _log(spark, hot)
    assert lc.tier(spark, hot, cold, schemas.ORDERS_RAW, "20240104") == "20240104"
    # day 3 is now in both tiers; the union reads each key once
    u = lc.read_union(spark, hot, cold, schemas.ORDERS_RAW)
    assert u.count() == 10 and u.select("order_id").distinct().count() == 10
    c = lc.cold_read(spark.read.schema(schemas.ORDERS_RAW).parquet(cold), "20240104")
    assert sorted({r.event_day for r in c.collect()}) == ["20240101", "20240102", "20240103"]
    # re-running the copy changes nothing; the hot TTL then drops old hot days
    lc.tier(spark, hot, cold, schemas.ORDERS_RAW, "20240104")
    assert lc.read_union(spark, hot, cold, schemas.ORDERS_RAW).count() == 10
    removed = lc.hot_ttl(spark, hot, cold, keep_days=2)
    assert removed == ["20240101"]
    assert lc.read_union(spark, hot, cold, schemas.ORDERS_RAW).count() == 10


def test_retention_counts_history_days(spark, scratch):
    path = f"{scratch}/log"
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    _log(spark, path, per_day=1, days=days)
    removed = lc.apply_retention(spark, path, "20240110", days=7)
    assert removed == ["20240101", "20240102"]
    kept = {r.event_day for r in read_log(spark, path).collect()}
    assert kept == {f"202401{d:02d}" for d in range(3, 11)}
    assert lc.cutoff_day("20240110", 7) == "20240103"


def test_compaction_keeps_rows(spark, scratch):
    path = f"{scratch}/cold"
    _log(spark, path, per_day=3, days=DAYS[:2], files=5)
    before = sorted(r.order_id for r in read_log(spark, path).collect())
    done = lc.compact_days(spark, path, schemas.ORDERS_RAW, ["20240101", "20240102"], min_files=5)
    assert done == ["20240101", "20240102"]
    assert len([f for f in fs_list(spark, f"{path}/event_day=20240101") if f.endswith(".parquet")]) == 1
    assert sorted(r.order_id for r in read_log(spark, path).collect()) == before


def test_purge_rewrites_only_affected_days(spark, scratch):
    path = f"{scratch}/log"
    _log(spark, path, per_day=2, days=DAYS[:3])
    days = lc.purge_files(spark, path, schemas.ORDERS_RAW, "customer_id", "C1")
    assert days == sorted(days) and set(days) == {"20240101", "20240102", "20240103"}
    left = read_log(spark, path)
    assert left.where(F.col("customer_id") == "C1").count() == 0 and left.count() == 3


def test_new_nullable_column_reads_old_files(spark, scratch):
    path = f"{scratch}/log"
    _log(spark, path, per_day=1, days=DAYS[:1])
    newer = T.StructType(schemas.ORDERS_RAW.fields + [T.StructField("coupon", T.StringType())])
    rows = read_log(spark, path, schema=newer).collect()
    assert len(rows) == 1 and rows[0].coupon is None


def test_export_month(spark, scratch):
    raw = raw_df(spark, [raw_row("a", "1", time="2024-01-31 23:59:59"),
                         raw_row("b", "1", time="2024-02-01 00:00:00")])
    lc.export(raw, "2024-01", f"{scratch}/export")
    assert [r.order_id for r in spark.read.parquet(f"{scratch}/export").collect()] == ["a"]


def test_hot_day_is_split_over_tasks(spark):
    from tidemark.sources.log import spread_by_day
    rows = [raw_row(f"h{i}", "1", time="2024-01-01 10:00:00") for i in range(300)] + \
           [raw_row(f"c{i}", "1", time="2024-01-02 10:00:00") for i in range(30)]
    # tiny data: keep AQE from merging the shuffle partitions so the spread is visible
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = spread_by_day(raw_df(spark, rows), rows_per_file=50)
        per_task = out.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
        tasks_for_hot = out.where(F.col("event_day") == "20240101").rdd \
            .mapPartitions(lambda it: [1 if any(True for _ in it) else 0]).sum()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(per_task) == 330
    assert max(per_task) < 300            # the hot day (300 rows, 6 slots) is not one task
    assert tasks_for_hot >= 3
