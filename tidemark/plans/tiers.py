"""Registered queries over two stored tiers.

Each stores the whole table, but not at once: some rows of old days come only after these days
were tiered (late orders), others come first in a wrong version (corrected later). A tier run,
the removal of tiered days from hot and the late writes lie between; in the end every row is
stored, so the result is that of the table as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import analytics as an
from tidemark.plans.frames import Tables
from tidemark.plans.streams import _ntz
from tidemark.session import scratch_dir
from tidemark.sources import keyed, lifecycle, purge, tiering
from tidemark.sources.log import append_log, read_log, start_log_writer
from tidemark.sources.upsert import UpsertTable

BOUNDARY = "20240115"   # days before it are tiered
PURGED = "CUS-00000007"


def _arrival(*columns: str) -> F.Column:
    """0: comes late, 1: comes first in a wrong version, else: comes once, in time."""
    return F.pmod(F.xxhash64(*columns), F.lit(8))


def _two_tiers(t: Tables, name: str, rows: DataFrame, wrong: dict) -> tuple[UpsertTable, str]:
    """A keyed table whose old days are in cold, and whose late rows and corrections are in hot."""
    root = scratch_dir(t.spark, "tiers")
    table, cold = UpsertTable.named(t.spark, f"{root}/hot", name), f"{root}/cold/{name}"
    old, arrival = F.col(table.partition) < BOUNDARY, _arrival(*table.keys)
    first = rows.where(~F.coalesce(old & (arrival == 0), F.lit(False)))
    for column, value in wrong.items():
        first = first.withColumn(column, F.when(old & (arrival == 1), F.lit(value).cast(table.schema[column].dataType)).otherwise(F.col(column)))
    table.upsert(first)
    tiering.tier_table(table, cold, BOUNDARY)
    tiering.hot_ttl(table, cold, keep_days=0)
    table.upsert(rows.where(old & (arrival <= 1)))
    return table, cold


def union_read(t: Tables) -> DataFrame:
    """Revenue by category over both tiers of orders_enriched."""
    table, cold = _two_tiers(t, "orders_enriched", t.enriched, {"category": "wrong", "order_amount": 0})
    return (tiering.read_union(table, cold).groupBy("category")
            .agg(F.count(F.lit(1)).alias("total_orders"), an.money_sum().alias("total_revenue")))


def cold_read(t: Tables) -> DataFrame:
    """The cold tier of the log, late orders included."""
    root = scratch_dir(t.spark, "tiers")
    hot, cold = f"{root}/hot", f"{root}/cold"
    raw = t.raw.withColumn("event_time", F.col("event_time").cast("timestamp"))
    late = (F.col("event_day") < BOUNDARY) & (_arrival("order_id") == 0)
    append_log(raw.where(~F.coalesce(late, F.lit(False))), hot)
    lifecycle.tier(t.spark, hot, cold, schemas.ORDERS_RAW, BOUNDARY)
    lifecycle.hot_ttl(t.spark, hot, cold, keep_days=0)
    append_log(raw.where(late), hot)
    lifecycle.tier(t.spark, hot, cold, schemas.ORDERS_RAW, BOUNDARY)
    rows = t.spark.read.schema(schemas.ORDERS_RAW).parquet(cold).select(*schemas.ORDERS_RAW.fieldNames())
    return _ntz(lifecycle.cold_read(rows, BOUNDARY))


def cold_trend(t: Tables) -> DataFrame:
    """The oldest windows, from the cold tier of revenue_5min alone."""
    table, cold = _two_tiers(t, "revenue_5min", t.revenue_5min, {"total_revenue": 0, "total_orders": 0})
    tiering.tier_table(table, cold, BOUNDARY)   # late windows and corrections
    return an.oldest_windows(_ntz(tiering.read_cold(table, cold)), 100)


def stored_lookup(t: Tables) -> DataFrame:
    """One order by its id, from orders_enriched stored by the key."""
    path = f"{scratch_dir(t.spark, 'keyed')}/orders_enriched"
    keyed.write_keyed(t.enriched, path, "order_id", buckets=16)
    return keyed.lookup(t.spark, path, t.enriched.schema, "order_id", "ORD-0000000042")


def live_purge(t: Tables) -> DataFrame:
    """Orders by day after a customer was purged from a log that a stream wrote, over both
    tiers (the purge came before a tier run; later orders of the customer are joined away)."""
    root = scratch_dir(t.spark, "purge")
    source, log, cold, listed = (f"{root}/{n}" for n in ("source", "log", "cold", "purged_keys"))
    t.raw.withColumn("event_time", F.col("event_time").cast("timestamp")).write.parquet(source)
    query = start_log_writer(t.spark.readStream.schema(schemas.ORDERS_RAW).parquet(source), log, f"{root}/checkpoint")
    query.awaitTermination()
    purge.purge(t.spark, listed, "customer_id", [PURGED])
    lifecycle.tier(t.spark, log, cold, schemas.ORDERS_RAW, BOUNDARY, keep=lambda rows: purge.without(rows, listed))
    lifecycle.hot_ttl(t.spark, log, cold, keep_days=0)
    rows = purge.without(lifecycle.read_union(t.spark, log, cold, schemas.ORDERS_RAW), listed)
    return rows.groupBy("event_day").agg(F.count(F.lit(1)).alias("orders"), F.count("customer_id").alias("with_customer"))


def log_range(t: Tables) -> DataFrame:
    """a range of time of the stored log: days outside it are not read."""
    path = f"{scratch_dir(t.spark, 'log')}/orders_raw"
    append_log(t.raw.withColumn("event_time", F.col("event_time").cast("timestamp")), path)
    return _ntz(an.between_times(read_log(t.spark, path), "2024-01-10 00:00:00", "2024-01-12 12:00:00"))


def _stored_windows(t: Tables, name: str, rows: DataFrame) -> DataFrame:
    table = UpsertTable.named(t.spark, scratch_dir(t.spark, "windows"), name)
    table.upsert(rows)
    table.compact()
    return table.read_current()


def stored_recent_windows(t: Tables, now: str) -> DataFrame:
    """recent windows of the stored table, whose other days are not read."""
    return _ntz(an.recent_windows(_stored_windows(t, "revenue_5min", t.revenue_5min), now, hours=6))


def stored_city_since(t: Tables, since: str) -> DataFrame:
    """City revenue since a time, from the stored table."""
    return an.city_revenue_since(_stored_windows(t, "city_revenue_5min", t.city_revenue_5min), since)
