"""Known-answer ids, weights within tolerance, determinism."""

from pyspark.sql import functions as F

from tidemark.operators.ingest import to_orders_raw
from tidemark.sources import generate as g


def test_known_answer_customer_id(spark):
    v = spark.range(1).select(F.concat(F.lit("CUS-"), F.substring(
        F.sha2(F.lit("customer-0-Rohan-Shah"), 256), 1, 8))).first()[0]
    assert v == "CUS-bc3f5734"


def test_customers_follow_the_id_rule_and_weights(spark):
    c = g.gen_customers(spark, 4000, seed=42, today="2025-01-01", id_chars=16)
    rows = c.collect()
    assert len({r.customer_id for r in rows}) == 4000
    tiers = {}
    for r in rows:
        tiers[r.loyalty_tier] = tiers.get(r.loyalty_tier, 0) + 1
    assert abs(tiers["BRONZE"] / 4000 - 0.40) < 0.03 and abs(tiers["PLATINUM"] / 4000 - 0.10) < 0.02
    ages = {r.loyalty_tier: (2025 * 365) for r in rows}
    assert ages
    plat = [r for r in rows if r.loyalty_tier == "PLATINUM"]
    import datetime as dt
    assert all(700 <= (dt.date(2025, 1, 1) - r.signup_date).days <= 900 for r in plat)


def test_order_shares(spark):
    o = to_orders_raw(g.gen_orders_batch(spark, 100_000, seed=42, today="2025-01-01"))
    s = o.agg(F.avg((F.col("order_amount") >= 12999).cast("int")).alias("hv"),
              F.avg((F.col("payment_status") == "FAILED").cast("int")).alias("failed"),
              F.avg((F.col("payment_method") == "COD").cast("int")).alias("cod"),
              F.min("quantity").alias("qmin"), F.max("quantity").alias("qmax")).first()
    assert abs(s.hv - 0.25) < 0.01 and abs(s.failed - 2 / 12) < 0.01 and abs(s.cod - 0.15) < 0.01
    assert (s.qmin, s.qmax) == (1, 3)
    from tidemark.operators import alerts
    susp = alerts.suspicious(o.withColumn("customer_name", F.lit(None)).withColumn("loyalty_tier", F.lit(None))
                             .withColumn("category", F.lit(None))).count()
    assert abs(susp / 100_000 - 0.2571) < 0.01


def test_same_seed_same_rows(spark):
    a = g.gen_orders_batch(spark, 1000, seed=7, today="2025-01-01", partitions=3)
    b = g.gen_orders_batch(spark, 1000, seed=7, today="2025-01-01", partitions=5)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    ids = {r.customer_id for r in g.gen_customers(spark, 20, 7, "2025-01-01").collect()}
    used = {r.customer_id for r in a.select("customer_id").distinct().collect()}
    assert used <= ids


def test_products(spark):
    p = g.gen_products(spark).collect()
    assert len(p) == 30 and len({r.category for r in p}) == 6
    low = sorted((r.inventory_count, r.product_id) for r in p if r.inventory_count < 100)
    assert all(r[1].startswith("SKU-") for r in low)


def test_seed_dimensions_into_upsert_tables(spark, scratch):
    from tidemark.sources.upsert import UpsertTable
    g.seed_dimensions(spark, scratch, n_customers=20, n_products=30, today="2025-01-01")
    cust = UpsertTable.named(spark, scratch, "customer_profile").read_current()
    prod = UpsertTable.named(spark, scratch, "product_catalog").read_current()
    assert cust.count() == 20 and prod.count() == 30
    low = [r.product_id for r in prod.where("inventory_count < 100").collect()]
    assert all(p.startswith("SKU-ELEC") for p in low)
