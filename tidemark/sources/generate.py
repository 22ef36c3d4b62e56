"""Synthetic dimensions and order streams, generated inside Spark.

Every field is a pure function of (seed, row number) built from ``xxhash64`` and ``md5``, so
generation is distributed (``spark.range`` / the ``rate`` source split across tasks) and a
retried task reproduces exactly the same rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.functions.exprs import slot_pick
from tidemark.operators.ingest import to_orders_raw


def _u(seed: int, salt: str, idx: F.Column, modulus: int) -> F.Column:
    """Uniform integer in [0, modulus) from (seed, salt, idx)."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), idx), F.lit(modulus))


def _pick(values: list[str], slot: F.Column) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (slot + 1).cast("int"))


def customer_fields(idx: F.Column, seed: int, today, id_chars: int = 8) -> dict[str, F.Column]:
    """Customer attributes for row number ``idx`` (shared by the order generator)."""
    female = (idx % 2) == 1
    first = F.when(female, _pick(rules.FIRST_NAMES_FEMALE, _u(seed, "ff", idx, len(rules.FIRST_NAMES_FEMALE)))) \
             .otherwise(_pick(rules.FIRST_NAMES_MALE, _u(seed, "fm", idx, len(rules.FIRST_NAMES_MALE))))
    city_w = [(c, w) for c, _, w in rules.CUSTOMER_CITY]
    region_w = [(r, w) for _, r, w in rules.CUSTOMER_CITY]
    total = sum(w for _, w in city_w)
    slot = _u(seed, "city", idx, total)
    city, region = slot_pick(slot, city_w), slot_pick(slot, region_w)
    last = None
    for reg, names in rules.LAST_NAMES.items():
        pick = _pick(names, _u(seed, "last", idx, len(names)))
        last = F.when(region == reg, pick) if last is None else last.when(region == reg, pick)
    tier_total = sum(w for _, w in rules.LOYALTY_TIER)
    tier = slot_pick(_u(seed, "tier", idx, tier_total), rules.LOYALTY_TIER)
    age = None
    for t, (lo, hi) in rules.SIGNUP_AGE_DAYS.items():
        a = F.lit(lo) + _u(seed, "age", idx, hi - lo + 1)
        age = F.when(tier == t, a) if age is None else age.when(tier == t, a)
    signup = F.date_sub(F.lit(str(today)).cast("date"), age.cast("int"))
    key = F.concat(F.lit("customer-"), idx.cast("string"), F.lit("-"), first, F.lit("-"), last)
    return {
        "customer_id": F.concat(F.lit("CUS-"), F.substring(F.sha2(key, 256), 1, id_chars)),
        "customer_name": F.concat(first, F.lit(" "), last),
        "city": city, "loyalty_tier": tier, "signup_date": signup,
        "updated_at": F.to_timestamp(F.concat(signup.cast("string"), F.lit(" " + rules.CUSTOMER_UPDATED_TIME))),
    }


def gen_customers(spark: SparkSession, n: int = 20, seed: int = 42, today=None,
                  id_chars: int = 8) -> DataFrame:
    """``n`` customer profiles. Pass ``today`` for reproducible signup dates.
    8 id characters reproduce the reference's ids; use more beyond ~10^4 customers (collisions)."""
    today = today or _dt.date.today()
    idx = F.col("id")
    f = customer_fields(idx, seed, today, id_chars)
    return spark.range(n).select(*[c.alias(k) for k, c in f.items()])


def product_fields(idx: F.Column, seed: int) -> dict[str, F.Column]:
    base = (idx % len(rules.PRODUCTS)).cast("int")
    col = lambda i: _pick([str(p[i]) for p in rules.PRODUCTS], base)
    lo = _pick([str(p[5][0]) for p in rules.PRODUCTS], base).cast("int")
    hi = _pick([str(p[5][1]) for p in rules.PRODUCTS], base).cast("int")
    round_no = F.floor(idx / len(rules.PRODUCTS))
    sku = F.when(round_no == 0, col(0)).otherwise(F.concat(col(0), F.lit("-"), round_no.cast("string")))
    inv = lo + F.pmod(F.xxhash64(F.lit(seed), F.lit("inv"), idx), hi - lo + 1)
    return {"product_id": sku, "product_name": col(1), "category": col(2), "brand": col(3),
            "unit_price": _pick([f"{p[4]:.2f}" for p in rules.PRODUCTS], base).cast("decimal(10,2)"),
            "inventory_count": inv.cast("int"),
            "updated_at": F.lit(rules.PRODUCT_UPDATED_AT).cast("timestamp")}


def gen_products(spark: SparkSession, n: int = len(rules.PRODUCTS), seed: int = 42) -> DataFrame:
    """The seed catalog (n <= 30), or n SKUs cycling through it with a suffix."""
    f = product_fields(F.col("id"), seed)
    return spark.range(n).select(*[c.alias(k) for k, c in f.items()])


def _uuid(seed: int, idx: F.Column) -> F.Column:
    h = F.md5(F.concat(F.lit(f"{seed}-"), idx.cast("string")))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def order_fields(idx: F.Column, base_time: F.Column, seed: int, n_customers: int,
                 n_products: int, today) -> dict[str, F.Column]:
    cust_idx = _u(seed, "cust", idx, n_customers)
    prod_idx = _u(seed, "prod", idx, n_products)
    lag_ms = _u(seed, "lag", idx, rules.EVENT_TIME_MAX_AGE_SECONDS * 1000 + 1)
    qlo, qhi = rules.QUANTITY_RANGE
    return {
        "order_id": _uuid(seed, idx),
        "customer_id": customer_fields(cust_idx, seed, today)["customer_id"],
        "product_id": product_fields(prod_idx, seed)["product_id"],
        "order_amount_str": _pick(rules.ORDER_AMOUNTS, _u(seed, "amt", idx, len(rules.ORDER_AMOUNTS))),
        "quantity": (F.lit(qlo) + _u(seed, "qty", idx, qhi - qlo + 1)).cast("int"),
        "payment_status": slot_pick(_u(seed, "pay", idx, 12), rules.PAYMENT_STATUS),
        "order_status": slot_pick(_u(seed, "ost", idx, 10), rules.ORDER_STATUS),
        "payment_method": slot_pick(_u(seed, "pm", idx, 20), rules.PAYMENT_METHOD),
        "device_type": slot_pick(_u(seed, "dev", idx, 10), rules.DEVICE_TYPE),
        "city": slot_pick(_u(seed, "city", idx, 20), rules.ORDER_CITY),
        "event_time": base_time - F.make_dt_interval(secs=lag_ms / F.lit(1000.0)),
    }


def gen_orders_batch(spark: SparkSession, n: int, seed: int = 42,
                     start: str = "2024-01-01 00:00:00", rows_per_second: int = 50,
                     n_customers: int = 20, n_products: int = len(rules.PRODUCTS),
                     today=None, partitions: int | None = None) -> DataFrame:
    """S12 (batch): ``n`` generator rows; row i is "generated" at start + i / rate seconds and
    carries an event time up to 15 s earlier (FAKE_ORDERS shape, amount as text)."""
    today = today or _dt.date.today()
    ids = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(n)
    base = F.lit(start).cast("timestamp") + F.make_dt_interval(
        secs=F.col("id") / F.lit(float(rows_per_second)))
    f = order_fields(F.col("id"), base, seed, n_customers, n_products, today)
    return ids.select(*[c.alias(k) for k, c in f.items()])


def gen_orders_stream(spark: SparkSession, rows_per_second: int = 50, seed: int = 42,
                      n_customers: int = 20, n_products: int = len(rules.PRODUCTS),
                      today=None, partitions: int | None = None) -> DataFrame:
    """S12 (stream): the ``rate`` source drives the same expressions (X14 rate limit)."""
    today = today or _dt.date.today()
    r = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    if partitions:
        r = r.option("numPartitions", partitions)
    f = order_fields(F.col("value"), F.col("timestamp"), seed, n_customers, n_products, today)
    return r.load().select(*[c.alias(k) for k, c in f.items()])


def seed_dimensions(spark: SparkSession, root: str, n_customers: int = 20,
                    n_products: int = len(rules.PRODUCTS), seed: int = 42, today=None):
    """Batch-load generated dimensions into the customer/product upsert tables."""
    from tidemark.sources.upsert import UpsertTable
    UpsertTable.named(spark, root, "customer_profile").upsert(
        gen_customers(spark, n_customers, seed, today))
    UpsertTable.named(spark, root, "product_catalog").upsert(gen_products(spark, n_products, seed))


def load(spark: SparkSession, log_path: str, checkpoint: str, rows_per_second: int = 5000,
         seconds: int | None = None, seed: int = 42, today=None):
    """Synthetic load at a fixed rate into the raw log. Returns the running query; with
    ``seconds`` it is stopped after that long (the caller's clock, not the data's)."""
    from tidemark.sources.log import start_log_writer
    stream = to_orders_raw(gen_orders_stream(spark, rows_per_second, seed, today=today))
    q = start_log_writer(stream, log_path, checkpoint, trigger={"processingTime": "1 second"})
    if seconds:
        q.awaitTermination(seconds)
        q.stop()
    return q
