"""Dimension lookups.

The reference looks every order up in a key-value store at processing time. In Spark the
dimension is read once (per query, or per micro-batch in streaming) and joined:

* broadcast hash join when the dimension is provably small — ``bounded_broadcast`` counts its
  rows (a distributed count) before hinting;
* otherwise a shuffled join with the reduced dimension written out first. Then nothing but the
  exchanges stands below the join, and AQE splits the orders of a hot or NULL key; a grouping
  between exchange and join would keep it from doing so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 500_000   # narrow projections (<= 4 short strings): well under 100 MB

CUSTOMER_COLS = ["customer_name", "loyalty_tier"]
PRODUCT_COLS = ["product_name", "brand", "category"]
UNKNOWN = "UNKNOWN"
FOUND_COLUMNS = ["_customer_found", "_product_found"]

ENRICHED_COLUMNS = ["event_day", "order_id", "customer_id", "customer_name", "loyalty_tier",
                    "product_id", "product_name", "brand", "category", "city", "order_amount",
                    "quantity", "payment_status", "order_status", "payment_method",
                    "device_type", "event_time"]


def broadcast_limit(spark) -> int:
    return int(spark.conf.get("tidemark.broadcast.maxRows", str(DEFAULT_BROADCAST_ROWS)))


def fits_broadcast(dim: DataFrame, max_rows: int | None = None) -> bool:
    """True when ``dim`` has at most ``max_rows`` rows.

    A plain distributed ``count()``: per-task partial counts, one number to the driver, and
    on Parquet often only row-group metadata is read. (A ``limit(n).count()`` would instead
    move up to partitions x n rows into a single task.)
    """
    limit = max_rows if max_rows is not None else broadcast_limit(dim.sparkSession)
    return dim.count() <= limit


def bounded_broadcast(dim: DataFrame, small: bool | None = None) -> DataFrame:
    """Hint a broadcast only behind a size check; beyond it the planner shuffles."""
    if small is None:
        small = fits_broadcast(dim)
    return F.broadcast(dim) if small else dim


def one_per_key(dim: DataFrame, key: str, columns: list[str],
                order_col: str = "updated_at") -> DataFrame:
    """The dimension as a lookup sees it: at most one row per key, the newest version
    (``order_col``, then a row hash for ties).

    Besides guaranteeing that a lookup never multiplies facts, the grouping tells Catalyst the
    key is unique: a LEFT JOIN whose dimension columns are never used is removed from the plan.
    """
    from tidemark.sources.upsert import latest_per_key
    cols = [key, *columns]
    order = [order_col] if order_col in dim.columns else []
    side = dim.select(*cols, *order).withColumn("_tie", F.xxhash64(*[F.col(c) for c in cols]))
    return latest_per_key(side, [key], [*order, "_tie"]).select(*cols)


def written(dim: DataFrame) -> DataFrame:
    """A reduced dimension as a table below the shared folder, for shuffled joins."""
    from tidemark.session import scratch_dir
    path = scratch_dir(dim.sparkSession, "dimension")
    dim.write.parquet(path)
    return dim.sparkSession.read.schema(dim.schema).parquet(path)


def lookup(facts: DataFrame, dim: DataFrame, key: str, columns: list[str],
           small: bool | None = None, unique: bool = False, found: str | None = None) -> DataFrame:
    """LEFT JOIN facts to the latest dimension version on ``key`` (one dim row per key).
    ``unique=True``: the caller already holds one row per key (e.g. a cached folded view).
    ``found``: a column that tells whether the dimension has the key (its attributes may be
    NULL all the same)."""
    side = dim.select(key, *columns) if unique else one_per_key(dim, key, columns)
    if small is None:
        small = fits_broadcast(side)
    if not small and not unique:
        side = written(side)
    if found:
        out = facts.join(bounded_broadcast(side.withColumn(found, F.lit(True)), small), on=key, how="left")
        return out.withColumn(found, F.coalesce(F.col(found), F.lit(False)))
    return facts.join(bounded_broadcast(side, small), on=key, how="left")


def enrich(orders: DataFrame, customers: DataFrame, products: DataFrame,
           on_miss: str = "null", small_customers: bool | None = None,
           small_products: bool | None = None, unique_dims: bool = False, flags: bool = False) -> DataFrame:
    """orders_raw -> orders_enriched (17 columns; the city is the order's, not the customer's).

    on_miss: "null" keeps NULL attributes (reference code), "unknown" writes "UNKNOWN"
    (documented data-quality rule). Rows for the dead-letter table: ``operators.quality``, which
    needs ``flags``: two more columns that tell which lookups found a row.
    """
    flagged = FOUND_COLUMNS if flags else [None, None]
    out = lookup(orders, customers, "customer_id", CUSTOMER_COLS, small_customers, unique_dims, flagged[0])
    out = lookup(out, products, "product_id", PRODUCT_COLS, small_products, unique_dims, flagged[1])
    if on_miss == "unknown":
        for c in CUSTOMER_COLS + PRODUCT_COLS:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(UNKNOWN)))
    elif on_miss not in ("null", "dlq"):
        raise ValueError(f"on_miss must be 'null', 'unknown' or 'dlq', got {on_miss!r}")
    # "dlq": callers split the rows without a match off with quality.split_misses
    return out.select(*ENRICHED_COLUMNS, *(FOUND_COLUMNS if flags else []))


def unknown_keys(facts: DataFrame, dim: DataFrame, key: str, small: bool | None = None) -> DataFrame:
    """Facts whose key has no dimension row (anti join), counted per key."""
    missing = facts.join(bounded_broadcast(dim.select(key), small), on=key, how="left_anti")
    return missing.groupBy(key).agg(F.count(F.lit(1)).alias("missing_orders"))


def known_keys(facts: DataFrame, dim: DataFrame, key: str, small: bool | None = None) -> DataFrame:
    """Facts whose key exists in the dimension (semi join)."""
    return facts.join(bounded_broadcast(dim.select(key), small), on=key, how="left_semi")
