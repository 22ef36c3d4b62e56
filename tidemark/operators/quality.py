"""Q1-Q12: data-quality rules, dead-letter split, quality metrics, invariants, PII masking.

``validate`` evaluates every rule in one projection and tags each row with the FIRST failing
rule (rule-table order). Callers persist that one frame and write two outputs from it
(valid rows, error_events), so the input is read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.operators.enrich import FOUND_COLUMNS
from tidemark.operators.ingest import RAW_COLUMNS


def rejection_rules(now, max_age: str = rules.MAX_EVENT_AGE, time_col: str = "event_time"):
    """(error_type, failing condition, message) in rule-table order. Clamp and lookup-miss
    rules repair instead of rejecting, so they are not listed here."""
    statuses = ", ".join(rules.VALID_PAYMENT_STATUS)
    cutoff = F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {max_age}")
    return [
        ("INVALID_AMOUNT", ~F.coalesce(F.col("order_amount") > 0, F.lit(False)),
         "order_amount missing or not > 0"),
        ("STALE_EVENT", ~F.coalesce(F.col(time_col).cast("timestamp_ntz") > cutoff, F.lit(False)),
         f"event_time not within {max_age} of processing time"),
        ("INVALID_PAYMENT_STATUS",
         ~F.coalesce(F.col("payment_status").isin(*rules.VALID_PAYMENT_STATUS), F.lit(False)),
         f"payment_status not in ({statuses})"),
    ]


def tag_errors(df: DataFrame, now, max_age: str = rules.MAX_EVENT_AGE) -> DataFrame:
    """Adds error_type / error_message (NULL when the row passes)."""
    etype = emsg = None
    for name, failing, message in rejection_rules(now, max_age):
        etype = F.when(failing, F.lit(name)) if etype is None else etype.when(failing, F.lit(name))
        emsg = F.when(failing, F.lit(message)) if emsg is None else emsg.when(failing, F.lit(message))
    return df.withColumn("error_type", etype).withColumn("error_message", emsg)


def clamp_quantity(df: DataFrame) -> DataFrame:
    lo, hi = rules.QUANTITY_CLAMP
    return df.withColumn("quantity", F.least(F.greatest(F.col("quantity"), F.lit(lo)), F.lit(hi)))


def payload(cols: list[str]) -> F.Column:
    """The original row as compact JSON; every value rendered as text, NULLs kept."""
    fields = []
    for c in cols:
        if c == "event_time":
            fields.append(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS").alias(c))
        else:
            fields.append(F.col(c).cast("string").alias(c))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def valid_rows(tagged: DataFrame) -> DataFrame:
    return clamp_quantity(tagged.where(F.col("error_type").isNull())).select(*RAW_COLUMNS)


def error_rows(tagged: DataFrame, failed_at) -> DataFrame:
    """error_events(original_order_id, error_type, error_message, raw_payload, failed_at)."""
    ts = failed_at if isinstance(failed_at, F.Column) else F.lit(failed_at).cast("timestamp_ntz")
    return tagged.where(F.col("error_type").isNotNull()).select(
        F.col("order_id").alias("original_order_id"), "error_type", "error_message",
        payload(RAW_COLUMNS).alias("raw_payload"), ts.alias("failed_at"))


def broken(orders: DataFrame) -> DataFrame:
    """Orders with faults put in by the digits of their id: amounts that are zero, negative or
    missing, an unknown status, quantities out of range. (To see the rules at work on data that
    keeps them.)"""
    n = F.substring("order_id", 5, 30).cast("bigint")
    amount = F.when(n % 11 == 0, F.lit(None)).when(n % 13 == 0, F.lit(0)).when(n % 17 == 0, -F.col("order_amount")).otherwise(F.col("order_amount"))
    status = F.when(n % 7 == 0, "REFUNDED").when(n % 19 == 0, F.lit(None)).otherwise(F.col("payment_status"))
    quantity = F.when(n % 3 == 0, 500).when(n % 5 == 0, -2).otherwise(F.col("quantity"))
    return (orders.withColumn("order_amount", amount.cast("decimal(10,2)")).withColumn("payment_status", status)
            .withColumn("quantity", quantity.cast("int")))


def rule_summary(tagged: DataFrame) -> DataFrame:
    """Rows by the rule that they break first (NULL: none), with their clamped quantities."""
    return (clamp_quantity(tagged).groupBy("error_type")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("quantity").cast("bigint").alias("units"),
                 F.min("quantity").alias("least"), F.max("quantity").alias("most")))


def validate(df: DataFrame, now, max_age: str = rules.MAX_EVENT_AGE):
    """-> (valid, errors). Persist the input (or write from foreachBatch) before using both."""
    tagged = tag_errors(df, now, max_age)
    return valid_rows(tagged), error_rows(tagged, now)


def join_miss_rate(enriched: DataFrame) -> DataFrame:
    """Q8: share of orders whose customer or product lookup returned nothing, by the flags of
    ``enrich(flags=True)``: an attribute that is NULL in the dimension is no miss. Stored rows
    have no flags; there a NULL name counts as a miss."""
    if set(FOUND_COLUMNS) <= set(enriched.columns):
        cmiss, pmiss = (~F.col(c) for c in FOUND_COLUMNS)
    else:
        cmiss, pmiss = F.col("customer_name").isNull(), F.col("product_name").isNull()
    agg = enriched.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(F.when(cmiss, 1).otherwise(0)).cast("long").alias("customer_misses"),
        F.sum(F.when(pmiss, 1).otherwise(0)).cast("long").alias("product_misses"),
        F.sum(F.when(cmiss | pmiss, 1).otherwise(0)).cast("long").alias("any_misses"))
    tot = F.col("total_orders").cast("double")
    return agg.select("*", (F.col("customer_misses") / tot).alias("customer_miss_rate"),
                      (F.col("product_misses") / tot).alias("product_miss_rate"),
                      (F.col("any_misses") / tot).alias("join_miss_rate"))


def rejection_rate(tagged: DataFrame) -> DataFrame:
    """Q10: rejected / all rows, from the tagged frame (one pass), with per-type counts."""
    return tagged.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("error_type").alias("rejected"),
        *[F.sum(F.when(F.col("error_type") == name, 1).otherwise(0)).cast("long").alias(name.lower())
          for name, _, _ in rejection_rules("2000-01-01")],
    ).withColumn("rejection_rate", F.col("rejected").cast("double") / F.col("total_rows"))


def invariants(enriched: DataFrame, high_value: DataFrame, suspicious: DataFrame,
               higher: str = "electronics", lower: str = "grocery") -> DataFrame:
    """Q11: acceptance checks as a result table (check_name, violations, passed).

    The last check: average order value of category ``higher`` exceeds that of ``lower``
    (a missing category counts as a violation).
    """
    e = enriched.agg(
        F.sum(F.when(F.col("customer_name").isNull() | F.col("product_name").isNull(), 1)
              .otherwise(0)).cast("long").alias("names"),
        F.avg(F.when(F.col("category") == higher, F.col("order_amount"))).alias("hi"),
        F.avg(F.when(F.col("category") == lower, F.col("order_amount"))).alias("lo"))
    h = high_value.agg(F.sum(F.when(F.col("order_amount") < rules.HIGH_VALUE_THRESHOLD, 1)
                             .otherwise(0)).cast("long").alias("hv"))
    s = suspicious.agg(F.sum(F.when(F.col("reason").isNull(), 1).otherwise(0)).cast("long")
                       .alias("reason"))
    # three one-row aggregates; a union + max pivots them into one row without a join
    parts = (e.select("names", "hi", "lo", F.lit(None).cast("long").alias("hv"),
                      F.lit(None).cast("long").alias("reason"))
             .unionByName(h.select(F.lit(None).cast("long").alias("names"),
                                   F.lit(None).cast("decimal(14,6)").alias("hi"),
                                   F.lit(None).cast("decimal(14,6)").alias("lo"), "hv",
                                   F.lit(None).cast("long").alias("reason")))
             .unionByName(s.select(F.lit(None).cast("long").alias("names"),
                                   F.lit(None).cast("decimal(14,6)").alias("hi"),
                                   F.lit(None).cast("decimal(14,6)").alias("lo"),
                                   F.lit(None).cast("long").alias("hv"), "reason")))
    row = parts.agg(*[F.max(c).alias(c) for c in ["names", "hi", "lo", "hv", "reason"]])
    cat_bad = F.when(F.col("hi").isNotNull() & F.col("lo").isNotNull() & (F.col("hi") > F.col("lo")),
                     0).otherwise(1).cast("long")
    checks = F.array(
        F.struct(F.lit("enriched_names_present").alias("check_name"),
                 F.coalesce(F.col("names"), F.lit(0).cast("long")).alias("violations")),
        F.struct(F.lit("high_value_threshold").alias("check_name"),
                 F.coalesce(F.col("hv"), F.lit(0).cast("long")).alias("violations")),
        F.struct(F.lit("suspicious_reason_present").alias("check_name"),
                 F.coalesce(F.col("reason"), F.lit(0).cast("long")).alias("violations")),
        F.struct(F.lit(f"avg_{higher}_gt_{lower}").alias("check_name"), cat_bad.alias("violations")))
    return row.select(F.inline(checks)).withColumn("passed", F.col("violations") == 0)


def mask_pii(df: DataFrame, hash_cols=("customer_id",), name_cols=("customer_name",),
             key: str | None = None) -> DataFrame:
    """Q12: ids -> SHA-256 hex of key and id; names -> first letter + '***'.

    Masked ids can be joined among tables masked with the same key. Ids are few and regular, so
    only a secret ``key`` keeps them from being found by listing; without one the hash is a
    stable pseudonym and no protection. The key is hashed around the id twice, as an HMAC is."""
    out = df
    for c in hash_cols:
        if key is None:
            out = out.withColumn(c, F.sha2(F.col(c), 256))
        else:
            inner = F.sha2(F.concat(F.lit(f"{key}:inner:"), F.col(c)), 256)
            out = out.withColumn(c, F.sha2(F.concat(F.lit(f"{key}:outer:"), inner), 256))
    for c in name_cols:
        out = out.withColumn(c, F.when(F.col(c).isNotNull(),
                                       F.concat(F.substring(c, 1, 1), F.lit("***"))))
    return out


def split_misses(enriched: DataFrame, failed_at):
    """C14 on_miss="dlq", for rows of ``enrich(flags=True)``: (rows with both lookups found,
    error_events rows for the misses)."""
    customer, product = (F.col(c) for c in FOUND_COLUMNS)
    kind = F.when(~customer & ~product, "UNKNOWN_CUSTOMER_AND_PRODUCT").when(~customer, "UNKNOWN_CUSTOMER").otherwise("UNKNOWN_PRODUCT")
    ts = failed_at if isinstance(failed_at, F.Column) else F.lit(failed_at).cast("timestamp_ntz")
    misses = enriched.where(~customer | ~product).select(
        F.col("order_id").alias("original_order_id"), kind.alias("error_type"),
        F.lit("dimension lookup found no row").alias("error_message"),
        payload(RAW_COLUMNS).alias("raw_payload"), ts.alias("failed_at"))
    return enriched.where(customer & product).drop(*FOUND_COLUMNS), misses
