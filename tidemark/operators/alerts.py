"""Stateless alert filters over enriched orders (stream or batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.functions.exprs import any_match, first_match

HIGH_VALUE_COLUMNS = ["order_id", "customer_id", "customer_name", "loyalty_tier",
                      "order_amount", "city", "category", "event_time"]
SUSPICIOUS_COLUMNS = ["order_id", "customer_id", "order_amount", "payment_status",
                      "payment_method", "device_type", "city", "reason", "event_time"]


def high_value(enriched: DataFrame, threshold: float = rules.HIGH_VALUE_THRESHOLD) -> DataFrame:
    return enriched.where(F.col("order_amount") >= threshold).select(*HIGH_VALUE_COLUMNS)


def suspicious(enriched: DataFrame, rule_list=None, all_reasons: bool = False) -> DataFrame:
    """Orders matching any rule; ``reason`` is the first matching rule in order.

    all_reasons=True adds ``reasons``: every matching rule, in rule order.
    """
    rule_list = rule_list or rules.SUSPICIOUS_RULES
    out = enriched.where(any_match(rule_list)).withColumn("reason", first_match(rule_list))
    cols = list(SUSPICIOUS_COLUMNS)
    if all_reasons:
        matches = [F.when(F.expr(c), F.lit(r)) for c, r in rule_list]
        out = out.withColumn("reasons", F.filter(F.array(*matches), lambda x: x.isNotNull()))
        cols.append("reasons")
    return out.select(*cols)


def failed_payments(enriched: DataFrame) -> DataFrame:
    """failed payments (the demo's feed columns)."""
    return (enriched.where(F.col("payment_status") == "FAILED")
            .select("order_id", "customer_name", "order_amount", "payment_method",
                    "device_type", "city", "event_time"))
