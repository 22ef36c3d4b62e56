"""FIXTURES 5.7-5.9: data-quality rules, percentage rounding, top-k ties."""

from decimal import Decimal

from pyspark.sql import functions as F

from conftest import customers_df, products_df, raw_df, raw_row
from tidemark.operators import analytics as an, enrich, quality

NOW = "2024-01-31 00:00:00"


def _tagged(spark, rows):
    return quality.tag_errors(raw_df(spark, rows), NOW)


def test_rules_and_first_failing_rule(spark):
    rows = [
        raw_row("zero", "0"), raw_row("neg", "-1"),
        raw_row("stale", "10", time="2024-01-30 00:00:00"),          # exactly now - 1 day
        raw_row("fresh", "10", time="2024-01-30 00:00:00.001"),
        raw_row("refunded", "10", status="REFUNDED", time="2024-01-30 12:00:00"),
        raw_row("nullstatus", "10", status=None, time="2024-01-30 12:00:00"),
        raw_row("badamt", None, time="2024-01-30 12:00:00"),
        raw_row("two", "0", status="REFUNDED", time="2024-01-30 12:00:00"),
    ]
    got = {r.order_id: r.error_type for r in _tagged(spark, rows).collect()}
    assert got == {"zero": "INVALID_AMOUNT", "neg": "INVALID_AMOUNT", "stale": "STALE_EVENT",
                   "fresh": None, "refunded": "INVALID_PAYMENT_STATUS",
                   "nullstatus": "INVALID_PAYMENT_STATUS", "badamt": "INVALID_AMOUNT",
                   "two": "INVALID_AMOUNT"}


def test_try_cast_amount_text(spark):
    from tidemark.operators.ingest import to_orders_raw
    from tidemark import schemas
    import datetime as dt
    gen = spark.createDataFrame(
        [("a", "C", "P", "abc", 1, "SUCCESS", "PLACED", "UPI", "WEB", "Pune", dt.datetime(2024, 1, 1)),
         ("b", "C", "P", "123456789.00", 1, "SUCCESS", "PLACED", "UPI", "WEB", "Pune", dt.datetime(2024, 1, 1)),
         ("c", "C", "P", "12.50", 1, "SUCCESS", "PLACED", "UPI", "WEB", "Pune", dt.datetime(2024, 1, 1))],
        schemas.FAKE_ORDERS)
    got = {r.order_id: r.order_amount for r in to_orders_raw(gen).collect()}
    assert got == {"a": None, "b": None, "c": Decimal("12.50")}


def test_clamp_and_dead_letter(spark):
    rows = [raw_row("q0", "10", quantity=0, time="2024-01-30 12:00:00"),
            raw_row("q101", "10", quantity=101, time="2024-01-30 12:00:00"),
            raw_row("bad", "0", time="2024-01-30 12:00:00")]
    good, bad = quality.validate(raw_df(spark, rows), NOW)
    assert {r.order_id: r.quantity for r in good.collect()} == {"q0": 1, "q101": 100}
    err = bad.collect()
    assert len(err) == 1 and err[0].original_order_id == "bad" and err[0].error_type == "INVALID_AMOUNT"
    assert '"order_amount":"0.00"' in err[0].raw_payload and '"order_id":"bad"' in err[0].raw_payload


def test_unknown_placeholder(spark):
    raw = raw_df(spark, [raw_row("o", "10", customer="nobody", product="nothing")])
    e = enrich.enrich(raw, customers_df(spark, [("C1", "A", "GOLD")]),
                      products_df(spark, [("P1", "Phone", "electronics")]), on_miss="unknown").first()
    assert (e.customer_name, e.loyalty_tier, e.product_name, e.category) == ("UNKNOWN",) * 4


def test_failure_rate_rounding(spark):
    rows = []
    for method, failed in [("A", 1), ("B", 2), ("C", 3), ("D", 0)]:
        rows += [raw_row(f"{method}{i}", "1", status="FAILED" if i < failed else "SUCCESS", method=method)
                 for i in range(3)]
    got = {r.payment_method: r.failure_rate_pct for r in an.failure_rate_by(raw_df(spark, rows)).collect()}
    assert got == {"A": Decimal("33.33"), "B": Decimal("66.67"), "C": Decimal("100.00"), "D": Decimal("0.00")}


def test_top_k_ties_broken_by_keys(spark):
    rows = [raw_row("1", "10", product="P2"), raw_row("2", "10", product="P1"),
            raw_row("3", "30", product="P3")]
    e = enrich.enrich(raw_df(spark, rows), customers_df(spark, [("C1", "A", "GOLD")]),
                      products_df(spark, [("P1", "alpha", "x"), ("P2", "beta", "x"), ("P3", "gamma", "x")]))
    top = [r.product_name for r in an.top_products(e, 2).collect()]
    assert top == ["gamma", "alpha"]


def test_join_miss_and_rejection_rates(spark):
    raw = raw_df(spark, [raw_row("1", "10", customer="C1"), raw_row("2", "10", customer="X"),
                         raw_row("3", "0", customer="C1")])
    e = enrich.enrich(raw, customers_df(spark, [("C1", "A", "GOLD")]),
                      products_df(spark, [("P1", "p", "x")]))
    m = quality.join_miss_rate(e).first()
    assert (m.total_orders, m.customer_misses, m.product_misses) == (3, 1, 0)
    r = quality.rejection_rate(quality.tag_errors(raw, "2024-01-01 00:00:01")).first()
    assert (r.total_rows, r.rejected, r.invalid_amount) == (3, 1, 1)


def test_invariants_and_masking(spark):
    raw = raw_df(spark, [raw_row("1", "100", product="E"), raw_row("2", "10", product="G")])
    e = enrich.enrich(raw, customers_df(spark, [("C1", "Asha", "GOLD")]),
                      products_df(spark, [("E", "tv", "electronics"), ("G", "tea", "grocery")]))
    from tidemark.operators import alerts
    checks = {r.check_name: r.passed for r in
              quality.invariants(e, alerts.high_value(e), alerts.suspicious(e)).collect()}
    assert all(checks.values()) and len(checks) == 4
    m = quality.mask_pii(e).select("customer_id", "customer_name").first()
    assert m.customer_name == "A***" and len(m.customer_id) == 64
