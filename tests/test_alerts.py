"""FIXTURES 5.1: high-value threshold and first-match fraud reasons."""

from conftest import raw_df, raw_row
from tidemark.operators import alerts, enrich
from conftest import customers_df, products_df

CASES = [
    # amount, status, method, device, high value, reason
    ("12999.00", "SUCCESS", "UPI", "IOS", True, None),
    ("12998.99", "SUCCESS", "UPI", "IOS", False, None),
    ("25000.00", "FAILED", "COD", "WEB", True, "Very high order amount exceeds 25K INR"),
    ("24999.00", "FAILED", "COD", "WEB", True, "Failed payment on high-value order"),
    ("24999.00", "PENDING", "COD", "IOS", True, "High-value COD order risk"),
    ("8999.00", "SUCCESS", "COD", "IOS", False, "High-value COD order risk"),
    ("8998.99", "SUCCESS", "COD", "IOS", False, None),
    ("5000.00", "FAILED", "UPI", "WEB", False, "Failed payment on high-value order"),
    ("4999.99", "FAILED", "UPI", "WEB", False, "Suspicious failed web payment"),
    ("2999.00", "FAILED", "COD", "WEB", False, "Suspicious failed web payment"),
    ("2998.99", "FAILED", "COD", "WEB", False, None),
    ("4999.99", "FAILED", "UPI", "IOS", False, None),
    ("4999.99", None, "UPI", "WEB", False, None),
]


def _enriched(spark):
    rows = [raw_row(f"O{i}", a, s, m, d) for i, (a, s, m, d, _, _) in enumerate(CASES)]
    return enrich.enrich(raw_df(spark, rows), customers_df(spark, [("C1", "Asha", "GOLD")]),
                         products_df(spark, [("P1", "Phone", "electronics")]))


def test_high_value(spark):
    got = {r.order_id for r in alerts.high_value(_enriched(spark)).collect()}
    want = {f"O{i}" for i, c in enumerate(CASES) if c[4]}
    assert got == want


def test_first_match_reason(spark):
    got = {r.order_id: r.reason for r in alerts.suspicious(_enriched(spark)).collect()}
    want = {f"O{i}": c[5] for i, c in enumerate(CASES) if c[5]}
    assert got == want


def test_all_reasons(spark):
    rows = {r.order_id: r.reasons for r in alerts.suspicious(_enriched(spark), all_reasons=True).collect()}
    # 25000 FAILED COD WEB matches all four rules, in rule order
    assert rows["O2"] == ["Very high order amount exceeds 25K INR", "Failed payment on high-value order",
                          "High-value COD order risk", "Suspicious failed web payment"]
    assert rows["O5"] == ["High-value COD order risk"]


def test_alert_columns(spark):
    e = _enriched(spark)
    assert alerts.high_value(e).columns == alerts.HIGH_VALUE_COLUMNS
    assert alerts.suspicious(e).columns == alerts.SUSPICIOUS_COLUMNS
