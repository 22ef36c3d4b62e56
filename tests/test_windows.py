"""FIXTURES 5.2 / 5.3: tumbling windows, rounding, day keys, KPIs and the KPI upsert."""

from decimal import Decimal

from conftest import products_df, raw_df, raw_row, ts
from tidemark.operators import windows
from tidemark.sources.upsert import UpsertTable, latest_per_key

ROWS = [("00:00:00.000", "1.00", "SUCCESS"), ("00:04:59.999", "2.01", "FAILED"),
        ("00:05:00.000", "5.00", "SUCCESS")]


def _raw(spark, product="P1"):
    return raw_df(spark, [raw_row(f"O{i}", a, s, time=f"2024-01-01 {t}", product=product)
                          for i, (t, a, s) in enumerate(ROWS)])


def _products(spark):
    return products_df(spark, [("P1", "Phone", "electronics")])


def test_revenue_windows_half_up(spark):
    for small in (True, False):   # broadcast path and pre-aggregated shuffle path
        out = {r.window_start: r for r in
               windows.revenue_by_window(_raw(spark), _products(spark), small_products=small).collect()}
        first, second = out[ts("2024-01-01 00:00:00")], out[ts("2024-01-01 00:05:00")]
        assert (first.total_orders, first.total_revenue, first.failed_payments) == (2, Decimal("3.01"), 1)
        assert first.avg_order_value == Decimal("1.51")        # 1.505 rounds half up
        assert (second.total_orders, second.total_revenue, second.avg_order_value) == (1, Decimal("5.00"), Decimal("5.00"))
        assert first.window_end == ts("2024-01-01 00:05:00") and first.category == "electronics"


def test_missing_product_goes_to_null_category(spark):
    out = windows.revenue_by_window(_raw(spark, product="NOPE"), _products(spark)).collect()
    assert {r.category for r in out} == {None}


def test_window_day_is_window_start_day(spark):
    raw = raw_df(spark, [raw_row("O1", "1.00", time="2024-01-01 23:59:59.999")])
    r = windows.city_revenue_by_window(raw).collect()[0]
    assert r.window_day == "20240101" and r.window_end == ts("2024-01-02 00:00:00")


def test_revenue_schema_types(spark):
    out = windows.revenue_by_window(_raw(spark), _products(spark))
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert types["total_revenue"] == "decimal(20,2)" and types["avg_order_value"] == "decimal(20,2)"
    assert types["total_orders"] == "bigint" and types["failed_payments"] == "bigint"


def test_kpis_values(spark):
    rows = windows.kpis(_raw(spark)).collect()
    assert len(rows) == 15
    got = {(r.updated_at.strftime("%H:%M"), r.metric_key): r.metric_value for r in rows}
    assert got[("00:01", "total_orders_1min")] == 1.0
    assert got[("00:01", "total_revenue_1min")] == 1.0
    assert got[("00:05", "failed_payments_1min")] == 1.0
    assert got[("00:05", "avg_order_value_1min")] == 2.01
    assert got[("00:06", "avg_order_value_1min")] == 5.0
    assert got[("00:06", "events_per_second")] == 1 / 60


def test_kpi_latest_newest_window_wins(spark, scratch):
    kpis = windows.kpis(_raw(spark))
    latest = latest_per_key(kpis, ["metric_key"], ["updated_at"]).collect()
    assert len(latest) == 5 and {r.updated_at for r in latest} == {ts("2024-01-01 00:06:00")}
    table = UpsertTable.named(spark, scratch, "dashboard_kpis")
    table.upsert(kpis)
    # a later write of an older window must not regress the tiles
    table.upsert(kpis.where("updated_at = timestamp_ntz'2024-01-01 00:05:00'"))
    now = table.read_current().collect()
    assert {r.updated_at for r in now} == {ts("2024-01-01 00:06:00")}


def test_empty_minutes_produce_no_rows(spark):
    raw = raw_df(spark, [raw_row("O1", "1.00", time="2024-01-01 00:00:10"),
                         raw_row("O2", "1.00", time="2024-01-01 00:10:10")])
    assert windows.kpis(raw).count() == 10
