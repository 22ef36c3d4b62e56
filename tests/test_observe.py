"""FIXTURES 5.10 and the observability rules, checked against brute force."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import raw_df, raw_row, ts
from tidemark.operators import observe

REV = T.StructType([T.StructField("window_start", T.TimestampType()),
                    T.StructField("window_end", T.TimestampType()),
                    T.StructField("category", T.StringType()),
                    T.StructField("total_orders", T.LongType()),
                    T.StructField("failed_payments", T.LongType())])


def _rev(spark, rates, skip=()):
    rows = []
    start = ts("2024-01-01 00:00:00")
    for i, r in enumerate(rates):
        if i in skip:
            continue
        s = start + dt.timedelta(minutes=5 * i)
        rows.append((s, s + dt.timedelta(minutes=5), "x", 100, int(round(r * 100))))
    return spark.createDataFrame(rows, REV)


def test_sustained_failed_rate(spark):
    fired = [r.window_start for r in observe.alert_failed_rate(_rev(spark, [.30, .20, .30, .30, .30])).collect()]
    assert sorted(fired) == [ts("2024-01-01 00:15:00"), ts("2024-01-01 00:20:00")]
    assert observe.alert_failed_rate(_rev(spark, [.25, .25, .25])).count() == 0
    # a missing window breaks the run
    assert observe.alert_failed_rate(_rev(spark, [.30, .30, .30], skip={1})).count() == 0


def test_spike_against_brute_force(spark):
    rnd = random.Random(7)
    base = ts("2024-01-01 00:00:00")
    times = [base + dt.timedelta(seconds=rnd.randrange(0, 6 * 3600)) for _ in range(400)]
    times += [base + dt.timedelta(hours=3, seconds=s) for s in range(0, 280, 7)]   # a burst
    df = spark.createDataFrame([(t,) for t in times], "event_time timestamp")
    got = {r.window_start: r.alerts for r in observe.alert_spike(df).collect()}
    counts = {}
    for t in times:
        s = t - dt.timedelta(minutes=t.minute % 5, seconds=t.second, microseconds=t.microsecond)
        counts[s] = counts.get(s, 0) + 1
    want = {}
    for s, c in counts.items():
        hist = sum(counts.get(s - dt.timedelta(minutes=5 * i), 0) for i in range(1, 13)) / 12
        if hist > 0 and c > 3 * hist:
            want[s] = c
    assert got == want and ts("2024-01-01 03:00:00") in got


def test_slo_percentile_against_brute_force(spark):
    rnd = random.Random(3)
    vals = [round(rnd.uniform(0, 9), 3) for _ in range(997)]
    df = spark.createDataFrame([("m", v) for v in vals], "metric string, value double")
    r = observe.slo_report(df, {"m": 5.0}).first()
    s = sorted(vals)
    assert r.p_value == s[math.ceil(0.95 * len(s)) - 1]
    assert r.samples == 997 and r.within == sum(v < 5.0 for v in vals)
    assert r.met == (r.p_value < 5.0)


def test_burn_rate_windows(spark):
    base = ts("2024-01-01 00:00:00")
    rows = [("lat", base + dt.timedelta(minutes=i), 10.0 if i % 10 == 0 else 1.0) for i in range(360)]
    df = spark.createDataFrame(rows, "metric string, ts timestamp, value double")
    out = observe.burn_rate(df, "lat", 5.0, 0.02, 0.005).collect()
    fast = [r for r in out if r.burn_window == "fast_1h"]
    slow = [r for r in out if r.burn_window == "slow_6h"]
    assert len(fast) == 6 and len(slow) == 1
    assert all(r.bad == 6 and r.alert for r in fast) and slow[0].bad == 36


def test_lag_freshness_and_classify(spark):
    raw = raw_df(spark, [raw_row("1", "1", time="2024-01-01 00:00:00"),
                         raw_row("2", "1", time="2024-01-01 00:00:30.900")])
    lag = observe.lag_seconds({"orders_raw": raw}, "2024-01-01 00:01:00").first()
    assert lag.lag_seconds == 29
    m = spark.createDataFrame([("utilisation", 0.75), ("utilisation", 0.95), ("lag_seconds", 31.0),
                               ("lag_seconds", 121.0), ("lag_seconds", 5.0)], "metric string, value double")
    assert [r.level for r in observe.classify(m).collect()] == ["WARNING", "CRITICAL", "WARNING", "CRITICAL", "OK"]


def test_late_rows_audit(spark):
    raw = raw_df(spark, [raw_row("1", "1", time="2024-01-01 00:01:00"),
                         raw_row("2", "1", time="2024-01-01 00:02:00")])
    pub = spark.createDataFrame([(ts("2024-01-01 00:00:00"), "Mumbai", 1)],
                                "window_start timestamp, city string, total_orders long")
    r = observe.late_rows(raw, pub, key="city").collect()
    assert len(r) == 1 and r[0].late == 1
