"""Late rows as a side output: published and late ones are all that was logged, exactly."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import products_df, raw_df, raw_row
from tidemark.sources.log import read_log
from tidemark.sources.upsert import fs_delete
from tidemark.streaming import jobs, lateness

BASE = dt.datetime(2024, 1, 1)


def feed(spark, layout, steps, start):
    """Each step's orders (minutes) as one file, then the query until it has read it."""
    n = 0
    for step in steps:
        rows = [raw_row(f"O{n + i}", "1.00", time=str(BASE + dt.timedelta(minutes=m)), city=["Delhi", "Mumbai"][i % 2]) for i, m in enumerate(step)]
        n += len(rows)
        raw_df(spark, rows).coalesce(1).write.mode("append").partitionBy("event_day").parquet(layout.raw_path)
        if start:
            start().awaitTermination()
    return n


def balance(spark, layout, job, key):
    """{window: (published, late, logged)} of all closed windows."""
    logged = read_log(spark, layout.raw_path)
    newest = logged.agg(F.max("event_time")).first()[0]
    count = lambda df, at: {r[0]: r[1] for r in df.groupBy(at).agg(F.sum("n")).collect()}
    start = F.window("event_time", "5 minutes").start
    pub = count(layout.table(job).read_current().select("window_start", F.col("total_orders").alias("n")), "window_start")
    late = count(lateness.late_orders(spark, layout.root, job).select(start.alias("window_start"), F.lit(1).alias("n")), "window_start")
    every = count(logged.select(start.alias("window_start"), F.lit(1).alias("n")), "window_start")
    closed = {w for w in every if w + dt.timedelta(minutes=5) <= newest - dt.timedelta(seconds=5)}
    assert set(pub) <= closed and set(late) <= closed
    return {w: (pub.get(w, 0), late.get(w, 0), every[w]) for w in closed}


STEPS = [[1, 2, 3], [7, 4.5], [12, 2.5, 6], [30, 1, 13], [31, 14, 8], [70, 29, 2], [71, 33], [120, 3, 65]]


@pytest.mark.parametrize("job", ["city_revenue_5min", "revenue_5min"])
def test_restarted_at_every_file(spark, scratch, job):
    layout = jobs.Layout(spark, scratch)
    layout.table("product_catalog").upsert(products_df(spark, [("P1", "Phone", "toys")]))
    start = jobs.start_city_revenue if job == "city_revenue_5min" else jobs.start_revenue
    n = feed(spark, layout, STEPS, lambda: start(layout, trigger={"availableNow": True}, side_output=True))
    found = balance(spark, layout, job, "city")
    assert all(p + late == logged for p, late, logged in found.values()) and sum(late for _, late, _ in found.values()) >= 4
    counts = lateness.late_counts(spark, layout.root, job).orderBy("batch_id").collect()
    assert [c.total_rows for c in counts] == [sum(x.input_rows for x in counts[: i + 1]) for i in range(len(counts))]
    assert counts[-1].total_rows == n and counts[-1].total_late == sum(late for _, late, _ in found.values())
    rate = lateness.late_rate(spark, layout.root, job).first()
    assert (rate.late_rows, rate.total_rows) == (counts[-1].total_late, n) and rate.late_rate == rate.late_rows / n


def test_one_run_of_many_batches_and_a_batch_that_runs_again(spark, scratch):
    rng = random.Random(4)
    layout = jobs.Layout(spark, scratch)
    steps, now = [], 0.0
    for _ in range(14):
        now += rng.choice([0.5, 2, 6, 20])
        steps.append([now] + [max(0.0, now - rng.choice([0, 1, 4, 6, 12, 40])) for _ in range(5)])
    feed(spark, layout, steps[:10], None)
    q = jobs.start_city_revenue(layout, trigger={"availableNow": True}, max_files_per_trigger=1, side_output=True)
    q.awaitTermination()
    last = max(p["batchId"] for p in q.recentProgress)
    fs_delete(spark, f"{layout.checkpoint('city_revenue_5min')}/commits/{last}")      # as if the driver was lost in it
    fs_delete(spark, f"{layout.checkpoint('city_revenue_5min')}/commits/.{last}.crc")
    feed(spark, layout, steps[10:], None)
    jobs.start_city_revenue(layout, trigger={"availableNow": True}, max_files_per_trigger=1, side_output=True).awaitTermination()
    found = balance(spark, layout, "city_revenue_5min", "city")
    assert all(p + late == logged for p, late, logged in found.values()), found
    assert sum(late for _, late, _ in found.values()) > 3
