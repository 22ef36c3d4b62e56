"""Distributed prefix sums against running sums in plain Python."""
import math
import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ordered import nearest_rank, running_total


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_running_total(spark, ranges):
    rng = random.Random(ranges)
    rows = [(i, rng.choice([None, 0, 1, 5, 10**12])) for i in rng.sample(range(10**6), 500)]
    df = spark.createDataFrame(rows, "at bigint, v bigint").repartition(7)
    got = {r.at: r.s for r in running_total(df, [F.col("at").asc()], "v", "s", ranges).collect()}
    rows.sort()
    assert got == dict(zip([a for a, _ in rows], accumulate(v or 0 for _, v in rows)))


def test_descending_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, 1), (3, 2), (1, 4), (2, 8)], "at int, v int")
    got = {r.at: r.s for r in running_total(df, [F.col("at").desc_nulls_last()], "v", "s", 4).collect()}
    assert got == {3: 2, 2: 10, 1: 14, None: 15}
    assert running_total(df.limit(0), [F.col("at").asc()], "v", "s").collect() == []


def test_no_task_sees_all(spark):
    df = spark.range(100000).withColumn("v", F.lit(1))
    out = running_total(df, [F.col("id").asc()], "v", "s", 8)
    plan = out._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan
    assert out.where("s <> id + 1").isEmpty()


@pytest.mark.parametrize("bins", [2, 16, 1024])
def test_nearest_rank(spark, bins):
    rng = random.Random(bins)
    groups = {"a": [rng.uniform(-5, 5) for _ in range(501)], "same": [7.25] * 90, "one": [-3.5], "skewed": [1.0] * 300 + [1e18, -1e300, 5e-324],
              "ties": [rng.choice([0.1, 0.2, 0.30000000000000004, 0.3]) for _ in range(200)], "wide": [-1.7e308, 1.7e308, 0.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("a", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    for share in (0.0, 0.5, 0.95, 1.0):
        want = {g: sorted(vs)[max(1, math.ceil(len(vs) * share)) - 1] for g, vs in groups.items()}
        assert nearest_rank(df, "g", "v", share, bins) == want
    assert nearest_rank(df.limit(0), "g", "v", 0.5) == {}
    with pytest.raises(ValueError):
        nearest_rank(spark.createDataFrame([("g", float("inf")), ("g", 1.0)], "g string, v double"), "g", "v", 0.5)
