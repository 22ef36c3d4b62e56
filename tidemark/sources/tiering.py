"""L3, L4, U2, U3 for keyed tables: closed days in a cold tier, newest version across tiers.

A tier run appends to the cold root what it lacks: the current rows of newly closed days, and
those versions of rows of older days that were written since the last run (late orders, and new
versions of tiered ones). Each run writes below its own number, ``<day>/_run=N``:

* cold read: days that one run wrote are read as they are; in the others the row of the highest
  run counts for each key. Nothing is rewritten or deleted, so a run that crashes leaves only
  versions that the next run, with a new number, writes again.
* union read: days from the boundary on come from hot alone. Hot rows of older days are newer
  than, or equal to, their cold versions; a cold row is left out where hot has its key. Only
  cold days for which hot has rows take part in that join.

The state (boundary, position in the changelog, run) is a numbered file, written when a run's
rows are in place; the run's number is taken before.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.lifecycle import _day, apply_retention, cutoff_day, day_dirs
from tidemark.sources.upsert import UpsertTable, fs_add_version, fs_list, fs_read_version, latest_per_key

RUN = "_run"
FIRST = "00000000"


def tier_state(spark: SparkSession, cold: str) -> dict:
    text = fs_read_version(spark, cold, "_tier")
    return json.loads(text) if text else {"boundary": FIRST, "upto": [-1, -1], "run": 0}


def _checked(table: UpsertTable) -> str:
    if not table.partition or table.order_by:
        raise ValueError("only tables with day partitions whose last write counts are tiered")
    return table.partition


def tier_table(table: UpsertTable, cold: str, until) -> str:
    """L3: copy what cold lacks of the days before ``until``; returns the new boundary."""
    spark, day = table.spark, _checked(table)
    state = tier_state(spark, cold)
    end, since = max(state["boundary"], _day(until)), tuple(state["upto"])
    ptr = table.pointer()
    upto = tuple(ptr["folded"])
    for batch, done in table._batches(upto):   # up to the first batch that is still being written
        if not done:
            break
        upto = batch
    state["run"] += 1
    fs_add_version(spark, cold, "_tier", json.dumps(state))

    current = table._merge(ptr, upto)
    rows = current.where((F.col(day) >= state["boundary"]) & (F.col(day) < end))
    older = F.col(day) < state["boundary"]
    if since >= tuple(ptr["folded"]):   # the batches since are still apart: their newest versions are current
        tail = table._tail(since, upto, []).where(older).withColumn("_tie", F.xxhash64(*table.schema.fieldNames()))
        late = latest_per_key(tail, table.keys, ["epoch", "batch_id", *table.within_batch, "_tie"])
    else:                               # folded into the snapshot: all that hot still has
        late = current.where(older)
    columns = table.schema.fieldNames()
    (rows.select(*columns).unionByName(late.select(*columns)).withColumn(RUN, F.lit(state["run"]))
     .write.mode("append").partitionBy(day, RUN).parquet(cold))
    state.update(boundary=end, upto=list(upto))
    fs_add_version(spark, cold, "_tier", json.dumps(state))
    return end


def read_cold(table: UpsertTable, cold: str) -> DataFrame:
    """The cold tier only, one row for each key (days before the boundary)."""
    spark, day = table.spark, _checked(table)
    boundary = tier_state(spark, cold)["boundary"]
    days = [d for d in day_dirs(spark, cold, day) if d < boundary]
    if not days:
        return spark.createDataFrame([], table.schema)
    fields = [f for f in table.schema.fields if f.name != day]
    schema = T.StructType([*fields, table.schema[day], T.StructField(RUN, T.IntegerType())])
    rows = spark.read.schema(schema).parquet(cold).where(F.col(day) < boundary)
    several = [d for d in days if len([n for n in fs_list(spark, f"{cold}/{day}={d}") if n.startswith(f"{RUN}=")]) > 1]
    columns = table.schema.fieldNames()
    if not several:
        return rows.select(*columns)
    folded = latest_per_key(rows.where(F.col(day).isin(several)), table.keys, [RUN])
    return rows.where(~F.col(day).isin(several)).select(*columns).unionByName(folded.select(*columns))


def read_union(table: UpsertTable, cold: str) -> DataFrame:
    """Both tiers as one table, the newest version of each key."""
    from tidemark.operators.enrich import bounded_broadcast
    spark, day = table.spark, _checked(table)
    boundary = tier_state(spark, cold)["boundary"]
    hot = table.read_current()
    if boundary == FIRST:
        return hot
    older = hot.where(F.col(day) < boundary)
    days = [r[0] for r in older.select(day).distinct().collect()]   # days, not rows
    rows = read_cold(table, cold)
    if not days:
        return rows.unionByName(hot)
    keys = bounded_broadcast(older.select(*[F.col(k).alias(f"_k_{k}") for k in table.keys]).distinct())
    here = rows.where(F.col(day).isin(days))
    same = [here[k].eqNullSafe(keys[f"_k_{k}"]) for k in table.keys]
    return rows.where(~F.col(day).isin(days)).unionByName(here.join(keys, same, "left_anti")).unionByName(hot)


def hot_ttl(table: UpsertTable, cold: str, keep_days: int = 2) -> list[str]:
    """L4: remove hot days older than ``keep_days`` before the boundary, of the batches that were
    tiered; rows that came since stay until the next run. Run it while no reader is open."""
    spark, day = table.spark, _checked(table)
    state, ptr = tier_state(spark, cold), table.pointer()
    if state["boundary"] == FIRST:
        return []
    upto = tuple(state["upto"])
    roots = [f"{table.root}/changelog/epoch={e}/batch_id={b}" for (e, b), done in table._batches() if done and (e, b) <= upto]
    if ptr["version"] >= 0 and tuple(ptr["folded"]) <= upto:
        roots.append(f"{table.root}/snapshot/v={ptr['version']}")
    last = cutoff_day(state["boundary"], keep_days)
    removed = set()
    for root in roots:
        removed.update(d for d in day_dirs(spark, root, day) if d < last)
        apply_retention(spark, root, last, 0, day)
    return sorted(removed)
