"""Retention, hot/cold tiering, union reads, compaction, purge, export.

Day partitions are directories (``<col>=yyyyMMdd``), so every lifecycle step is either a
partition-pruned read + write of whole days, or a directory operation on the shared file
system. The DataFrame-level functions (``retained``, ``union_read``, ...) carry the semantics
and are what readers use; the storage functions move or delete directories.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import rules
from tidemark.sources.log import DEFAULT_ROWS_PER_FILE, spread_by_day
from tidemark.sources.upsert import (UpsertTable, fs_add_version, fs_delete, fs_exists, fs_list,
                                     fs_read_version, fs_rename)


def _day(value) -> str:
    if isinstance(value, (_dt.date, _dt.datetime)):
        return value.strftime("%Y%m%d")
    return str(value).replace("-", "")[:8]


def cutoff_day(today, days: int = rules.RETENTION_DAYS) -> str:
    """First day kept: today minus ``days`` history days (today itself is not counted)."""
    d = _dt.datetime.strptime(_day(today), "%Y%m%d").date() - _dt.timedelta(days=days)
    return d.strftime("%Y%m%d")


# --- semantics on DataFrames ----------------------------------------------------------------

def retained(df: DataFrame, today, days: int = rules.RETENTION_DAYS,
             day_col: str = "event_day") -> DataFrame:
    """L1/L2: the rows a retention run keeps (a partition filter: pruned at the scan)."""
    return df.where(F.col(day_col) >= F.lit(cutoff_day(today, days)))


def union_read(hot: DataFrame, cold: DataFrame, boundary, day_col: str = "event_day") -> DataFrame:
    """One table over both tiers. Days before ``boundary`` come from cold, the rest from
    hot, so a day present in both during a copy is read once; rows without a day are hot. Both
    filters are partition filters; no de-duplication shuffle is needed."""
    b = F.lit(_day(boundary))
    return cold.where(F.col(day_col) < b).unionByName(
        hot.where((F.col(day_col) >= b) | F.col(day_col).isNull()))


def cold_read(cold: DataFrame, boundary, day_col: str = "event_day") -> DataFrame:
    """The cold tier only (days strictly before the boundary)."""
    return cold.where(F.col(day_col) < F.lit(_day(boundary)))


def purge(df: DataFrame, column: str, value) -> DataFrame:
    """Every row except those of one key (NULL-safe: rows with NULL are kept)."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))


def month_slice(df: DataFrame, month: str, time_col: str = "event_time") -> DataFrame:
    """Rows of one calendar month ``YYYY-MM``, as a half-open range of time, and of the day
    column where there is one: both reach the scan."""
    first = _dt.date.fromisoformat(f"{month}-01")
    after = (first + _dt.timedelta(days=31)).replace(day=1)
    kind = df.schema[time_col].dataType
    out = df.where((F.col(time_col) >= F.lit(f"{first} 00:00:00").cast(kind)) & (F.col(time_col) < F.lit(f"{after} 00:00:00").cast(kind)))
    for day in ("event_day", "window_day"):
        if day in df.columns:
            out = out.where((F.col(day) >= F.lit(_day(first))) & (F.col(day) < F.lit(_day(after))))
    return out


# --- storage operations ---------------------------------------------------------------------

def day_dirs(spark: SparkSession, path: str, day_col: str) -> list[str]:
    return sorted(n.split("=", 1)[1] for n in fs_list(spark, path) if n.startswith(f"{day_col}="))


def apply_retention(spark: SparkSession, path: str, today, days: int = rules.RETENTION_DAYS,
                    day_col: str = "event_day") -> list[str]:
    """L1: delete day directories older than the cutoff. Readers pass an explicit schema and
    ignoreMissingFiles, so a concurrent read is not broken. Returns the removed days."""
    first = cutoff_day(today, days)
    removed = [d for d in day_dirs(spark, path, day_col) if d < first]
    for d in removed:
        fs_delete(spark, f"{path}/{day_col}={d}")
    return removed


def apply_retention_upsert(table: UpsertTable, today, days: int = rules.RETENTION_DAYS) -> None:
    """L1 on an upsert table: drop old day directories in the snapshot and every changelog batch."""
    spark, col = table.spark, table.partition
    roots = [f"{table.root}/snapshot/{v}" for v in fs_list(spark, f"{table.root}/snapshot")]
    for e in fs_list(spark, f"{table.root}/changelog"):
        roots += [f"{table.root}/changelog/{e}/{b}" for b in fs_list(spark, f"{table.root}/changelog/{e}")]
    for r in roots:
        apply_retention(spark, r, today, days, col)


# L2: per-table retention in days: the DDL's 7 days for every partitioned table, alerts longer
RETENTION_POLICY = {"orders_raw": rules.RETENTION_DAYS, "orders_enriched": rules.RETENTION_DAYS,
                    "revenue_5min": rules.RETENTION_DAYS, "city_revenue_5min": rules.RETENTION_DAYS,
                    "high_value_orders": 30, "suspicious_orders": 90}


def apply_policy(spark: SparkSession, root: str, today, policy: dict | None = None) -> dict:
    """L1/L2 over a deployment root: the log and the partitioned upsert tables."""
    from tidemark import schemas
    done = {}
    for name, days in (policy or RETENTION_POLICY).items():
        if name == "orders_raw":
            done[name] = apply_retention(spark, f"{root.rstrip('/')}/{name}", today, days)
        elif name in schemas.PARTITION:
            apply_retention_upsert(UpsertTable.named(spark, root, name), today, days)
            done[name] = schemas.PARTITION[name]
        else:   # no day directories: rows go by their event time
            t = UpsertTable.named(spark, root, name)
            first = _dt.datetime.strptime(cutoff_day(today, days), "%Y%m%d")
            t.replace(F.col("event_time") < F.lit(first.isoformat(sep=" ")).cast(t.schema["event_time"].dataType))
            t.expire(keep_versions=1)
            done[name] = "event_time"
    return done


def tier_state(spark: SparkSession, cold_root: str) -> dict:
    """{"boundary": day, "copied": {day: hot files in cold}, "pending": {day: cold files before}}.
    Its size follows the hot files below the boundary, which ``hot_ttl`` keeps few."""
    text = fs_read_version(spark, cold_root, "_tier")
    return {"boundary": "00000000", "copied": {}, "pending": {}, **(json.loads(text) if text else {})}


def _data_files(spark: SparkSession, folder: str) -> list[str]:
    return sorted(f for f in fs_list(spark, folder) if not f.startswith(("_", ".")))


def _committed(spark: SparkSession, path: str) -> set[str] | None:
    """The files that a streaming file sink has committed to a folder; None where no sink writes
    (then all files count). Others may be left over from tasks or batches that failed."""
    if not fs_exists(spark, f"{path}/_spark_metadata"):
        return None
    names = spark.read.schema("event_time timestamp").parquet(path).inputFiles()
    return {n.rsplit("/", 1)[1] for n in names}


def _late_files(spark: SparkSession, hot_path: str, state: dict, below: str, day_col: str) -> dict:
    """Hot files of days below a boundary that are not in cold yet, by day."""
    out, committed = {}, _committed(spark, hot_path)
    for d in day_dirs(spark, hot_path, day_col):
        if d < below:
            copied = set(state["copied"].get(d, []))
            new = [f for f in _data_files(spark, f"{hot_path}/{day_col}={d}") if f not in copied and (committed is None or f in committed)]
            if new:
                out[d] = new
    return out


def _read_files(spark: SparkSession, path: str, schema: T.StructType, files: dict, day_col: str) -> DataFrame:
    paths = [f"{path}/{day_col}={d}/{f}" for d, names in files.items() for f in names]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def tier(spark: SparkSession, hot_path: str, cold_path: str, schema: T.StructType, until,
         day_col: str = "event_day", rows_per_file: int = DEFAULT_ROWS_PER_FILE,
         keep=lambda rows: rows) -> str:
    """Copy closed days (< ``until``) from hot to cold, compacted to about
    ``rows_per_file`` rows per file. The state names the hot files that were copied, so that
    rows which arrive for a day after its copy are copied by the next run (and read from hot
    until then). Re-running after a crash is safe: the cold files of the days to be written are
    noted first, and whatever else lies there is removed before the copy is made again.
    ``keep`` takes the rows to copy and returns those that shall be (``purge.without``)."""
    state = tier_state(spark, cold_path)
    for day, before in state["pending"].items():   # an earlier run did not finish
        for name in _data_files(spark, f"{cold_path}/{day_col}={day}"):
            if name not in before:
                fs_delete(spark, f"{cold_path}/{day_col}={day}/{name}")
    end = max(state["boundary"], _day(until))
    todo = _late_files(spark, hot_path, state, end, day_col)
    if todo:
        state["pending"] = {d: _data_files(spark, f"{cold_path}/{day_col}={d}") for d in todo}
        fs_add_version(spark, cold_path, "_tier", json.dumps(state))
        rows = keep(_read_files(spark, hot_path, schema, todo, day_col))
        spread_by_day(rows, day_col, rows_per_file).write.mode("append").partitionBy(day_col).parquet(cold_path)
        for d, names in todo.items():
            state["copied"][d] = sorted({*state["copied"].get(d, []), *names})
    state.update(boundary=end, pending={})
    fs_add_version(spark, cold_path, "_tier", json.dumps(state))
    return end


def read_union(spark: SparkSession, hot_path: str, cold_path: str, schema: T.StructType,
               day_col: str = "event_day") -> DataFrame:
    """U2 over storage: cold below the recorded boundary, hot from it on, and the hot files of
    days below it that are not in cold yet."""
    state = tier_state(spark, cold_path)
    if state["boundary"] == "00000000":
        return spark.read.schema(schema).parquet(hot_path)
    hot, cold = (spark.read.schema(schema).parquet(p) if day_dirs(spark, p, day_col) else spark.createDataFrame([], schema)
                 for p in (hot_path, cold_path))
    late = _late_files(spark, hot_path, state, state["boundary"], day_col)
    out = union_read(hot, cold, state["boundary"], day_col)
    return out.unionByName(_read_files(spark, hot_path, schema, late, day_col)) if late else out


def hot_ttl(spark: SparkSession, hot_path: str, cold_path: str, keep_days: int = 2,
            day_col: str = "event_day") -> list[str]:
    """L4: drop hot days older than ``keep_days`` before the boundary whose files are all in
    cold. A day with a file that arrived after its copy stays until the next ``tier``."""
    state = tier_state(spark, cold_path)
    boundary = state["boundary"]
    if boundary == "00000000" or state["pending"]:
        return []
    first_kept = cutoff_day(boundary, keep_days)
    late = _late_files(spark, hot_path, state, boundary, day_col)
    removed = [d for d in day_dirs(spark, hot_path, day_col) if d < first_kept and d < boundary and d not in late]
    for d in removed:
        for name in state["copied"].pop(d, []):   # only what was copied: a file may arrive just now
            fs_delete(spark, f"{hot_path}/{day_col}={d}/{name}")
        if not _data_files(spark, f"{hot_path}/{day_col}={d}"):
            fs_delete(spark, f"{hot_path}/{day_col}={d}")
    fs_add_version(spark, cold_path, "_tier", json.dumps(state))
    return removed


def _refuse_stream_sink(spark: SparkSession, path: str) -> None:
    if fs_exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is written by a streaming file sink, whose metadata names its files; "
                         "copy it with append_log and rewrite the copy")


def _swap_day(spark: SparkSession, path: str, staged: str, day: str, day_col: str) -> None:
    """Put a day's staged folder (or nothing, if it has none) in the place of the old one. What a
    crash between the two renames leaves is put right by ``recover``."""
    old, new, aside = f"{path}/{day_col}={day}", f"{staged}/{day_col}={day}", f"{staged}/.old-{day}"
    fs_rename(spark, old, aside)
    if fs_exists(spark, new):
        fs_rename(spark, new, old)
    fs_delete(spark, aside)


def recover(spark: SparkSession, path: str, day_col: str = "event_day") -> list[str]:
    """Finish or take back day rewrites that a crash cut short: a day that was set aside and not
    replaced gets its old folder again. Every rewriting job calls it first."""
    restored = []
    for name in fs_list(spark, path):
        if name.startswith(".rewrite-"):
            for aside in fs_list(spark, f"{path}/{name}"):
                day = aside.removeprefix(".old-")
                if aside.startswith(".old-") and not fs_exists(spark, f"{path}/{day_col}={day}"):
                    fs_rename(spark, f"{path}/{name}/{aside}", f"{path}/{day_col}={day}")
                    restored.append(day)
            fs_delete(spark, f"{path}/{name}")
    return sorted(restored)


def compact_days(spark: SparkSession, path: str, schema: T.StructType, days: list[str],
                 day_col: str = "event_day", rows_per_file: int = DEFAULT_ROWS_PER_FILE,
                 min_files: int = 5) -> list[str]:
    """Rewrite days that have at least ``min_files`` files into files of about
    ``rows_per_file`` rows (a hot day is split over several tasks).

    Only for tables that no stream writes or follows (the cold tier, snapshots): each day's new
    files are written next to it and then take its place. The cold tier's copied files are
    those of the hot side, so compaction does not touch its state."""
    _refuse_stream_sink(spark, path)
    recover(spark, path, day_col)
    todo = [d for d in days
            if len([f for f in fs_list(spark, f"{path}/{day_col}={d}") if f.endswith(".parquet")])
            >= min_files]
    if not todo:
        return []
    staged = f"{path}/.rewrite-{uuid.uuid4().hex[:12]}"
    df = spark.read.schema(schema).parquet(path).where(F.col(day_col).isin(todo))
    spread_by_day(df, day_col, rows_per_file).write.partitionBy(day_col).parquet(staged)
    for d in todo:
        _swap_day(spark, path, staged, d, day_col)
    fs_delete(spark, staged)
    return todo


def rewrite_days(spark: SparkSession, path: str, schema: T.StructType, days: list[str], keep,
                 day_col: str = "event_day") -> None:
    """Rewrite whole days with those of their rows that ``keep`` (frame -> frame) returns: written
    next to them first, then put in their place; a day without rows is removed."""
    _refuse_stream_sink(spark, path)
    recover(spark, path, day_col)
    if not days:
        return
    staged = f"{path}/.rewrite-{uuid.uuid4().hex[:12]}"
    rows = keep(spark.read.schema(schema).parquet(path).where(F.col(day_col).isin(days)))
    spread_by_day(rows, day_col).write.partitionBy(day_col).parquet(staged)
    for d in days:
        _swap_day(spark, path, staged, d, day_col)
    fs_delete(spark, staged)
    spark.catalog.refreshByPath(path)


def purge_files(spark: SparkSession, path: str, schema: T.StructType, column: str, value,
                day_col: str = "event_day") -> list[str]:
    """Rewrite only the day partitions that contain the key, found by a distributed aggregate
    (one row per day). Returns the days, after a check that the key is gone. For a log that a
    stream writes see ``sources.purge``."""
    _refuse_stream_sink(spark, path)
    recover(spark, path, day_col)

    def holding() -> list[str]:
        df = spark.read.schema(schema).parquet(path)
        return sorted(r[0] for r in df.where(F.col(column) == F.lit(value)).select(day_col).distinct().collect())

    days = holding()
    rewrite_days(spark, path, schema, days, lambda df: purge(df, column, value), day_col)
    if left := [d for d in holding() if d in days]:
        raise RuntimeError(f"rows of the purged key are left in {left}")
    return days


def purge_cold(spark: SparkSession, path: str, schema: T.StructType, list_path: str,
               column: str = "customer_id", day_col: str = "event_day") -> list[str]:
    """L8 for all keys of a purge list: the cold days that hold rows of them are rewritten."""
    from tidemark.sources import purge as lists
    rows = spark.read.schema(schema).parquet(path)
    days = sorted(r[0] for r in lists.remaining(rows, list_path, column, day_col).collect())
    rewrite_days(spark, path, schema, days, lambda df: lists.without(df, list_path, column), day_col)
    return days


def purge_table(table: UpsertTable, column: str, value) -> int:
    """L8 on a keyed table: a new snapshot without the key's rows, and the older files removed."""
    version = table.replace(F.col(column) == F.lit(value))
    table.expire(keep_versions=1)
    return version


def export(df: DataFrame, month: str, path: str, time_col: str = "event_time") -> None:
    """Write one month of a table (aggregates, alert archive) to ``path``."""
    month_slice(df, month, time_col).write.mode("overwrite").parquet(path)
