"""Primary-key tables on plain Parquet (merge-on-read).

Layout under ``root``::

    snapshot/v=K/...                      folded base (one row per key)
    changelog/epoch=E/batch_id=N/...      one directory per written batch
    _pointer.N.json                       {"version": K, "folded": [E, N]}  (highest N counts)

* write: the batch's rows go to its directory; a batch that is already committed (``_SUCCESS``)
  is not written again, so a replay changes nothing and readers never lose it.
* read: snapshot rows ∪ rows of committed changelog batches after the pointer, then per key the
  row with the greatest (order_by..., epoch, batch_id, time within the batch, row hash):
  ``groupBy(keys).agg(max_by(struct, seq))``. The time within a batch is ``updated_at`` or else
  ``event_time``, where the table has one, so the newest of several versions in one batch wins;
  the hash breaks the ties that are left. This is
  one aggregate with partial aggregation, so a hot key is reduced map-side before the shuffle.
  Group-by treats NULL keys as equal (one row for a NULL key).
* compact: fold the view into ``snapshot/v=K+1``, then move the pointer. Only the contiguous
  run of committed batches (``_SUCCESS``) is folded, so a batch being written concurrently is
  never cut in half. Old directories are only deleted by ``expire``, which a caller runs when
  no reader of them is open, or with an age.
* replace: rows that meet a condition are exchanged for others, as a new snapshot version.

Epochs: a new one is taken for each seed/batch load and for every start of a streaming query
(so a restarted stream's writes order after a rebuild done while it was stopped). One writer
per table at a time.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas

SEQ = "_seq"
WRITTEN_AT = "_written_at"


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def fs_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, path)
    return fs.exists(p)


def fs_write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file by way of a temp file. An old file of this name is replaced, which is
    not atomic; what must survive a crash goes into a new file (``fs_add_version``)."""
    jvm = spark.sparkContext._jvm
    fs, p = _hadoop_fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    fs.rename(tmp, p)


def _versions(spark: SparkSession, folder: str, stem: str) -> list[int]:
    found = [n[len(stem) + 1:-5] for n in fs_list(spark, folder)
             if n.startswith(f"{stem}.") and n.endswith(".json")]
    return sorted(int(n) for n in found if n.isdigit())


def fs_add_version(spark: SparkSession, folder: str, stem: str, text: str) -> None:
    """Write ``folder/stem.N.json`` with the next N. Older versions stay until the new one is in
    place (the two before it are kept), so a crash at any point leaves the last whole one."""
    known = _versions(spark, folder, stem)
    fs_write_text(spark, f"{folder}/{stem}.{(known[-1] if known else -1) + 1}.json", text)
    for n in known[:-2]:
        fs_delete(spark, f"{folder}/{stem}.{n}.json")


def fs_read_version(spark: SparkSession, folder: str, stem: str) -> str | None:
    known = _versions(spark, folder, stem)
    return fs_read_text(spark, f"{folder}/{stem}.{known[-1]}.json") if known else None


def fs_read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _hadoop_fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    lines = []
    line = reader.readLine()
    while line is not None:
        lines.append(line)
        line = reader.readLine()
    reader.close()
    return "\n".join(lines)


def fs_list(spark: SparkSession, path: str) -> list[str]:
    fs, p = _hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def fs_mtime_ms(spark: SparkSession, path: str) -> int:
    fs, p = _hadoop_fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())


def fs_rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _hadoop_fs(spark, old)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"cannot rename {old} to {new}")


def fs_delete(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple (NULL keys grouped together).

    Rows whose ordering struct is NULL are never chosen by max_by; the struct itself is never
    NULL here because it is built from columns, even when its fields are NULL.
    """
    value_cols = [c for c in df.columns if c not in keys]
    seq = F.struct(*[F.col(c) for c in order])
    row = F.struct(*[F.col(c) for c in value_cols])
    folded = df.groupBy(*keys).agg(F.max_by(row, seq).alias("_row"))
    return folded.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in value_cols])


@dataclass
class UpsertTable:
    spark: SparkSession
    root: str
    keys: list[str]
    schema: T.StructType
    order_by: list[str] = field(default_factory=list)   # e.g. ["updated_at"] for KPIs
    partition: str | None = None

    @classmethod
    def named(cls, spark: SparkSession, root: str, name: str) -> "UpsertTable":
        order = ["updated_at"] if name == "dashboard_kpis" else []
        return cls(spark, f"{root.rstrip('/')}/{name}", schemas.KEYS[name], schemas.SCHEMAS[name],
                   order, schemas.PARTITION.get(name))

    # -- metadata ------------------------------------------------------------------------
    @property
    def within_batch(self) -> list[str]:
        """What tells the newest of several versions of a key in one batch."""
        names = self.schema.fieldNames()
        return [c for c in ("updated_at", "event_time") if c in names and c not in self.order_by][:1]

    def pointer(self) -> dict:
        text = fs_read_version(self.spark, self.root, "_pointer")
        return json.loads(text) if text else {"version": -1, "folded": [-1, -1], "epochs": -1}

    def _save_pointer(self, ptr: dict) -> None:
        fs_add_version(self.spark, self.root, "_pointer", json.dumps(ptr))

    def new_epoch(self) -> int:
        """Reserve the next epoch number (recorded in the pointer)."""
        ptr = self.pointer()
        known = [int(n.split("=")[1]) for n in fs_list(self.spark, f"{self.root}/changelog")
                 if n.startswith("epoch=")]
        epoch = max([ptr.get("epochs", -1), ptr["folded"][0], *known]) + 1
        ptr["epochs"] = epoch
        self._save_pointer(ptr)
        return epoch

    # -- write ---------------------------------------------------------------------------
    def write_batch(self, df: DataFrame, epoch: int, batch_id: int) -> None:
        """Idempotent: a batch that is committed is left as it is; leftovers of one that is not
        are replaced as a whole.

        A narrow job (projection + write): rows are not folded here. Several rows for one key
        inside a batch are resolved when read (see ``within_batch``).
        """
        path = f"{self.root}/changelog/epoch={epoch}/batch_id={batch_id}"
        if fs_exists(self.spark, f"{path}/_SUCCESS"):
            return
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        # write time of each changelog row (for window completion delay, O3)
        w = rows.withColumn(WRITTEN_AT, F.current_timestamp()).write.mode("overwrite")
        if self.partition:
            w = w.partitionBy(self.partition)
        w.parquet(path)

    def upsert(self, df: DataFrame) -> int:
        """Batch upsert (seed, backfill): a fresh epoch with a single batch."""
        epoch = self.new_epoch()
        self.write_batch(df, epoch, 0)
        return epoch

    # -- read ----------------------------------------------------------------------------
    def _changelog(self) -> DataFrame:
        fields = list(self.schema.fields) + [T.StructField(WRITTEN_AT, T.TimestampType()),
                                             T.StructField("epoch", T.LongType()),
                                             T.StructField("batch_id", T.LongType())]
        path = f"{self.root}/changelog"
        if not fs_exists(self.spark, path):
            return self.spark.createDataFrame([], T.StructType(fields))
        return (self.spark.read.schema(T.StructType(fields))
                .option("basePath", path).parquet(path))

    def _snapshot(self, version: int) -> DataFrame | None:
        if version < 0:
            return None
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/snapshot/v={version}")

    def changes(self) -> DataFrame:
        """All changelog rows with epoch, batch_id and write time (audit, O3)."""
        return self._changelog()

    def _batches(self, after: tuple = (-1, -1)) -> list[tuple[tuple[int, int], bool]]:
        """((epoch, batch_id), committed) of every changelog directory behind ``after`` (file
        listing, no job). Committed: the write job left its ``_SUCCESS`` marker."""
        out = []
        for e in fs_list(self.spark, f"{self.root}/changelog"):
            if e.startswith("epoch=") and int(e.split("=")[1]) >= after[0]:
                for b in fs_list(self.spark, f"{self.root}/changelog/{e}"):
                    if b.startswith("batch_id="):
                        eb = (int(e.split("=")[1]), int(b.split("=")[1]))
                        if eb > after:
                            out.append((eb, fs_exists(self.spark, f"{self.root}/changelog/{e}/{b}/_SUCCESS")))
        return sorted(out)

    def _tail(self, after: tuple, upto: tuple | None, uncommitted: list[tuple[int, int]]) -> DataFrame:
        fe, fb = after
        cond = (F.col("epoch") > fe) | ((F.col("epoch") == fe) & (F.col("batch_id") > fb))
        if upto is not None:
            ue, ub = upto
            cond = cond & ((F.col("epoch") < ue) | ((F.col("epoch") == ue) & (F.col("batch_id") <= ub)))
        for e, b in uncommitted:   # batches being written: a few at most
            cond = cond & ~((F.col("epoch") == e) & (F.col("batch_id") == b))
        return self._changelog().drop(WRITTEN_AT).where(cond)   # partition filters: pruned

    def _merge(self, ptr: dict, upto: tuple | None = None) -> DataFrame:
        """Snapshot + changelog tail -> newest row per key, at a cost that follows the tail.

        Snapshot rows whose key is not in the tail pass through an anti join (no shuffle of
        the snapshot); rows whose key is in the tail are folded together with the tail.
        The tail's key set is broadcast only behind the size check.
        """
        from tidemark.operators.enrich import bounded_broadcast
        cols = [f.name for f in self.schema.fields]
        after = tuple(ptr["folded"])
        batches = self._batches(after)
        pending = [b for b, done in batches if done and (upto is None or b <= upto)]
        snap = self._snapshot(ptr["version"])
        order = [*self.order_by, "epoch", "batch_id", *self.within_batch]
        if not pending:
            if snap is not None:
                return snap.select(*cols)
            return self.spark.createDataFrame([], self.schema)
        row_hash = F.xxhash64(*[F.col(c) for c in cols])
        order = [*order, "_tie"]      # equally new versions: the larger row hash wins
        tail = self._tail(after, upto, [b for b, done in batches if not done]).withColumn("_tie", row_hash)
        if snap is None:
            return latest_per_key(tail, self.keys, order).select(*cols)
        keys = bounded_broadcast(tail.select(*[F.col(k).alias(f"_k_{k}") for k in self.keys]).distinct())
        on = None
        for k in self.keys:
            c = snap[k].eqNullSafe(keys[f"_k_{k}"])
            on = c if on is None else on & c
        touched = snap.join(keys, on, "left_semi")
        untouched = snap.join(keys, on, "left_anti")
        base = (touched.withColumn("epoch", F.lit(-1).cast("long"))
                .withColumn("batch_id", F.lit(-1).cast("long")).withColumn("_tie", row_hash))
        folded = latest_per_key(base.unionByName(tail), self.keys, order).select(*cols)
        return untouched.select(*cols).unionByName(folded)

    def written(self) -> DataFrame:
        """All stored rows, unfolded: snapshot (epoch and batch -1) and committed changelog rows."""
        ptr = self.pointer()
        after = tuple(ptr["folded"])
        rows = self._tail(after, None, [b for b, done in self._batches(after) if not done])
        snap = self._snapshot(ptr["version"])
        if snap is None:
            return rows
        return rows.unionByName(snap.withColumn("epoch", F.lit(-1).cast("long")).withColumn("batch_id", F.lit(-1).cast("long")))

    def read_current(self) -> DataFrame:
        """The table as of now: newest row per key."""
        return self._merge(self.pointer())

    def signature(self) -> tuple:
        """Cheap change detector (file listing only, no job): pointer + committed batches."""
        ptr = self.pointer()
        return (json.dumps(ptr), tuple(b for b, done in self._batches(tuple(ptr["folded"])) if done))

    def lookup(self, **key) -> DataFrame:
        """Rows by column values. Key columns are filtered before the fold, in snapshot and
        changelog alike, with no job ahead of the read; others after it."""
        cond = None
        for col, value in key.items():
            c = F.col(col).eqNullSafe(F.lit(value))
            cond = c if cond is None else cond & c
        if not set(key) <= set(self.keys):
            return self.read_current().where(cond)
        cols = self.schema.fieldNames()
        rows = self.written().where(cond).withColumn("_tie", F.xxhash64(*cols))
        return latest_per_key(rows, self.keys, [*self.order_by, "epoch", "batch_id", *self.within_batch, "_tie"]).select(*cols)

    def tail(self) -> DataFrame:
        """The changelog as a stream (at-least-once; consumers de-duplicate by key)."""
        fields = list(self.schema.fields) + [T.StructField(WRITTEN_AT, T.TimestampType()),
                                             T.StructField("epoch", T.LongType()),
                                             T.StructField("batch_id", T.LongType())]
        return (self.spark.readStream.schema(T.StructType(fields))
                .option("basePath", f"{self.root}/changelog")
                .parquet(f"{self.root}/changelog"))

    # -- maintenance ---------------------------------------------------------------------
    def compact(self, files: int | None = None) -> int:
        """Fold snapshot + changelog (up to the newest batch now present) into a new
        snapshot version, then move the pointer (written last)."""
        ptr = self.pointer()
        # fold only the contiguous run of committed batches: a batch still being written (or
        # anything after it) stays in the tail, so a concurrent writer never loses rows
        upto = tuple(ptr["folded"])
        for eb, done in self._batches(upto):
            if not done:
                break
            upto = eb
        if upto == tuple(ptr["folded"]):
            return ptr["version"]
        folded = self._merge(ptr, upto)
        version = ptr["version"] + 1
        if files:
            folded = folded.repartition(files, *self.keys)
        w = folded.write.mode("overwrite")
        if self.partition:
            w = w.partitionBy(self.partition)
        w.parquet(f"{self.root}/snapshot/v={version}")
        now = self.pointer()   # an epoch may have been reserved meanwhile
        now.update(version=version, folded=list(upto))
        self._save_pointer(now)
        return version

    def replace(self, outdated, rows: DataFrame | None = None) -> int:
        """Rows of the current view that meet the condition ``outdated`` go, ``rows`` come, as a
        new snapshot version; with an upsert nothing could be taken away. Where a key of ``rows``
        is among the kept rows, too, the newest version stays (the given one among equally new
        ones). Run it while the table's writers are stopped."""
        ptr = self.pointer()
        batches = self._batches(tuple(ptr["folded"]))
        upto = max([tuple(ptr["folded"]), *[b for b, done in batches if done]])
        kept = self._merge(ptr).where(~F.coalesce(outdated, F.lit(False)))
        if rows is not None:
            rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
            from tidemark.operators.enrich import bounded_broadcast
            keys = bounded_broadcast(rows.select(*[F.col(k).alias(f"_k_{k}") for k in self.keys]).distinct())
            same = [kept[k].eqNullSafe(keys[f"_k_{k}"]) for k in self.keys]
            known = kept.join(keys, same, "left_semi").withColumn("_given", F.lit(0)).unionByName(rows.withColumn("_given", F.lit(1)))
            tied = known.withColumn("_tie", F.xxhash64(*rows.columns))
            order = [*self.order_by, *self.within_batch, "_given", "_tie"]
            kept = kept.join(keys, same, "left_anti").unionByName(latest_per_key(tied, self.keys, order).select(*rows.columns))
        version = ptr["version"] + 1
        w = kept.write.mode("overwrite")
        if self.partition:
            w = w.partitionBy(self.partition)
        w.parquet(f"{self.root}/snapshot/v={version}")
        now = self.pointer()
        now.update(version=version, folded=list(upto))
        self._save_pointer(now)
        return version

    def expire(self, keep_versions: int = 1, older_than_days: float | None = None) -> None:
        """Delete snapshot versions older than the newest ``keep_versions`` (and, when
        ``older_than_days`` is given, only those last modified that long ago — e.g. 90), plus
        the changelog batches already folded into the current snapshot, under the same age. The
        current snapshot is never removed."""
        import time
        ptr = self.pointer()
        cutoff_ms = None if older_than_days is None else (time.time() - older_than_days * 86400) * 1000
        for name in fs_list(self.spark, f"{self.root}/snapshot"):
            if not name.startswith("v=") or int(name[2:]) > ptr["version"] - keep_versions:
                continue
            if cutoff_ms is not None and fs_mtime_ms(self.spark, f"{self.root}/snapshot/{name}") > cutoff_ms:
                continue
            fs_delete(self.spark, f"{self.root}/snapshot/{name}")
        fe, fb = ptr["folded"]
        for e in fs_list(self.spark, f"{self.root}/changelog"):
            if not e.startswith("epoch="):
                continue
            ep = int(e.split("=")[1])
            for b in fs_list(self.spark, f"{self.root}/changelog/{e}"):
                path = f"{self.root}/changelog/{e}/{b}"
                if (b.startswith("batch_id=") and (ep < fe or (ep == fe and int(b.split("=")[1]) <= fb))
                        and (cutoff_ms is None or fs_mtime_ms(self.spark, path) <= cutoff_ms)):
                    fs_delete(self.spark, f"{self.root}/changelog/{e}/{b}")
