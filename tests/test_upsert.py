"""FIXTURES 5.5: merge-on-read upsert table semantics."""

import datetime as dt

from pyspark.sql import types as T

from tidemark.sources.upsert import UpsertTable

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()),
                       T.StructField("updated_at", T.TimestampType())])


def _table(spark, root, order_by=()):
    return UpsertTable(spark, f"{root}/t", ["k"], SCHEMA, list(order_by))


def _rows(table):
    return sorted((r.k, r.v) for r in table.read_current().collect())


def _df(spark, rows):
    return spark.createDataFrame([(k, v, dt.datetime(2024, 1, 1, 0, m)) for k, v, m in rows], SCHEMA)


def test_same_key_in_one_batch_newest_wins(spark, scratch):
    t = _table(spark, scratch, ["updated_at"])
    t.upsert(_df(spark, [("a", 1, 1), ("a", 2, 5), ("a", 3, 3)]))
    assert _rows(t) == [("a", 2)]


def test_later_batch_wins_and_replay_is_idempotent(spark, scratch):
    t = _table(spark, scratch)
    e = t.new_epoch()
    t.write_batch(_df(spark, [("a", 1, 0), ("b", 1, 0)]), e, 0)
    t.write_batch(_df(spark, [("a", 2, 0)]), e, 1)
    assert _rows(t) == [("a", 2), ("b", 1)]
    t.write_batch(_df(spark, [("a", 2, 0)]), e, 1)          # same batch id again
    assert _rows(t) == [("a", 2), ("b", 1)]


def test_null_key_is_one_row(spark, scratch):
    t = _table(spark, scratch)
    t.upsert(_df(spark, [(None, 1, 0)]))
    t.upsert(_df(spark, [(None, 2, 0)]))
    assert _rows(t) == [(None, 2)]
    assert [r.v for r in t.lookup(k=None).collect()] == [2]


def test_compaction_keeps_the_view(spark, scratch):
    t = _table(spark, scratch)
    t.upsert(_df(spark, [("a", 1, 0), ("b", 1, 0)]))
    t.upsert(_df(spark, [("a", 2, 0)]))
    before = _rows(t)
    v = t.compact()
    assert v == 0 and _rows(t) == before
    t.upsert(_df(spark, [("b", 9, 0), ("c", 1, 0)]))
    assert _rows(t) == [("a", 2), ("b", 9), ("c", 1)]
    t.compact()
    t.expire(keep_versions=1)
    assert _rows(t) == [("a", 2), ("b", 9), ("c", 1)]


def test_empty_batch_and_empty_table(spark, scratch):
    t = _table(spark, scratch)
    assert _rows(t) == []
    t.upsert(spark.createDataFrame([], SCHEMA))
    assert _rows(t) == []


def test_key_filter_pushed_below_fold(spark, scratch):
    t = _table(spark, scratch)
    t.upsert(_df(spark, [("a", 1, 0), ("b", 1, 0)]))
    plan = t.lookup(k="a")._jdf.queryExecution().optimizedPlan().toString()
    # the filter on the key sits under the aggregate
    assert plan.index("Aggregate") < plan.rindex("Filter")


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_read_cost_follows_the_tail(spark, scratch):
    t = _table(spark, scratch)
    t.upsert(_df(spark, [("a", 1, 0), ("b", 1, 0), (None, 1, 0)]))
    t.compact()
    assert "Aggregate" not in _optimized(t.read_current())        # snapshot only: no fold
    t.upsert(_df(spark, [("a", 5, 0), (None, 7, 0)]))
    plan = _optimized(t.read_current())
    assert "LeftAnti" in plan and "LeftSemi" in plan               # snapshot is not shuffled
    assert {(r.k, r.v) for r in t.read_current().collect()} == {(None, 7), ("a", 5), ("b", 1)}


def test_ordered_table_keeps_newer_snapshot_row(spark, scratch):
    t = _table(spark, scratch, ["updated_at"])
    t.upsert(_df(spark, [("k", 1, 10)]))
    t.compact()
    t.upsert(_df(spark, [("k", 2, 5)]))       # older window written later
    assert _rows(t) == [("k", 1)]
    t.upsert(_df(spark, [("k", 3, 20)]))
    assert _rows(t) == [("k", 3)]
    t.compact()
    assert _rows(t) == [("k", 3)]


def test_compaction_skips_uncommitted_batches(spark, scratch):
    from tidemark.sources.upsert import fs_delete
    t = _table(spark, scratch)
    e = t.new_epoch()
    t.write_batch(_df(spark, [("a", 1, 0)]), e, 0)
    t.write_batch(_df(spark, [("b", 1, 0)]), e, 1)
    t.write_batch(_df(spark, [("c", 1, 0)]), e, 2)
    fs_delete(spark, f"{t.root}/changelog/epoch={e}/batch_id=1/_SUCCESS")   # still being written
    t.compact()
    assert t.pointer()["folded"] == [e, 0]
    assert _rows(t) == [("a", 1), ("c", 1)]   # batch 1 is not there until it is committed
    t.write_batch(_df(spark, [("b", 1, 0)]), e, 1)
    assert _rows(t) == [("a", 1), ("b", 1), ("c", 1)]


def test_expire_by_age_keeps_recent_and_current(spark, scratch):
    from tidemark.sources.upsert import fs_list
    t = _table(spark, scratch)
    t.upsert(_df(spark, [("a", 1, 0)]))
    t.compact()
    t.upsert(_df(spark, [("a", 2, 0)]))
    t.compact()
    t.expire(keep_versions=1, older_than_days=90)          # v=0 is recent: kept
    assert sorted(fs_list(spark, f"{t.root}/snapshot")) == ["v=0", "v=1"]
    t.expire(keep_versions=1, older_than_days=0)           # now old enough: removed
    assert sorted(fs_list(spark, f"{t.root}/snapshot")) == ["v=1"]
    assert _rows(t) == [("a", 2)]
