"""Partition-scoped upsert: same result as a whole-table upsert, and the
files of partitions the batch does not touch are left alone."""

import glob
import os

from tessera.operators import sinks
from tessera.operators.merge import upsert, upsert_partitions


def _files(path, part):
    return sorted(glob.glob(os.path.join(path.replace("file:", ""), part, "*.parquet")))


def test_only_touched_partitions_rewritten(spark):
    base = spark.createDataFrame(
        [(k, y, f"v{k}") for y in (2020, 2021, 2022) for k in range(y * 10, y * 10 + 5)],
        "k long, yr int, v string")
    table = sinks.partitioned_table(spark, "t", ["yr"])
    table.create(base)
    before_2020 = _files(table.path, "yr=2020")
    batch = spark.createDataFrame([(20210, 2021, "new"), (20299, 2022, "ins")],
                                  "k long, yr int, v string")
    expected = sorted(upsert(base, batch, ["k"]).collect())
    assert upsert_partitions(table, batch, ["k"]) == 2
    assert sorted(table.read().select("k", "yr", "v").collect()) == expected
    assert _files(table.path, "yr=2020") == before_2020


def test_versioned_table_ignores_uncommitted_versions(spark):
    t = sinks.versioned_table(spark, "vt")
    assert t.read() is None
    t.commit(spark.createDataFrame([(1,)], "x int"))
    # a crashed writer leaves a directory without the commit marker
    crashed = os.path.join(t.root.replace("file:", ""), "v=2")
    os.makedirs(crashed)
    open(os.path.join(crashed, "part-0.parquet"), "w").close()
    assert t.current_version() == 1 and t.read().count() == 1


def test_batch_log_is_idempotent_under_replay(spark):
    from tessera.session import scratch_path

    path = scratch_path(spark, "log")
    rows = spark.createDataFrame([("a",), ("b",)], "v string")
    sinks.write_batch_log(rows, path, 7)
    sinks.write_batch_log(rows, path, 7)       # replay of batch 7
    sinks.write_batch_log(rows.limit(1), path, 8)
    assert spark.read.parquet(path).count() == 3


def test_commit_after_a_crashed_write(spark):
    t = sinks.versioned_table(spark, "vt")
    t.commit(spark.createDataFrame([(1,)], "x int"))
    os.makedirs(os.path.join(t.root.replace("file:", ""), "v=2"))     # died before its commit
    assert t.commit(spark.createDataFrame([(5,)], "x int")) == 3
    assert [r.x for r in t.read().collect()] == [5]


def _as_table(spark, rows, schema="k long, yr int, v string"):
    table = sinks.partitioned_table(spark, "t", ["yr"])
    table.create(spark.createDataFrame(rows, schema))
    return table


def test_null_partition_values_lose_no_rows(spark):
    table = _as_table(spark, [(1, None, "old1"), (2, None, "old2"), (3, 2020, "a")])
    batch = spark.createDataFrame([(4, None, "new"), (2, None, "upd")], "k long, yr int, v string")
    upsert_partitions(table, batch, ["k"])
    assert sorted(map(tuple, table.read().collect()), key=str) == sorted(
        [(1, None, "old1"), (2, None, "upd"), (3, 2020, "a"), (4, None, "new")], key=str)


def test_key_that_names_another_partition_stays_one_row(spark):
    table = _as_table(spark, [(1, 2020, "a"), (2, 2021, "b"), (3, 2022, "c")])
    upsert_partitions(table, spark.createDataFrame([(1, 2021, "moved")], "k long, yr int, v string"), ["k"])
    assert sorted(map(tuple, table.read().collect())) == [(1, 2020, "moved"), (2, 2021, "b"), (3, 2022, "c")]


def test_first_batch_goes_through_the_merge(spark):
    table = sinks.partitioned_table(spark, "t", ["yr"])
    batch = spark.createDataFrame([(1, 2020, "old", 1), (1, 2020, "new", 2), (2, 2021, "x", 1)],
                                  "k long, yr int, v string, loaded_at int")
    upsert_partitions(table, batch, ["k"], surrogate_key="line_key", dedup_order=["loaded_at"])
    rows = table.read()
    assert set(rows.columns) == {"k", "yr", "v", "line_key"}
    assert sorted((r.k, r.yr, r.v) for r in rows.collect()) == [(1, 2020, "new"), (2, 2021, "x")]
    upsert_partitions(table, batch.selectExpr("k + 1 k", "yr", "v", "loaded_at"), ["k"], surrogate_key="line_key",
                      dedup_order=["loaded_at"])
    keys = {r.k: r.line_key for r in table.read().collect()}
    assert sorted(keys.values()) == [1, 2, 3] and keys[3] == 3


def test_new_column_shows_in_every_partition(spark):
    table = _as_table(spark, [(1, 2020, "a"), (2, 2021, "b")])
    batch = spark.createDataFrame([(2, 2021, "b2", "e")], "k long, yr int, v string, extra string")
    upsert_partitions(table, batch, ["k"], allow_schema_sync=True)
    assert sorted((r.k, r.v, r.extra) for r in table.read().collect()) == [(1, "a", None), (2, "b2", "e")]


def test_empty_table_keeps_its_schema(spark):
    table = _as_table(spark, [])
    assert table.read().columns == ["k", "yr", "v"] and table.read().count() == 0
    upsert_partitions(table, spark.createDataFrame([(1, 2020, "a")], "k long, yr int, v string"), ["k"])
    assert table.read().count() == 1
